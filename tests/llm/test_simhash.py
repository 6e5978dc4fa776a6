import random

import numpy as np
import pytest
import xxhash

from punctual.llm import simhash


def brute_print(text, words=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    """Label of each print: the smallest position that links reach."""
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = sorted((top(i), top(j)))
                label[y] = x
    return [top(i) for i in range(len(prints))]


def near_prints(n, seed=0, top=0):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        base = rng.getrandbits(64 - top) if rng.random() < 0.3 else rng.choice(sorted(out)[:50])
        for _ in range(rng.randrange(4)):
            base ^= 1 << rng.randrange(64)
        out.add(base)
    return sorted(out)


def test_fingerprints_match_brute_force():
    for text in ["", None, "One", "Two words", "A b C d e f", "ÄÖ Ü x\x0by\x1cz  q", "a " * 500]:
        raw = None if text is None else text.encode()
        assert simhash.fingerprint(raw) == brute_print(text)


@pytest.mark.parametrize("budget", [0, 1, 2, 4])
def test_trie_join_finds_every_pair(budget, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    keys = np.array(near_prints(300), np.uint64)
    n = np.array([len(keys)])
    i, j = simhash.trie_join(keys, (n * 0, n, n * 0, n), budget)
    found = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(found) == len(i)
    wanted = {
        (a, b)
        for b in range(len(keys))
        for a in range(b)
        if (int(keys[a]) ^ int(keys[b])).bit_count() <= budget
    }
    assert found == wanted


@pytest.mark.parametrize("node_rows", [20_000, 8])
def test_near_pairs_with_and_without_split_nodes(spark, node_rows):
    prints = near_prints(400, seed=1, top=40)  # a shared top makes a hot node
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "__fp bigint")
    rows = simhash.near_pairs(df, node_rows=node_rows).distinct().collect()
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in rows}
    wanted = {
        frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2
    }
    assert found == wanted


def test_groups_with_nulls_copies_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [
        (3, base, "x"),
        (1, base + " w300", "y"),
        (7, None, "x"),
        (5, "", "x"),
        (None, "alone here today", "n"),
        (9, "quite another text altogether", "x"),
        (9, "quite another text altogether", "x"),
        (11, "word " * 40_000, "long"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    got = simhash.simhash_groups(df).collect()
    prints = [brute_print(r[1]) for r in rows]
    groups = brute_groups(prints)
    assert len(got) == len(rows)
    for r in got:
        i = next(k for k, x in enumerate(rows) if (x[0], x[1]) == (r.doc_id, r.text))
        ids = [rows[k][0] for k in range(len(rows)) if groups[k] == groups[i]]
        ids = [x for x in ids if x is not None]
        assert r.fingerprint == f"{prints[i]:016x}"
        assert r.component_id == (min(ids) if ids else None)
    assert sum(r.is_first for r in got) == len(set(groups))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.simhash_groups(df).collect() == []
    assert simhash.op1_simhash(df).collect() == []


def test_query_matches_brute_force_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [brute_print(r.text) for r in rows]
    groups = brute_groups(prints)
    wanted = {
        (r.doc_id, f"{p:016x}", rows[g].doc_id)
        for r, p, g in zip(rows, prints, groups, strict=True)
    }
    assert {tuple(r) for r in simhash.op1_simhash(docs).collect()} == wanted
