import hashlib
import re

import pytest

from punctual.llm import decontaminate


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=13):
    out = []
    wins = {}
    for item, text in items:
        w = brute_words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).add("null" if item is None else str(item))
    sizes = {len(w) for w in wins}
    for doc, text in docs:
        w = brute_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    found |= wins[tuple(w[i : i + size])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


LONG = " ".join(f"t{i}" for i in range(60))
ITEMS = [
    (1, LONG),
    (10, "Three short words"),
    (2, LONG),
    (3, "..."),
    (4, None),
    (5, ""),
    (None, "é à ü b1 c2"),
    (7, "a a a a a a a a a a a a a a a"),
]
DOCS = [
    (1, LONG.upper()),
    (2, "x " * 400 + LONG.replace(" ", "--")),
    (3, "before three SHORT-words after " + "pad " * 100),
    (3, "before three SHORT-words after " + "pad " * 100),
    (None, "É é à ü b1 c2 z"),
    (5, None),
    (6, ""),
    (7, " ".join(f"t{i}" for i in range(12))),
    (8, "a " * 20_000),
    (9, "three short"),
    (10, "words three short words words"),
    (11, "!!"),
]


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} bigint, text string")


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = frame(spark, DOCS, "doc_id"), frame(spark, ITEMS, "item_id")
    got = decontaminate.op6_decontaminate(docs, items).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(DOCS, ITEMS)))


def test_empty_tables(spark):
    docs, items = frame(spark, DOCS, "doc_id"), frame(spark, ITEMS, "item_id")
    none = decontaminate.op6_decontaminate(docs, items.where("false")).collect()
    assert len(none) == len(DOCS) and not any(r.contaminated or r.n_hit for r in none)
    assert decontaminate.op6_decontaminate(docs.where("false"), items).collect() == []


def test_spans_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "p q three short words", "x", 3)],
        "doc_id bigint, text string, items string, n_words int",
    )
    row = decontaminate.contamination(docs, frame(spark, ITEMS, "item_id")).first()
    assert [(s.start, s.end) for s in row.spans] == [(2, 5)] and row["items"] == ["10"]


def test_proximity(spark):
    index = decontaminate.build_index(frame(spark, DOCS + [(12, "words, three or so, short")], "doc_id"))
    items = frame(spark, [(1, "short words three")], "item_id")
    exact = decontaminate.search(index, items, window=None).where("size(items) > 0").collect()
    assert exact == []
    near = decontaminate.search(index, items, window=None, within=2).where("size(items) > 0")
    assert sorted(r.id for r in near.collect()) == [3, 3, 10]
    wide = decontaminate.search(index, items, window=None, within=4).where("size(items) > 0")
    assert sorted(r.id for r in wide.collect()) == [3, 3, 10, 12]


def test_query_on_a_table(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {tuple(r) for r in decontaminate.op6_decontaminate(docs, items).collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = set(brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()]))
    assert got == wanted and any(r[2] for r in wanted)


@pytest.mark.parametrize("block", [8 << 20, 2_000])
def test_many_spans_in_one_text(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(i, " ".join(f"p{i}x{k}" for k in range(13))) for i in range(40)]
    text = " gap ".join(items[i % 40][1] for i in range(100_000))
    docs = frame(spark, [(1, text), (2, text[:1000]), (3, None)], "doc_id")
    row = decontaminate.contamination(docs, frame(spark, items, "item_id")).where("doc_id = 1").first()
    assert len(row.spans) == 100_000 and row.n_hit == 1_300_000 and len(row["items"]) == 40
    assert [(s.start, s.end) for s in row.spans[:2]] == [(0, 13), (14, 27)]


def test_overlaps_across_blocks_count_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    words = [f"t{i}" for i in range(40)]
    items = [(i, " ".join(words[i : i + 13])) for i in range(20)]
    docs = [(1, " ".join(words)), (2, " ".join(words[5:20]) + " x " + " ".join(words[2:15])), (3, "x")]
    got = decontaminate.op6_decontaminate(frame(spark, docs, "doc_id"), frame(spark, items, "item_id"))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, items))


def test_a_search_reads_the_lists_it_asks_for(spark):
    index = decontaminate.build_index(frame(spark, DOCS, "doc_id"))
    terms = {bytes(r.term) for r in index.where("term IS NOT NULL").select("term").collect()}
    assert {b"t5", b"pad", "é".encode()} <= terms
    asked = decontaminate._asked(index, [b"pad", b"absent", b"short"])
    found = [(r.number, len(r.positions) // 4) for r in asked.collect() if r.number >= 0]
    assert {n for n, _ in found} == {0, 2} and sum(c for n, c in found if n == 0) == 200
    lists = asked._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term)]" in lists and "BroadcastHashJoin" in lists
