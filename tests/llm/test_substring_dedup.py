import hashlib
import random

import numpy as np
import pytest

from punctual.llm import substring_dedup as sd


def brute(rows, length=100):
    """Rows (id, text) with different ids."""
    seen, cover = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        cover[doc] = (raw, gone)
    out = []
    for doc, (raw, gone) in cover.items():
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone]) if len(raw) else b""
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def texts(seed, n=60, letters="abc éß\0"):
    """Texts out of a few long passages, their parts and near copies, and noise."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choices(letters, k=k))
    passages = [noise(rng.randrange(90, 900)) for _ in range(8)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            p = p[a : a + rng.randrange(60, 900)]
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + "Z" + p[k + 1 :]
            parts += [p, noise(rng.randrange(40))]
        out.append((i * 3 - 20, "".join(parts)))
    out += [(500, "ab" * 400), (501, "x" * 350), (502, "short"), (503, ""), (504, "ab" * 300 + "c")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(
    ("piece", "shard", "group"),
    [(2 << 20, 1 << 20, 32 << 20), (700, 600, 32 << 20), (1500, 900, 1200)],
)
def test_matches_brute_force(spark, piece, shard, group):
    """Pieces that cut texts, shards that cut anchors, and anchors that are spread."""
    rows = texts(piece)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sd.op10_substring_dedup(df, piece_bytes=piece, shard_bytes=shard, group_bytes=group)
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("depth", [8, 20, 100])
def test_suffix_array_and_common_prefixes(depth):
    rng = np.random.default_rng(depth)
    text = rng.integers(0, 3, 900).astype(np.uint8)
    text[300:600] = text[:300]
    raw = text.tobytes()
    order = sd.suffix_array(text, depth)
    keys = [raw[i : i + depth].ljust(depth, b"\0") for i in order]
    assert sorted(order) == list(range(900)) and keys == sorted(keys)
    starts, counts = np.array([0, 250, 620]), np.array([150, 300, 180])
    live = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts, strict=True)])
    order = order[np.isin(order, live)]
    got = sd.common_prefixes(text, order, starts, counts, depth)
    for a, b, n in zip(order, order[1:], got[1:], strict=False):
        same = next((k for k in range(depth) if (raw + b"\0" * 200)[a + k] != (raw + b"\0" * 200)[b + k]), depth)
        assert n == same
    assert got[0] == 0


def test_shards_of_one_anchor_are_merged():
    import pyarrow as pa

    rng = random.Random(1)
    base = bytes(rng.choices(b"abc\xc3\xa9\xff\x00", k=160))
    rows = []
    for i in range(40):
        a = rng.randrange(0, 40)
        rows.append((9, 0, i, 5, 1000 * i, base[a : a + rng.randrange(100, 121)]))
    rows += [(11, 0, 1, 5, 0, base[:100]), (12, 0, 3, 5, 0, base[::-1])]
    names = ["anchor", "sub", "id", "print", "start", "bytes"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
    got = set()
    for out in sd._shards(iter([batch.slice(0, 13), batch.slice(13)]), 100, 400):
        for r in out.to_pylist():
            got |= {(r["id"], r["start"] + k) for k in range(r["count"])}
    seen, wanted = {}, set()
    for anchor, _, i, _, s, text in rows:
        for k in range(len(text) - 99):
            key = (anchor, text[k : k + 100])
            if key in seen:
                wanted.add((i, s + k))
            seen[key] = 1
    assert got == wanted


def test_edges(spark):
    long = "".join(random.Random(3).choices("abcdefgh ", k=3000))
    rows = [
        (5, long, "x"), (5, long, "x"), (None, long[500:900], "x"), (7, long, "x"), (8, None, "x"),
        (9, "", "x"), (10, "y" * 99, "x"), (11, "y" * 99, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    done = sd.remove_repeats(df).collect()
    assert len(done) == len(rows)
    by_id = {}
    for r in done:
        by_id.setdefault(r.doc_id, set()).add((tuple(map(tuple, r.spans)), bytes(r.kept)))
    # a null id comes first, so it keeps what the others lose; rows of one id are one document
    assert by_id[None] == {((), long[500:900].encode())}
    assert by_id[5] == {(((500, 900),), (long[:500] + long[900:]).encode())}
    assert by_id[7] == {(((0, 3000),), b"")}
    assert by_id[8] == by_id[9] == {((), b"")} and by_id[11] == {((), b"y" * 99)}
    assert sd.op10_substring_dedup(df.where("false")).collect() == []


def test_query_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, sd.op10_substring_dedup(docs).collect()))
    assert got == brute(rows) and any(r[2] for r in got)


def test_text_longer_than_pieces_with_production_parameters(spark):
    rng = random.Random(9)
    noise = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    passage = noise(3_000)
    # the second copy lies across the border of the first two pieces
    parts = [noise(1 << 20), "1", passage, "2", noise((1 << 20) - 4_500), "3", passage, "4", noise(2_500_000), "5", passage, "6"]
    long = "".join(parts)
    second = len("".join(parts[:6]))
    third = len(long) - 3_001
    assert len(long) > 4 << 20 and second < sd.PIECE_BYTES < second + 3_000
    rows = [(1, long), (2, "7" + passage + "8"), (3, passage[:99])]
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    spans = [(second, second + 3_000), (third, third + 3_000)]
    assert [tuple(s) for s in got[1].spans] == spans
    assert bytes(got[1].kept).decode() == long[:second] + long[second + 3_000 : third] + "6"
    assert bytes(got[2].kept) == b"78" and bytes(got[3].kept).decode() == passage[:99]


def test_one_phrase_in_all_texts(spark):
    """A phrase as long as an anchor stands in all texts, each time in another context."""
    rng = random.Random(2)
    phrase = "a phrase of 30 bytes is common"
    noise = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    rows = [(i, " ".join(noise(150) + phrase for _ in range(6)) + noise(150)) for i in range(150)]
    rows += [(200 + i, rows[i][1][300:700]) for i in range(20)]
    got = sd.op10_substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows)
