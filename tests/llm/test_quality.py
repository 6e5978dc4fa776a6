import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from punctual.llm import quality


def test_features_are_the_distinct_ngrams_of_each_text_alone():
    texts = [b"ab cd ab  cd", None, b"", b"x", b"ab", b"\xc3\xa9 \xc3\xa9 \xc3\xa9", b"w " * 5000, b"v" * 90]
    together = quality.features(texts)
    for t, f in zip(texts, together, strict=True):
        alone = quality.features([t])[0]
        assert set(f.tolist()) == set(alone.tolist()) and len(set(f.tolist())) == len(f)
    # ab, cd; (ab cd), (cd ab); byte triples "ab ", "b c", " cd", "cd ", "d a", " ab", "b  ", "  c"
    assert len(together[0]) == 2 + 2 + 8
    assert not len(together[1]) and not len(together[2]) and len(together[3]) == 1
    # a repeated word counts as one mark: w, mark, (w mark), (mark mark), two triples
    assert len(together[6]) == 6


def test_descent_solves_the_dual():
    """At the optimum each row is at a bound or on the margin."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(80)]
    labels = np.array([int(r.sum() > 300) for r in rows])
    ratio = rng.normal(size=64)
    w = quality.descend(rows, labels, ratio, passes=3000)
    y = np.where(labels > 0, 1, -1)

    def loss(w):
        per_class = len(y) / 2 / np.array([(y < 0).sum(), (y > 0).sum()])
        out = w @ w / 2
        for f, s in zip(rows, y, strict=True):
            r = ratio[f] / np.linalg.norm(ratio[f])
            out += per_class[int(s > 0)] * max(0, 1 - s * (w[f] @ r + w[-1]))
        return out

    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(size=len(w)) * 10 ** rng.uniform(-4, 0)) >= best - 1e-2


def corpus(spark, n=400):
    rng = random.Random(5)
    good, bad = [f"w{i}" for i in range(60)], [f"w{i}!!" for i in range(40, 100)]
    rows = [(i, " ".join(rng.choices(good if i % 3 else bad, k=30))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(n)], "doc_id bigint, quality int, toxic int"
    )
    return docs, labels


def test_held_out_accuracy_and_sample_bound(spark):
    docs, labels = corpus(spark)
    for size in (8_000, 60):
        model = quality.learn(docs, labels, sample_docs=size)
        got = quality.predict(docs, model).withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5)
        held = got.where("fold = 0").collect()
        assert sum(r.predicted == (r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)


def test_table_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.op7_quality(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert held and sum(r.predicted == r.quality for r in held) >= 0.8 * len(held)


def test_edges(spark):
    docs, labels = corpus(spark, 100)
    odd = spark.createDataFrame(
        [(None, "w1 w2"), (500, None), (501, ""), (501, ""), (502, "w3 " * 50_000)], docs.schema
    )
    both = docs.unionByName(odd).withColumn("SCORE", F.lit("x")).withColumn("label", F.lit(3))
    more = labels.unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, 1), (7, 1, 0), (7, 1, 0)], labels.schema)
    )
    got = quality.op7_quality(both, more).collect()
    assert len(got) == 105 and all(0 <= r.score <= 1 for r in got)
    assert not next(r for r in got if r.doc_id is None).held_out
    none = quality.op7_quality(docs, labels.where("quality = 1")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.op7_quality(docs.where("false"), labels).collect() == []


M, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def brute_features(text):
    """N-grams of one text, one at a time in whole numbers."""

    def mix(h):
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & MASK
        return h ^ h >> 29

    def number(h):
        return (mix(h & MASK) * M & MASK) >> 64 - quality.BITS

    raw, hashes = (text or "").encode(), []
    for word in raw.split():
        h = len(word)
        for byte in word[: quality.WORD_BYTES]:
            h = (h ^ byte) * M & MASK
            h ^= h >> 32
        hashes.append(h)
    marked = [1 if i and h == hashes[i - 1] else h for i, h in enumerate(hashes)]
    out = {number(h) for h in marked}
    out |= {((mix(a * 3 + mix(b) & MASK) * M) & MASK) >> 64 - quality.BITS for a, b in zip(marked, marked[1:])}
    return out | {number(int.from_bytes(raw[i : i + 3], "little") + (1 << 40)) for i in range(len(raw) - 2)}


def brute_model(rows, labels):
    """Ratios, weights, bias and the margin function, learned by plain loops."""
    train = sorted(
        (int.from_bytes(xxhash.xxh64_digest(struct.pack("<q", i), 42), "big", signed=True), labels[i], t)
        for i, t in rows
        if zlib.crc32(str(i).encode()) % 5
    )
    counts = [Counter(), Counter()]
    for _, label, text in train:
        counts[label].update(brute_features(text))
    totals = [sum(c.values()) + (1 << quality.BITS) for c in counts]

    def ratio(f):
        return math.log((counts[1][f] + 1) / totals[1]) - math.log((counts[0][f] + 1) / totals[0])

    def vector(text):
        raw = {f: ratio(f) for f in brute_features(text)}
        norm = math.sqrt(sum(r * r for r in raw.values()))
        return {f: r / norm for f, r in raw.items()} if norm else {}

    def margin(text):
        return sum(weights.get(f, 0.0) * v for f, v in vector(text).items()) + bias

    fitted = [(vector(t), 2 * label - 1) for k, (_, label, t) in enumerate(train) if k % quality.CALIBRATION]
    sizes = Counter(y for _, y in fitted)
    weights, bias, alpha = {}, 0.0, [0.0] * len(fitted)
    rng = np.random.default_rng(0)
    for _ in range(quality.PASSES):
        moved = 0.0
        for i in rng.permutation(len(fitted)):
            x, y = fitted[i]
            slope = y * (sum(weights.get(f, 0.0) * v for f, v in x.items()) + bias) - 1
            square = sum(v * v for v in x.values()) + 1
            new = min(max(alpha[i] - slope / square, 0.0), quality.COST * len(fitted) / (2 * sizes[y]))
            step, alpha[i] = new - alpha[i], new
            for f, v in x.items():
                weights[f] = weights.get(f, 0.0) + step * y * v
            bias += step * y
            moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    held = [(margin(t), label) for k, (_, label, t) in enumerate(train) if not k % quality.CALIBRATION]
    return ratio, margin, held


def test_query_matches_brute_force(spark):
    docs, labels = corpus(spark, 160)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(900, None), (901, ""), (902, "w1  w1 w1\né " + "x" * 70), (903, "w2 w3 " * 3_000)]
    docs = spark.createDataFrame(rows, docs.schema)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    ratio, margin, held = brute_model([r for r in rows if r[0] in marks], marks)
    model = quality.learn(docs, labels)
    for f in set().union(*(brute_features(t) for _, t in rows)):
        assert math.isclose(model.ratio[f], ratio(f), rel_tol=1e-9, abs_tol=1e-12)
    # the scale makes the smoothed labels of the calibration documents likeliest
    hits = sum(label for _, label in held)
    wanted = [(hits + 1) / (hits + 2) if label else 1 / (len(held) - hits + 2) for _, label in held]
    given = [1 / (1 + math.exp(-model.scale * m - model.shift)) for m, _ in held]
    errors = [g - w for g, w in zip(given, wanted, strict=True)]
    assert abs(sum(errors)) < 1e-4
    assert abs(sum(e * m for e, (m, _) in zip(errors, held, strict=True))) < 1e-4
    got = {r.doc_id: r for r in quality.op7_quality(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        score = 1 / (1 + math.exp(-model.scale * margin(text) - model.shift))
        assert math.isclose(got[i].score, score, rel_tol=1e-6)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == int(got[i].score >= 0.3)
