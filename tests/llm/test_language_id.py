import random

import numpy as np

from punctual.llm import language_id as lid
from punctual.llm.lanes import Lanes


def brute_phrases(text, sample):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size
        count += 1
    return count


def test_phrases_match_brute_force():
    rng = random.Random(3)
    word = lambda a, n: bytes(rng.choice(a) for _ in range(n))
    samples = {"x": word(b"abcd ", 700) + b"\0" + word(b"abc", 100), "y": word(b"abxy ", 500), "z": b"q"}
    automata = lid.Automata(samples)
    texts = [word(b"abcdxyqw ", rng.randrange(1, 200)) for _ in range(700)]
    got = automata.phrases([np.frombuffer(t, np.uint8) for t in texts])
    assert got.tolist() == [[brute_phrases(t, samples[k]) for k in "xyz"] for t in texts]


def test_whole_samples_count_however_many_languages():
    rng = random.Random(5)
    word = lambda a, n: bytes(rng.choices(a, k=n))
    for languages, size in ((4, 40_000), (100, 2_500)):
        samples = {f"{k:03}": word(b"abcdefgh \xc3\xa4"[k % 3 :], size) for k in range(languages)}
        ends = [s[-300:] for s in samples.values()][:20]
        texts = [*ends, word(b"abcdefgh \xc3\xa4", 400)]
        arrays = [np.frombuffer(t, np.uint8) for t in texts]
        wanted = [[brute_phrases(t, s) for s in samples.values()] for t in texts]
        whole = lid.Automata(samples)
        assert whole.phrases(arrays).tolist() == wanted
        assert all(wanted[k][k] == 1 for k in range(len(ends)))
        # blocks of one and more languages, whose transitions are kept for some only
        for table_bytes, edge_bytes in ((1, 0), (220 * size, 40 * size)):
            parts = lid.Automata(samples, table_bytes, edge_bytes)
            assert len(parts.blocks) > 1 and parts.phrases(arrays).tolist() == wanted
            names, scores = parts.predict(texts)
            all_names, all_scores = whole.predict(texts)
            assert names == all_names and scores.tolist() == all_scores.tolist()


def test_lanes_place_every_sequence_once():
    lengths = np.array([5, 1, 9, 2, 2, 7, 1])
    lanes = Lanes(lengths, 3)
    flat = np.arange(lengths.sum()) + 1
    rows = lanes.spread(flat, 0)
    assert sorted(rows[rows > 0]) == flat.tolist()
    assert ((rows > 0).sum(1) == lanes.width).all()
    assert all((r[:w] > 0).all() for r, w in zip(rows, lanes.width, strict=True))


def test_learned_sample_is_bounded_and_leaves_out_the_held_out_fold(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = lid.learn(docs, sample_bytes=3000)
    assert set(samples) == {r.lang for r in docs.select("lang").distinct().collect()}
    assert all(len(s) <= 3000 + s.count(b"\0") for s in samples.values())
    from pyspark.sql import functions as F

    only = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert lid.learn(only) == {}


def test_only_what_can_be_learned_from_is_fetched(spark, monkeypatch):
    rows = [(i, None if i % 3 else "12, 34!", "none") for i in range(3000)]
    rows += [(i, f"{'1' * 500} word{chr(97 + i % 26)} {i}", "en") for i in range(3000, 6000)]
    rows += [(7000, "ª", "half"), (7001, "½", "numeral")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    fetched, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    samples = lid.learn(df, sample_bytes=3000)
    assert set(samples) == {"en", "half"}
    assert len(samples["en"].replace(b"\0", b"")) == 3000
    assert all(len(f) < 1000 for f in fetched)


def test_all_of_a_text_can_be_learned_from_and_copies_count_once(spark):
    head = "12-34 " * 1000
    licence = "permission is hereby granted free of charge " * 100
    one = lambda k, ws: " ".join(f"{w}{chr(97 + k % 26)}" for w in ws * 150)
    rows = [(i, head + one(i, ["lorem", "ipsum"]), "la") for i in range(100)]
    rows += [(i, licence + one(i, ["der", "hund"]), "de") for i in range(100, 200)]
    rows += [(i, "the same text", "en") for i in range(200, 900)]
    rows += [(i, f"other text {chr(97 + i % 26)}", "en") for i in range(900, 1000)]
    rows += [(1000 + i, head + "1" * 60_000 + " rara", "far") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples = lid.learn(df, sample_bytes=20_000, piece_chars=500)
    assert set(samples) == {"la", "de", "en", "far"} and b"rara" in samples["far"]
    assert b"ipsumc" in samples["la"] and samples["de"].count(b"hund") > 20
    assert all(len(p) <= 500 for s in samples.values() for p in s.split(b"\0"))
    assert samples["en"].count(b"the same text") == 1 and samples["en"].count(b"other text") == 26
    assert lid.learn(df.repartition(5), sample_bytes=20_000, piece_chars=500) == samples


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = lid.op8_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None]
    assert len(got) == docs.count() and len(held) > 20
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rows = [(i, "the quick brown fox and the lazy dog", "en", "k") for i in range(20)]
    rows += [(i, "der schnelle braune Fuchs und der faule Hund", "de", "k") for i in range(20, 40)]
    rows += [(50, None, "en", "k"), (51, "123 !?", "en", "k"), (52, "", None, "k"), (None, "The lazy fox", None, "k")]
    rows += [(53, "der Hund " * 30_000, None, "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = {(r.doc_id, r.lang_pred) for r in lid.op8_language_id(df).collect()}
    wanted = {(50, "und"), (51, "und"), (52, "und"), (None, "en"), (53, "de")}
    assert wanted <= got and len(got) == 45
    assert lid.predict(df, {}).where("lang_pred <> 'und'").count() == 0
    assert lid.op8_language_id(df.where("false")).collect() == []


def test_numerals_are_no_letters(spark):
    assert not any(lid.has_letter(x) for x in ("", "½ ²", "Ⅷ 12", "٣ _ 7", "①⑳"))
    assert all(lid.has_letter(x) for x in ("½x", "Ⅷ é", "ª", "ʰ", "日", "ǅ"))
    rows = [(i, f"some words of english text number {i} " * 5, "en") for i in range(40)]
    rows += [(100, "½ ² ⅓", "en"), (101, "Ⅷ Ⅸ", "en"), (102, "½ the words", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in lid.op8_language_id(docs).collect()}
    assert [got[i] for i in (100, 101, 102)] == ["und", "und", "en"]
