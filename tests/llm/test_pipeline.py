import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import test_decontaminate
import test_language_id
import test_simhash
from pyspark.sql import Row
from tokenizers import Tokenizer

from punctual.llm import language_id


def languages(rows, samples):
    """Brute force: fewest weighted phrases; the sample itself is the operator's."""
    names = sorted(samples)
    out = []
    for r in rows:
        plain = language_id.letters(r["text"].encode()) if r["text"] else None
        if plain is None:
            continue
        raw = plain.tobytes()
        cost = [
            test_language_id.brute_phrases(raw, samples[k]) * np.log2(len(samples[k]) + 2) for k in names
        ]
        out.append({**r, "lang": names[int(np.argmin(cost))]})
    return out


def key(line):
    bare = line.strip("\x20\x09\x0a\x0b\x0c\x0d")
    return re.sub("[A-Z]", lambda m: m[0].lower(), bare)


def lines(rows):
    holders = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(r["doc_id"])
    out = []
    for r in rows:
        kept = [
            x
            for x in (r["text"] or "").split("\n")
            if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == r["doc_id"]
        ]
        text = "\n".join(kept)
        n_chars = r["n_chars"] if text == (r["text"] or "") else len(text)
        out.append({**r, "text": text, "n_chars": n_chars})
    return out


def near_copies(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    groups = test_simhash.brute_groups([test_simhash.brute_print(r["text"]) for r in rows])
    return [r for i, r in enumerate(rows) if groups[i] == i]


def clean(rows, items):
    bad = {
        r[0] for r in test_decontaminate.brute([(r["doc_id"], r["text"]) for r in rows], items) if r[5]
    }
    return [r for r in rows if r["doc_id"] not in bad]


def test_stages_and_run_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r.asDict() for r in docs.collect()]
    wanted, brutes = rows, [lambda x: languages(x, language_id.learn(docs)), lines, near_copies, lambda x: clean(x, items)]
    counts = [len(rows)]
    for (_, stage), brute in zip(corpus_pipeline.STAGES, brutes, strict=False):
        docs = spark.createDataFrame(wanted, docs.schema)
        got = stage(spark, docs, sf_dir)
        assert got.columns == corpus_pipeline.COLUMNS
        wanted = brute(wanted)
        counts.append(len(wanted))
        order = lambda r: r["doc_id"]
        assert sorted((r.asDict() for r in got.collect()), key=order) == sorted(wanted, key=order)
    assert counts[-1] < counts[0]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    done = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.ids) for r in done) == sorted(
        (r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids) for r in wanted
    )


def test_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row = docs.where("text IS NOT NULL").orderBy("doc_id").first().asDict()
    odd = [
        Row(**{**row, "doc_id": None}),
        Row(**{**row, "doc_id": None, "text": None}),
        Row(**{**row, "doc_id": 10**7, "text": ""}),
        Row(**{**row, "doc_id": 10**7 + 1, "text": "!!! 12"}),
        Row(**{**row, "doc_id": 10**7 + 2, "lang": None, "source": None, "n_chars": None}),
        Row(**{**row, "doc_id": 10**7 + 2, "lang": None, "source": None, "n_chars": None}),
    ]
    for given in (docs.unionByName(spark.createDataFrame(odd, docs.schema)), docs.where("false")):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, given, sf_dir)
            if number < 4:
                got = spark.createDataFrame(got.collect(), docs.schema)
                given = got
            else:
                ids = [r.doc_id for r in got.collect()]
    assert ids == []


def test_repeated_and_rejected_rows(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    text = "the and of to in that is was for with " * 30
    rows = [(i, text, "en", "s", 1) for i in range(20)]
    rows += [(50, None, "en", "s", 0), (51, "", "en", "s", 0), (52, "42!", "en", "s", 3), (None, text, "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.identify_languages(spark, docs, sf_dir).collect()
    assert len(kept) == 21 and {r.lang for r in kept} == {"en"}
    one = corpus_pipeline.drop_near_copies(spark, docs.where("doc_id < 20"), sf_dir).collect()
    assert [r.doc_id for r in one] == [0]
    twice = spark.createDataFrame(rows[:1] * 3, schema)
    assert corpus_pipeline.drop_near_copies(spark, twice, sf_dir).count() == 1
    assert corpus_pipeline.drop_contaminated(spark, twice, sf_dir).count() == 3


def test_a_very_long_text_passes_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    english = docs.where("lang = 'en' AND text IS NOT NULL").orderBy("doc_id").limit(50).collect()
    words = np.array(" ".join(r.text for r in english).split())
    rng = np.random.default_rng(6)
    text = "\n".join(" ".join(rng.choice(words, 12)) for _ in range(25_000))
    assert len(text) > 1_500_000
    row = Row(**{**english[0].asDict(), "doc_id": 10**8, "text": text})
    given = docs.where("doc_id % 10 > 0").unionByName(spark.createDataFrame([row], docs.schema))
    for _, stage in corpus_pipeline.STAGES[:4]:
        given = spark.createDataFrame(stage(spark, given, sf_dir).collect(), docs.schema)
        kept = given.where(f"doc_id = {10**8}").collect()
        assert [r.text for r in kept] == [text] and kept[0].lang == "en"
    done = corpus_pipeline.STAGES[4][1](spark, given.where(f"doc_id = {10**8}"), sf_dir).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert [r.ids for r in done] == [library.encode(text, add_special_tokens=False).ids]
