"""The corpus pipeline: from raw documents to token ids, stage by stage.

Each stage takes all documents that its predecessor kept and, but for the last, returns
them with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import bpe, decontaminate, language_id, line_dedup, simhash
from punctual.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Set ``lang`` to the predicted language; documents without one go."""
    done = language_id.predict(docs, language_id.learn(docs))
    return (
        done.where(F.col("lang_pred") != language_id.UNKNOWN)
        .withColumn("lang", F.col("lang_pred"))
        .select(*COLUMNS)
    )


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many documents share; a document that loses all its lines stays, empty."""
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint"))
    done = line_dedup.dedup_lines(docs)
    return done.withColumn("n_chars", F.coalesce(n_chars, "n_chars")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return simhash.simhash_groups(docs).where("is_first").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go.

    Rows are told apart by two hashes of id and text, so that neither null nor repeated ids
    matter; only those of contaminated rows are joined.
    """
    row = [F.xxhash64(F.lit(n), F.col("doc_id").isNull(), "doc_id", "text") for n in (1, 2)]
    keyed = docs.withColumn("__row", F.struct(row[0].alias("a"), row[1].alias("b")))
    found = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="__row")
    bad = cut(found.where("contaminated").select("__row").distinct(), "contaminated")
    return keyed.join(bad, "__row", "left_anti").select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with digests of them and of the text they decode to."""
    done = bpe.encode_decode(docs, bpe.tokenizer_path())
    return done.select("doc_id", "lang", "source", "ids", *bpe.digests(done))


STAGES = [
    ("language ID", identify_languages),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode_texts),
]

ORACLE_SQL = None  # automata, fingerprints and merges aren't SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut(docs, f"stage{number}")
    return docs
