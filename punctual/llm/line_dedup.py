"""Line dedup: lines that many documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BLANKS, UPPER, cut, fresh

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case.

    ``lower`` gives the same on pure ASCII and is faster there.
    """
    bare = F.trim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with shared lines cut out of the text, plus ``n_lines`` and ``n_dropped``.

    Texts split at ``\\n``. Lines whose key has ``min_chars`` code points or more and is
    found in at least ``min_docs`` documents are dropped, except in the document of the
    largest id that holds the key; there all of them stay. The other lines keep their order.

    Lines travel as two 64-bit hashes with their position. Keys are counted by an
    aggregation that combines before the shuffle, so a line in a third of all documents is
    no hot key there; it is one in the join that marks positions, whose large side Spark
    splits, as nothing above the join needs the rows of a key together.

    A null or empty text is one empty line; a null text stays null. Rows with the same id
    count as one document, each row is rebuilt by itself. A null id is no document: it adds
    nothing to a count and holds nothing. An empty table gives an empty table. Columns named
    like the results are replaced, all other columns are kept.
    """
    docs = fresh(docs, "n_lines", "n_dropped")
    doc, text = F.col(id_col), F.col(text_col)
    row = [
        F.xxhash64(F.lit(seed), doc.isNull(), doc, text).alias(name)
        for seed, name in ((1, "__r1"), (2, "__r2"))
    ]
    # a text shorter than a key holds none
    lines = (
        docs.where(F.char_length(text) >= min_chars)
        # hashed before the lines are apart, or each line would hash its whole text again
        .select(doc.alias("__id"), *row, text.alias("__text"))
        .select("__id", "__r1", "__r2", F.posexplode(F.split("__text", "\n", -1)).alias("__at", "__line"))
        .where(F.octet_length("__line") >= min_chars)
        .withColumn("__key", line_key(F.col("__line")))
        .where(F.char_length("__key") >= min_chars)
        .select(
            "__id", "__r1", "__r2", "__at",
            F.xxhash64("__key").alias("__h1"),
            F.xxhash64(F.lit(7), F.col("__key")).alias("__h2"),
        )
    )
    shared = (
        lines.where("__id IS NOT NULL")
        .groupBy("__h1", "__h2")
        .agg(F.count_distinct("__id").alias("__docs"), F.max("__id").alias("__holder"))
        .where(F.col("__docs") >= min_docs)
        .drop("__docs")
    )
    # stored, it joins as a table of known size: by broadcast where it is small, else with
    # a plain shuffle of either side, whose hot keys can be split
    shared = cut(shared, "shared")
    dropped = (
        lines.join(shared, ["__h1", "__h2"])
        .where(~F.col("__id").eqNullSafe(F.col("__holder")))
        .groupBy("__r1", "__r2")
        .agg(F.collect_set("__at").alias("__drop"))
    )
    split = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    # by a hash of positions: to look each line up in the list takes the square of it
    places = "array_except(sequence(0, size(__lines) - 1), __drop)"
    kept = F.expr(f"transform({places}, i -> __lines[i])")
    touched = F.col("__drop").isNotNull()
    return (
        docs.select("*", *row)
        .join(dropped, ["__r1", "__r2"], "left")
        .withColumn("__lines", split)
        .withColumns(
            {
                text_col: F.when(touched, F.array_join(kept, "\n")).otherwise(text),
                "n_lines": F.size("__lines").cast("long"),
                "n_dropped": F.when(touched, F.size("__drop")).otherwise(0).cast("long"),
            }
        )
        .drop("__r1", "__r2", "__drop", "__lines")
    )


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    done = dedup_lines(docs.select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


LINE_DEDUP_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
s AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.holder AS dropped FROM k LEFT JOIN s USING (key))
"""

ORACLE = (
    LINE_DEDUP_SQL
    + """
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS BIGINT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""
)
