"""Benchmark decontamination: phrases of test items found through a positional index."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import cut, slices, utf8

WINDOW = 13
SEGMENT_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20  # of item texts that are broadcast at a time
SHARE = 20  # one word in so many makes a document contaminated

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_WORDS = bytes(
    0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and all that isn't ASCII; A-Z in lower case."""
    return (text or b"").translate(_WORDS).split()


# ---- the index


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A positional inverted index of ``docs``, stored in the shared scratch folder.

    Text is cut into segments, runs of documents of about 1 MiB, each document whole. A
    posting is a row: a term, a segment, and the rising positions of the term in it.
    Positions count words through the segment; one is left free between documents, so no
    phrase runs from one into the next. Rows lie in the order of their terms, so Parquet
    skips what a search doesn't ask for. One more row per segment, without a term, has the
    ids and the lengths of its documents.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    schema = f"segment bigint, term binary, positions binary, ids array<{kind}>, n_words array<int>"
    return cut(slim.mapInArrow(_postings, schema).sortWithinPartitions("term"), "index")


def _postings(batches: Iterator[pa.RecordBatch]):
    names = ["segment", "term", "positions", "ids", "n_words"]
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(1))]
        for part in slices(batch, sizes, SEGMENT_BYTES):
            lists = [words(t) for t in utf8(part.column(1))]
            n_words = np.fromiter(map(len, lists), np.int32, len(lists))
            flat = [w for words_of in lists for w in words_of]
            terms = {w: i for i, w in enumerate(dict.fromkeys(flat))}
            ids = np.fromiter(map(terms.__getitem__, flat), np.int32, len(flat))
            at = np.arange(len(flat), dtype=np.int32)
            at += np.repeat(np.arange(len(lists), dtype=np.int32), n_words)
            at = at[np.argsort(ids, kind="stable")]
            ends = 4 * np.cumsum(np.bincount(ids, minlength=len(terms)))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            places = pa.Array.from_buffers(
                pa.binary(), len(terms), [None, pa.py_buffer(offsets), pa.py_buffer(at)]
            )
            whole = [pa.array([0, len(lists)], pa.int32())]
            segment = uuid.uuid4().int >> 65
            columns = [
                pa.array([None, *terms], pa.binary()),
                pa.concat_arrays([pa.array([n_words.tobytes()], pa.binary()), places]),
            ]
            for values in (part.column(0), pa.array(n_words)):
                one = pa.ListArray.from_arrays(*whole, values)
                columns.append(pa.concat_arrays([one, pa.nulls(len(terms), one.type)]))
            number = pa.array(np.full(len(terms) + 1, segment, np.int64))
            yield pa.RecordBatch.from_arrays([number, *columns], names)


class Postings:
    """A segment's lists of the query's terms, by their numbers in the query."""

    def __init__(self, n_words: bytes, numbers: np.ndarray, positions: pa.Array, terms: int):
        self.n_words = np.frombuffer(n_words, np.int32)
        # where each document begins, with the free position before the next
        self.starts = np.concatenate([[0], np.cumsum(self.n_words + 1)])[:-1]
        lists = positions.to_pylist()
        self.at = np.frombuffer(b"".join(lists), np.int32).astype(np.int64)
        each = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        self.counts = np.zeros(terms, np.int64)
        self.hi = np.zeros(terms, np.int64)
        self.counts[numbers] = each
        self.hi[numbers] = np.cumsum(each)

    def list(self, term: int) -> np.ndarray:
        return self.at[self.hi[term] - self.counts[term] : self.hi[term]]

    def doc(self, at: np.ndarray) -> np.ndarray:
        """Of documents that begin at one place, the last, which has the words."""
        return np.searchsorted(self.starts, at, "right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Where ``terms`` follow each other: lists meet from the rarest term on."""
        order = np.argsort(self.counts[terms], kind="stable")
        starts = self.list(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            other = self.list(terms[k]) - k
            near = np.minimum(np.searchsorted(other, starts), len(other) - 1)
            starts = starts[other[near] == starts]
        return starts

    def near(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of each place where all ``terms`` lie within ``within``
        words of an occurrence of the rarest of them, in one document."""
        order = terms[np.argsort(self.counts[terms], kind="stable")]
        at = self.list(order[0])
        first, last = at, at
        for term in order[1:]:
            other = self.list(term)
            right = np.minimum(np.searchsorted(other, at), len(other) - 1)
            left = np.maximum(right - 1, 0)
            doc = self.doc(at)
            far = np.int64(1) << 40
            gap = [
                np.where(self.doc(other[i]) == doc, np.abs(other[i] - at), far) for i in (left, right)
            ]
            best = np.where(gap[0] <= gap[1], other[left], other[right])
            keep = np.minimum(*gap) <= within
            at, first, last = (
                at[keep], np.minimum(first, best)[keep], np.maximum(last, best)[keep],
            )
            if not len(at):
                break
        return first, last + 1


# ---- queries to the index


@dataclass
class Phrases:
    """A block of items: distinct windows as rows of term numbers, and who has them."""

    terms: list[bytes]
    windows: np.ndarray  # filled up with -1
    owners: list[list[int]]
    names: list[str]


def phrases(items: list[tuple[str, bytes | None]], window: int | None = WINDOW) -> Phrases:
    """All runs of ``window`` words of each item; a shorter one, or any for None, is one run."""
    terms: dict[bytes, int] = {}
    windows: dict[tuple, dict[int, None]] = {}
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    for name, text in items:
        row = [terms.setdefault(w, len(terms)) for w in words(text)]
        size = min(window or len(row), len(row))
        for i in range(len(row) - size + 1 if row else 0):
            windows.setdefault(tuple(row[i : i + size]), {})[number[name]] = None
    longest = max(map(len, windows), default=1)
    table = np.full((len(windows), longest), -1, np.int64)
    for i, w in enumerate(windows):
        table[i, : len(w)] = w
    return Phrases(list(terms), table, [list(x) for x in windows.values()], names)


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The items in blocks that are small enough to broadcast; each is collected alone."""
    slim = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"),
        F.col(text_col).cast("binary").alias("text"),
    ).where("text IS NOT NULL")
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for i in range(blocks):
        mine = slim if blocks == 1 else slim.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == i)
        yield [(r["name"], bytes(r["text"])) for r in mine.collect()]


def search(
    index: DataFrame,
    items: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    window: int | None = WINDOW,
    within: int | None = None,
) -> DataFrame:
    """Per indexed document: id, n_words, spans [start, end) in words, items found.

    Without ``within``, a span is an exact occurrence of ``window`` consecutive words of an
    item. With it, a span is a place where all words of such a window lie, in any order,
    within so many words of an occurrence of the rarest. Overlapping spans are merged.

    Items are the stated query set, taken in blocks of bounded size. Of the index only the
    lists of a block's terms are read on; a segment's lists meet in one task, from the
    rarest term of each window on. An item without words matches nothing; a null
    item id is named ``null``; rows of one item id are one item.
    """
    spark = index.sparkSession
    schema = "segment bigint, at int, spans array<struct<start:int,end:int>>, items array<string>"
    found = []
    for block in _item_blocks(items, item_col, text_col):
        query = phrases(block, window)
        sent = spark.sparkContext.broadcast(query)
        lists = _asked(index, query.terms)
        found.append(lists.mapInArrow(partial(_search, sent=sent, within=within), schema))
    hits = reduce(DataFrame.unionByName, found)
    if len(found) > 1:
        hits = hits.groupBy("segment", "at").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        ).mapInArrow(_blocks_joined, schema)
    docs = index.where("term IS NULL").select(
        "segment", F.posexplode(F.arrays_zip("ids", "n_words")).alias("at", "doc")
    )
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    return docs.join(hits, ["segment", "at"], "left").select(
        F.col("doc.ids").alias("id"),
        F.col("doc.n_words").cast("bigint").alias("n_words"),
        spans.alias("spans"),
        F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
    )


def _asked(index: DataFrame, terms: list[bytes]) -> DataFrame:
    """The lists of ``terms`` as (segment, number, positions), a segment's together.

    Terms are those of one block of items, which bounds what is broadcast. The lengths of
    the segment's documents come first, as number -1.
    """
    spark = index.sparkSession
    table = pa.table(
        {"term": pa.array(terms, pa.binary()), "number": pa.array(range(len(terms)), pa.int32())}
    )
    query = F.broadcast(spark.createDataFrame(table))
    lists = index.where("term IS NOT NULL").join(query, "term").select("segment", "number", "positions")
    lengths = index.where("term IS NULL").select(
        "segment", F.lit(-1).cast("int").alias("number"), "positions"
    )
    return (
        lists.unionByName(lengths).repartition("segment").sortWithinPartitions("segment", "number")
    )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each segment, which lie together."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(0).to_numpy()
        bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if begin == end:
                continue
            if waiting and waiting[-1].column(0)[-1].as_py() != key[begin]:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(begin, end - begin))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _search(batches: Iterator[pa.RecordBatch], sent, within: int | None):
    query = sent.value
    live = query.windows >= 0
    for rows in _segments(batches):
        numbers, positions = rows["number"].to_numpy(), rows["positions"].combine_chunks()
        post = Postings(positions[0].as_py(), numbers[1:], positions[1:], len(query.terms))
        spans, owners = [], []
        if len(numbers) > 1:
            fewest = np.where(live, post.counts[query.windows], np.int64(1) << 40).min(axis=1)
            for w in np.flatnonzero(fewest):
                terms = query.windows[w][live[w]]
                if within is None:
                    first = post.phrase(terms)
                    last = first + len(terms)
                else:
                    first, last = post.near(np.unique(terms), within)
                if len(first):
                    doc = post.doc(first)
                    spans.append(np.stack([doc, first - post.starts[doc], last - post.starts[doc]]))
                    docs = np.unique(doc)
                    owners += [np.stack([docs, np.full_like(docs, o)]) for o in query.owners[w]]
        if spans:
            spans, owners = _joined(_distinct(spans, 3)), _distinct(owners, 2)
            docs = np.unique(spans[0])
            names = pa.array(query.names, pa.string()).take(pa.array(owners[1]))
            yield _hit(
                pa.array(np.full(len(docs), rows["segment"][0].as_py(), np.int64)),
                pa.array(docs.astype(np.int32)),
                _lists(spans, docs),
                pa.ListArray.from_arrays(_bounds(owners[0], docs), names),
            )


def _hit(segment: pa.Array, at: pa.Array, spans: pa.Array, items: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([segment, at, spans, items], ["segment", "at", "spans", "items"])


def _lists(spans: np.ndarray, docs: np.ndarray) -> pa.Array:
    pairs = pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int32)) for x in spans[1:]], ["start", "end"]
    )
    return pa.ListArray.from_arrays(_bounds(spans[0], docs), pairs)


def _blocks_joined(batches: Iterator[pa.RecordBatch]):
    """Spans that several blocks of items found in a document, without overlaps."""
    for batch in batches:
        lists = batch.column("spans")
        each = np.diff(lists.offsets.to_numpy())
        start, end = (x.to_numpy() for x in lists.flatten().flatten())
        row = np.repeat(np.arange(batch.num_rows), each)
        spans = _joined(_distinct([np.stack([row, start, end]).astype(np.int64)], 3))
        yield _hit(
            batch.column("segment"),
            batch.column("at"),
            _lists(spans, np.arange(batch.num_rows)),
            batch.column("items"),
        )


def _distinct(parts: list[np.ndarray], width: int) -> np.ndarray:
    both = np.concatenate(parts, axis=1) if parts else np.zeros((width, 0), np.int64)
    return np.unique(both, axis=1)


def _joined(spans: np.ndarray) -> np.ndarray:
    """Sorted spans (doc, start, end) with those that touch in one."""
    doc, start, end = spans
    if not len(doc):
        return spans
    far = np.int64(1) << 40
    reach = np.maximum.accumulate(end + doc * far) - doc * far
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([doc[at], start[at], np.maximum.reduceat(end, at)])


def _bounds(sorted_docs: np.ndarray, docs: np.ndarray) -> pa.Array:
    """Where each of ``docs`` begins in a sorted list that has no other."""
    ends = np.append(np.searchsorted(sorted_docs, docs), len(sorted_docs))
    return pa.array(ends.astype(np.int32))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document: its id, n_words, n_hit, spans, items and whether it is contaminated.

    A word is hit if it is part of an occurrence of a window of an item; a document is
    contaminated where that holds for one word in twenty or more. Null and empty texts have
    no words. Every row of ``docs`` gives a row, repeated rows and null ids too; other
    columns are not read, so their names don't matter.
    """
    found = search(
        build_index(docs, id_col, text_col), items, item_col, item_text_col, window=window
    )
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.withColumnRenamed("id", id_col).withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def op6_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
m AS (SELECT doc_id, item, k, s FROM dw JOIN iw USING (k, win)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
