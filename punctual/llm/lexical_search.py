"""Ranked lexical search: best documents of each query item, through K2-treaps of impacts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.llm.common import cut, slices, utf8

TOP = 10
SEGMENT_BYTES = 2 << 20  # of text
BLOCK_BYTES = 4 << 20  # of item texts that are broadcast at a time
STEP = 48  # document ranges of an item that are opened at a time
ROWS_A_BATCH = 4  # a row of the index has some MB

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TERMS = bytes(
    0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_IN_TERM = np.array([b not in _SEPARATORS for b in range(256)])
_BITS = np.array([bin(m).count("1") for m in range(16)], np.uint8)
_BEFORE = np.array([[_BITS[m & ((1 << c) - 1)] for c in range(4)] for m in range(16)], np.uint8)


def terms(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and all that isn't ASCII; A-Z in lower case."""
    return (text or b"").translate(_TERMS).split()


@contextmanager
def large_rows(spark: SparkSession):
    """Few rows a batch for what is run inside, where a row has some MB."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {key: spark.conf.get(key) for key in keys}
    try:
        for key in keys:
            spark.conf.set(key, str(ROWS_A_BATCH))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# ---- the index


def totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """How many documents hold a term, and how many terms, repeats included, all hold."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "docs bigint, terms bigint")
    row = counted.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return row["docs"] or 0, row["terms"] or 0


def _count(batches: Iterator[pa.RecordBatch]):
    docs = total = 0
    for batch in batches:
        for part in slices(batch, [len(t or b"") for t in utf8(batch.column(0))], SEGMENT_BYTES):
            # a byte behind each text, so that no term runs from one into the next
            texts = [(t or b"") + b" " for t in utf8(part.column(0))]
            begin = _IN_TERM[np.frombuffer(b"".join(texts), np.uint8)]
            begin[1:] &= ~begin[:-1]
            ends = np.cumsum([len(t) for t in texts]) - 1
            each = np.diff(np.cumsum(begin)[ends], prepend=0)
            docs, total = docs + int((each > 0).sum()), total + int(each.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([total])], ["docs", "terms"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A searchable index of ``docs``, stored in the shared scratch folder.

    One row per segment, i.e. a run of about 2 MiB of text. A segment's grid has a row per
    term and a column per document; a cell holds the term's impact in that document. The
    grid is stored as a K2-treap: a quadtree whose levels say which of a node's four
    quarters aren't empty and by how much their highest impact falls short of the node's.
    Documents lie in the order of their most frequent term and their length, terms in that
    of their frequency, so that quarters are alike inside. Every document with a term is in
    exactly one segment, whole; ``n_docs`` and ``n_terms`` are those of all documents, as
    impacts depend on them.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    n_docs, n_terms = totals(slim)
    schema = (
        f"ids array<{kind}>, terms binary, dfs binary, height int, masks binary, drops binary, "
        "top bigint"
    )
    rows = slim.mapInArrow(partial(_segments, n_docs=n_docs, n_terms=n_terms), schema)
    return cut(rows.withColumns({"n_docs": F.lit(n_docs), "n_terms": F.lit(n_terms)}), "treaps")


def _segments(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int):
    names = ["ids", "terms", "dfs", "height", "masks", "drops", "top"]
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(1))]
        for part in slices(batch, sizes, SEGMENT_BYTES):
            lists = [terms(t) for t in utf8(part.column(1))]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            if not n.any():
                continue
            vocabulary, row, column, tf, order = _postings(lists, n)
            m = 10 + 90 * n[order] * n_docs // n_terms
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[column])
            height, masks, drops, top = treap(row, column, impact)
            ids = part.column(0).take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([b" ".join(vocabulary)], pa.binary()),
                    pa.array([np.bincount(row, minlength=len(vocabulary)).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([height], pa.int32()),
                    pa.array([masks.tobytes()], pa.binary()),
                    pa.array([drops.tobytes()], pa.binary()),
                    pa.array([top], pa.int64()),
                ],
                names,
            )


def _postings(lists: list[list[bytes]], n: np.ndarray):
    """Terms by frequency; row, column and occurrences of each cell; documents in order."""
    flat = [w for words in lists for w in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    term = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(len(lists)), n)
    cell, tf = np.unique(term * len(lists) + doc, return_counts=True)
    term, doc = cell // len(lists), cell % len(lists)
    by_df = np.argsort(-np.bincount(term), kind="stable")
    place = np.empty(len(by_df), np.int64)
    place[by_df] = np.arange(len(by_df))
    term = place[term]
    # the most frequent term of each document, of equal ones that of most documents
    first = np.lexsort((term, -tf, doc))
    begins = np.flatnonzero(np.diff(doc[first], prepend=-1))
    leading = np.full(len(lists), -1, np.int64)
    leading[doc[first[begins]]] = term[first[begins]]
    order = np.lexsort((n, leading))
    order = order[n[order] > 0]
    column = np.empty(len(lists), np.int64)
    column[order] = np.arange(len(order))
    words = list(number)
    return [words[i] for i in by_df.tolist()], term, column[doc], tf.astype(np.int64), order


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of ``x``, with a free one above each."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def treap(row: np.ndarray, column: np.ndarray, value: np.ndarray):
    """(height, masks, drops, top) of the K2-treap over cells (row, column), none twice.

    Nodes are numbered level by level from the root, and in a level by the path to them.
    ``masks`` has a node's quarters that hold a cell, as bits of 2 * lower half of rows +
    right half of columns, for all but the last level; ``drops`` is by how much a node's
    highest value is below its parent's, and ``top`` that of the root.
    """
    height = max(1, int(max(row.max(), column.max())).bit_length())
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code, kind="stable")
    code, best = code[order], value[order]
    masks, drops = [], []
    for _ in range(height):
        quarter = (code & np.uint64(3)).astype(np.uint8)
        code = code >> np.uint64(2)
        begins = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        over = np.maximum.reduceat(best, begins)
        drops.append((np.repeat(over, np.diff(begins, append=len(code))) - best).astype(np.uint32))
        masks.append(np.bitwise_or.reduceat(np.left_shift(np.uint8(1), quarter), begins))
        code, best = code[begins], over
    return height, np.concatenate(masks[::-1]), np.concatenate(drops[::-1]), int(best[0])


class Treap:
    """A segment's treap, read back: per node its quarters, first child and highest value."""

    def __init__(self, height: int, masks: bytes, drops: bytes, top: int):
        self.height = height
        self.masks = np.frombuffer(masks, np.uint8)
        children = _BITS[self.masks].astype(np.int64)
        self.first = np.cumsum(children) - children + 1
        drop = np.frombuffer(drops, np.uint32).astype(np.int64)
        self.best = np.empty(1 + len(drop), np.int64)
        self.best[0] = top
        begin, end = 0, 1  # of a level; its children are the next one
        for _ in range(height):
            count = int(children[begin:end].sum())
            parents = np.repeat(self.best[begin:end], children[begin:end])
            self.best[end : end + count] = parents - drop[end - 1 : end - 1 + count]
            begin, end = end, end + count


# ---- queries to the index


class Query:
    """A block of items: their distinct terms, one after the other, with weights."""

    def __init__(self, items: dict):
        self.names = list(items)
        number: dict[bytes, int] = {}
        lists = [
            sorted({number.setdefault(t, len(number)) for text in texts for t in terms(text)})
            for texts in items.values()
        ]
        self.terms = number
        self.item = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.term = np.array([t for x in lists for t in x], np.int64)
        self.weight = np.zeros(len(self.term), np.int64)

    def weigh(self, dfs: np.ndarray, n_docs: int) -> Query:
        each = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in dfs]
        self.weight = np.array(each, np.int64)[self.term] if len(self.term) else self.weight
        return self


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict]:
    """Texts by item id, in blocks that are small enough to broadcast."""
    slim = items.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")
    ).where("text IS NOT NULL")
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for i in range(blocks):
        mine = slim if blocks == 1 else slim.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i)
        texts: dict = {}
        for row in mine.collect():
            texts.setdefault(row["id"], []).append(bytes(row["text"]))
        yield texts


def document_frequencies(index: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """In how many documents each term of ``vocabulary`` occurs."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)
    counts = (
        index.select("terms", "dfs")
        .mapInArrow(partial(_dfs, sent=sent), "term int, df bigint")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    found = np.zeros(len(vocabulary), np.int64)
    for row in counts.collect():  # a row per term of the block
        found[row["term"]] = row["df"]
    return found


def _here(vocabulary: dict[bytes, int], blob: bytes) -> np.ndarray:
    """The number in ``vocabulary`` of each term of a segment, or -1."""
    local = blob.split()
    return np.fromiter((vocabulary.get(t, -1) for t in local), np.int64, len(local))


def _dfs(batches: Iterator[pa.RecordBatch], sent):
    total = np.zeros(len(sent.value), np.int64)
    for batch in batches:
        for blob, dfs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            here = _here(sent.value, blob)
            known = here >= 0
            total[here[known]] += np.frombuffer(dfs, np.int32)[known]
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["term", "df"]
    )


def search(
    index: DataFrame,
    items: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, id, score.

    A document's score is the sum, over the item's distinct terms, of the term's weight
    times its impact; equal scores go by ascending id. Documents without a term of the item
    are no result, so an item may have fewer rows, or none: one with a null text, for
    instance. Rows of one item id, null included, are one item with the terms of all.

    Items are the stated query set: they go to all segments in blocks of bounded size. In a
    segment, an item's terms start at the root, and a document range with the nodes of its
    terms is opened where the sum of weights times highest impacts is largest. What can't
    reach the item's last place so far, over all segments of the task, is left. Each task
    returns its ``top`` documents an item, and Spark ranks those of all tasks.
    """
    spark = index.sparkSession
    kind = index.schema["ids"].dataType.elementType.simpleString()
    name = items.schema[item_col].dataType.simpleString()
    found = []
    with large_rows(spark):
        first = index.select("n_docs").first()
        n_docs = first["n_docs"] if first else 0
        for texts in _item_blocks(items, item_col, text_col):
            query = Query(texts)
            query.weigh(document_frequencies(index, query.terms), n_docs)
            names = pa.array(query.names, items.select(item_col).limit(0).toArrow().schema.field(0).type)
            sent = spark.sparkContext.broadcast((query, names))
            rows = index.select("ids", "terms", "height", "masks", "drops", "top").mapInArrow(
                partial(_search, sent=sent, top=top),
                f"item_id {name}, id {kind}, score bigint",
            )
            found.append(cut(rows, "found"))
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(place))
    return ranked.where(F.col("rank") <= top).select(
        F.col("item_id").alias(item_col), "rank", "id", "score"
    )


def _search(batches: Iterator[pa.RecordBatch], sent, top: int):
    query, names = sent.value
    best: list[list] = [[] for _ in query.names]
    least = np.ones(len(best), np.int64)  # a score below this is no result
    kind = None
    for batch in batches:
        kind = batch.column(0).type.value_type
        for i in range(batch.num_rows):
            blob, height, masks, drops, highest = (c[i].as_py() for c in batch.columns[1:])
            ids = batch.column(0)[i].values
            here = _here(query.terms, blob)
            local = np.full(len(query.terms), -1, np.int64)
            local[here[here >= 0]] = np.flatnonzero(here >= 0)
            found = descend(
                Treap(height, masks, drops, highest), len(ids), local, query, least, top
            )
            for item, mine in found.items():
                docs = ids.take(pa.array([d for d, _ in mine])).to_pylist()
                rows = [(-s, d is not None, d) for d, (_, s) in zip(docs, mine, strict=True)]
                best[item] = sorted(best[item] + rows)[:top]
                if len(best[item]) == top:
                    least[item] = -best[item][-1][0]
    if kind is not None:
        rows = [(i, *row) for i, mine in enumerate(best) for row in mine]
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array([r[0] for r in rows], pa.int64())),
                pa.array([r[3] for r in rows], kind),
                pa.array([-r[1] for r in rows], pa.int64()),
            ],
            ["item_id", "id", "score"],
        )


class _Ranges:
    """Document ranges of items, each with the treap nodes of the item's terms in it."""

    def __init__(self, item, level, prefix, bound, count, node, term, weight):
        self.item, self.level, self.prefix, self.bound = item, level, prefix, bound
        self.count, self.node, self.term, self.weight = count, node, term, weight

    def take(self, chosen: np.ndarray) -> _Ranges:
        """The ranges of a mask, in the same order."""
        inside = np.repeat(chosen, self.count)
        heads = (x[chosen] for x in (self.item, self.level, self.prefix, self.bound, self.count))
        return _Ranges(*heads, *(x[inside] for x in (self.node, self.term, self.weight)))

    @staticmethod
    def join(parts: list[_Ranges]) -> _Ranges:
        names = ("item", "level", "prefix", "bound", "count", "node", "term", "weight")
        return _Ranges(*(np.concatenate([getattr(p, x) for p in parts]) for x in names))


def descend(
    tree: Treap, n_docs: int, local: np.ndarray, query: Query, least: np.ndarray, top: int = TOP
) -> dict[int, list]:
    """(document, score) of a segment's documents that may be among the best, by item.

    ``local`` has the segment's row of each term, or -1. ``least`` is what a score must
    reach; a copy of it rises as documents are found.
    """
    row = local[query.term] if len(query.term) else query.term
    known = (row >= 0) & (query.weight > 0)
    item, term, weight = query.item[known], row[known], query.weight[known]
    if not len(item):
        return {}
    least = least.copy()
    items, begins = np.unique(item, return_index=True)
    count = np.diff(begins, append=len(item))
    zero = np.zeros(len(items), np.int64)
    bound = np.add.reduceat(weight * tree.best[0], begins)
    waiting = _Ranges(items, zero, zero, bound, count, np.zeros(len(item), np.int64), term, weight)
    found: dict[int, list] = {}
    while len(waiting.item):
        # of each item, the ranges with the highest bounds
        order = np.lexsort((-waiting.bound, waiting.item))
        sorted_items = waiting.item[order]
        start = np.flatnonzero(np.diff(sorted_items, prepend=-1))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
        chosen = np.zeros(len(order), bool)
        chosen[order[rank < STEP]] = True
        opened = _opened(tree, waiting.take(chosen))
        done = opened.level == tree.height
        for i, doc, score in zip(
            opened.item[done].tolist(), opened.prefix[done].tolist(), opened.bound[done].tolist(), strict=True
        ):
            if score >= least[i]:
                found.setdefault(i, []).append((doc, score))
        for i in set(opened.item[done].tolist()) & set(found):
            scores = [s for _, s in found[i]]
            if len(scores) >= top:
                least[i] = max(least[i], sorted(scores)[-top])
                found[i] = [(d, s) for d, s in found[i] if s >= least[i]]
        waiting = _Ranges.join([waiting.take(~chosen), opened.take(~done)])
        waiting = waiting.take(waiting.bound >= least[waiting.item])
    return found


def _opened(tree: Treap, ranges: _Ranges) -> _Ranges:
    """The halves of each range that hold a term of its item."""
    owner = np.repeat(np.arange(len(ranges.item)), ranges.count)
    lower = (ranges.term >> (tree.height - 1 - ranges.level[owner])) & 1
    mask = tree.masks[ranges.node]
    first = tree.first[ranges.node]
    halves = []
    for half in (0, 1):
        quarter = 2 * lower + half
        there = (mask >> quarter) & 1 == 1
        node = first[there] + _BEFORE[mask[there], quarter[there]]
        mine, term, weight = owner[there], ranges.term[there], ranges.weight[there]
        begins = np.flatnonzero(np.diff(mine, prepend=-1))
        of = mine[begins]
        bound = np.add.reduceat(weight * tree.best[node], begins) if len(of) else begins
        halves.append(
            _Ranges(
                ranges.item[of], ranges.level[of] + 1, ranges.prefix[of] * 2 + half, bound,
                np.diff(begins, append=len(mine)), node, term, weight,
            )
        )
    return _Ranges.join(halves)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """Index and search: item, rank, document id and score, ``top`` rows an item at most.

    Null and empty texts hold no term: such documents are no result and count nowhere.
    Repeated rows are documents of their own and each takes a place; a null id comes first
    among equal scores. Texts are read whole. Empty tables give no rows. Other columns are
    not read, so their names don't matter.
    """
    found = search(build_index(docs, id_col, text_col), items, item_col, item_text_col, top)
    return found.withColumnRenamed("id", id_col)


def op12_lexical_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's rows."""
    return rank_documents(docs, benchmark).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
a AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM n),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), a),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (
    1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (doc_id), a GROUP BY ALL),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
