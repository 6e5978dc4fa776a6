"""SimHash near-dedup: a self-join of a binary trie over 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import appended, components, cut, extended, fresh, utf8

WORDS = 3
MAX_BITS = 2
SEED = 42
NODE_ROWS = 20_000  # a pair of nodes with more members is split further before it is joined
STEP = 6  # bits that such a split takes
CHUNK_ROWS = 1 << 17
FRONTIER = 1 << 20

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return _hash(b" ".join(tokens))
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    n = len(tokens) - words + 1
    hashes = np.fromiter(map(_hash, shingles), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > n, bitorder="little").view("<u8")[0])


def _add_fingerprints(batches: Iterator[pa.RecordBatch], at: int, words: int):
    for batch in batches:
        prints = np.fromiter(
            (fingerprint(t, words) for t in utf8(batch.column(at))), np.uint64, batch.num_rows
        )
        yield appended(batch, ["__fp"], [pa.array(prints.view(np.int64))])


def trie_join(keys: np.ndarray, roots: tuple[np.ndarray, ...], budget: int):
    """Pairs of positions whose keys differ in at most ``budget`` bits.

    A trie node is a run of sorted keys that share a prefix. ``roots`` are the node pairs to
    start from, as arrays of bounds (a0, a1, b0, b1); a node joined with itself has equal
    bounds and yields each pair once. Both nodes of a pair are split on the next bit; the
    children that differ in it use up one of the budget, and a pair is dropped as soon as
    it has used more, or when one side is empty. Two single keys are compared at once.
    The pairs under work are cut into pieces, so memory doesn't grow with their number.
    """
    zeros: dict[int, np.ndarray] = {}

    def split(bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if bit not in zeros:
            z = np.zeros(len(keys) + 1, np.int32)
            np.cumsum((keys >> np.uint64(bit)) & np.uint64(1) == 0, out=z[1:])
            zeros[bit] = z
        return lo + zeros[bit][hi] - zeros[bit][lo]

    found = []
    work = [(63, *(np.asarray(x, np.int32) for x in roots), np.zeros(len(roots[0]), np.int8))]
    while work:
        bit, *pairs = work.pop()
        while bit >= -1 and len(pairs[0]):
            if len(pairs[0]) > FRONTIER:
                half = len(pairs[0]) // 2
                work.append((bit, *(x[half:] for x in pairs)))
                pairs = [x[:half] for x in pairs]
            a0, a1, b0, b1, used = pairs
            one = (a1 - a0 == 1) & (b1 - b0 == 1)
            i, j = a0[one], b0[one]
            near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
            found.append(np.stack([i[near], j[near]]))
            if bit < 0:
                break
            a0, a1, b0, b1, used = (x[~one] for x in pairs)
            am, bm, other = split(bit, a0, a1), split(bit, b0, b1), a0 != b0
            parts = [
                (a0, am, b0, bm, used),
                (am, a1, bm, b1, used),
                (a0, am, bm, b1, used + 1),
                *([] if not other.any() else [tuple(x[other] for x in (am, a1, b0, bm, used + 1))]),
            ]
            pairs = [np.concatenate(x) for x in zip(*parts, strict=True)]
            live = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)
            pairs = [x[live].astype(x.dtype) for x in pairs]
            bit -= 1
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int32)


def _join_nodes(batches: Iterator[pa.RecordBatch], shifts: list[int], budget: int):
    """Join the node pairs of a partition that comes sorted by pair, side and key."""

    def joined(cols: list[np.ndarray]) -> pa.RecordBatch:
        block, low, high, depth, side, key = cols
        pair_start = _starts(block, low, high, depth)
        run_start = np.union1d(pair_start, _starts(block, low, high, depth, side))
        ends = np.append(run_start[1:], len(key))
        within = low[run_start] == high[run_start]
        first = np.isin(run_start, pair_start)
        a = np.flatnonzero(within | (first & np.append(~first[1:], False)))
        b = np.where(within[a], a, a + 1)
        b = np.minimum(b, len(run_start) - 1)
        i, j = trie_join(
            key.view(np.uint64), (run_start[a], ends[a], run_start[b], ends[b]), budget
        )
        shift = np.array(shifts, np.uint64)[block[i]]
        back = [_rotate_right(key.view(np.uint64)[x], shift).view(np.int64) for x in (i, j)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in back], ["a", "b"])

    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = int(_starts(*cols[:4])[-1])  # the last pair may go on in the next batch
            if last:
                yield joined([x[:last] for x in cols])
            held, rows = [[x[last:] for x in cols]], len(cols[0]) - last
    if rows:
        yield joined([np.concatenate(x) for x in zip(*held, strict=True)])


def _starts(*cols: np.ndarray) -> np.ndarray:
    """Where a sorted run of equal values in all ``cols`` begins."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in cols))
    return np.flatnonzero(new)


def _rotate_right(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by % np.uint64(64)
    return np.where(by == 0, x, (x >> by) | (x << ((np.uint64(64) - by) % np.uint64(64))))


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Pairs (a, b) of distinct values of ``prints.__fp`` that differ in at most ``max_bits`` bits.

    Keys that differ in few bits agree in at least one of ``max_bits + 1`` blocks of bits,
    so there is a trie per block with that block rotated to the top, and below its first
    level only nodes of equal block meet. A node, i.e. one block value, is joined in one
    task while it has at most ``node_rows`` keys. Larger ones are split as in the traversal
    itself: on the next bits into pairs of child nodes, of which only those within the
    budget live, again until all are small enough. Keys are distinct, so this ends.
    """
    blocks = max_bits + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    roots = F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.lit(cuts[i + 1] - cuts[i]).alias("depth"),
                F.shiftleft("__fp", cuts[i])
                .bitwiseOR(F.shiftrightunsigned("__fp", 64 - cuts[i]))
                .alias("key"),
            )
            for i in range(blocks)
        )
    )
    top = F.expr("shiftrightunsigned(key, cast(64 - depth as int))")
    open_nodes = (
        prints.select(F.inline(roots)).withColumn("own", top).withColumn("other", F.col("own"))
    )
    pair = ["block", "low", "high", "depth"]
    masks = [m for m in range(1 << STEP) if m.bit_count() <= max_bits]
    done = []
    while True:
        open_nodes = open_nodes.withColumns(
            {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
        )
        large = cut(
            open_nodes.groupBy(*pair)
            .count()
            .where((F.col("count") > node_rows) & (F.col("depth") + STEP <= 64))
            .drop("count"),
            "nodes",
        )
        if large.isEmpty():
            done.append(open_nodes)
            break
        done.append(open_nodes.join(large, pair, "left_anti"))
        bits = F.expr(f"shiftrightunsigned(key, cast(64 - depth - {STEP} as int)) & {(1 << STEP) - 1}")
        open_nodes = cut(
            open_nodes.join(large, pair, "left_semi")
            .withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
            .where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) + F.bit_count("mask") <= max_bits)
            .select(
                "block",
                (F.col("depth") + STEP).alias("depth"),
                "key",
                (F.shiftleft("own", STEP).bitwiseOR(bits)).alias("own"),
                (F.shiftleft("other", STEP).bitwiseOR(bits.bitwiseXOR(F.col("mask")))).alias("other"),
            ),
            "nodes",
        )
    members = reduce(DataFrame.unionByName, done).select(
        *pair, (F.col("own") != F.col("low")).cast("int").alias("side"), "key"
    )
    return (
        members.repartition(*pair)
        .sortWithinPartitions(*pair, "side", "key")
        .mapInArrow(
            partial(_join_nodes, shifts=cuts[:-1], budget=max_bits), "a bigint, b bigint"
        )
    )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str | None = "text",
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` plus ``fingerprint``, ``component_id`` and ``is_first``.

    Words are runs without blanks, A-Z in lower case; a text with fewer words than a shingle
    is one shingle, one without words has fingerprint 0 and is linked like any other. Texts
    are linked where their fingerprints differ in at most ``max_bits`` bits, and
    ``component_id`` is the smallest id that links reach. Copies have one fingerprint, so
    only distinct fingerprints are joined, and links between them become components;
    no group is expanded into pairs of documents. ``is_first`` marks one row of each
    component, one with the smallest id.

    A null text has no words. Null ids come after all others; a component of null ids only
    has a null ``component_id``. Rows with one id stand for themselves, one of them is
    first. An empty table gives an empty table. Columns named like the results are
    replaced, all other columns are kept, except the text where ``keep_text`` is false.
    """
    docs = fresh(docs, "fingerprint", "component_id", "is_first")
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    prints = docs.mapInArrow(
        partial(_add_fingerprints, at=at, words=words), extended(docs.schema, "__fp bigint")
    )
    if not keep_text:
        prints = prints.drop(text_col)
    prints = cut(prints.withColumn("__row", F.monotonically_increasing_id()), "prints")
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__row").alias("row")))
    nodes = prints.groupBy("__fp").agg(first.alias("__first"))
    links = components(near_pairs(nodes.select("__fp"), max_bits))
    labels = cut(
        nodes.join(links, F.col("__fp") == F.col("node"), "left").select(
            "__fp", "__first", F.coalesce("component", "__fp").alias("__group")
        ),
        "labels",
    )
    groups = labels.groupBy("__group").agg(F.min("__first").alias("__of"))
    return (
        prints.join(labels.join(groups, "__group").select("__fp", "__of"), "__fp")
        .withColumns(
            {
                "fingerprint": F.lower(F.lpad(F.hex("__fp"), 16, "0")),
                "component_id": F.col("__of.id"),
                "is_first": F.col("__row") == F.col("__of.row"),
            }
        )
        .drop("__fp", "__row", "__of")
    )


def op1_simhash(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    done = simhash_groups(docs.select("doc_id", "text"), keep_text=False)
    return done.select("doc_id", "fingerprint", "component_id")
