"""Suffix-array dedup: bytes of repeated substrings, found in sharded suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import cut, extended, forget, fresh, slices, utf8

LENGTH = 100
GRAM = 20  # bytes of an anchor
PIECE_BYTES = 2 << 20
POSITION_BITS = 24  # of a place within a piece
SHARD_BYTES = 1 << 20
GROUP_BYTES = 32 << 20  # of one anchor; more are spread by the strings themselves
NO_ID = -(1 << 63)

_ONE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, whose order counts; of as many as both have."""
    n = min(len(a), len(b))
    return _mix(a[:n] * _ONE + b[:n])


# ---- anchors: strings that can be equal get to one place


def anchored_runs(text: bytes, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple:
    """Runs of strings of ``length`` bytes that have the same anchor.

    ``starts`` and ``ends`` bound the documents in ``text``. A string's anchor is the gram
    of ``GRAM`` bytes with the smallest hash in it, the first of equals: equal strings have
    equal anchors in equal places. Gives (anchor, content, start, count) per run, where
    ``content`` hashes all bytes of the run's strings.
    """
    reach = length - GRAM + 1
    n = len(text)
    buf = np.frombuffer(text + b"\0" * (2 * length + 16), np.uint8)
    eight = np.ndarray((n + 2 * length,), "<u8", buf.tobytes(), strides=(1,)).copy()
    eight = _mix(eight * _ONE)
    sixteen = _pairs(eight, eight[8:])
    gram = _pairs(sixteen, eight[GRAM - 8 :])
    place = np.uint64((1 << POSITION_BITS) - 1)
    low = (gram & ~place) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while 2 * size <= reach:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    if size < reach:
        low = np.minimum(low[: len(low) - (reach - size)], low[reach - size :])
    at = (low[:n] & place).astype(np.int64)
    whole = np.zeros(n + 1, np.int8)
    long_enough = ends - starts >= length
    whole[starts[long_enough]] += 1
    whole[ends[long_enough] - length + 1] -= 1
    whole = np.cumsum(whole[:-1]) > 0
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
    begins[starts[long_enough]] = True
    first = np.flatnonzero(begins)
    if not len(first):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    final = whole.copy()
    final[:-1] &= begins[1:] | ~whole[1:]
    count = np.flatnonzero(final) + 1 - first
    thirty_two = _pairs(sixteen, sixteen[16:])
    block = _pairs(thirty_two, thirty_two[32:])
    width = 64
    size = count + length - 1
    content = _mix(size.astype(np.uint64) * _ONE)
    # blocks that overlap and cover the run from its start to its end
    steps = -(-(length + reach - 1 - width) // width)
    for k in range(steps + 1):
        offset = (size - width) * k // steps
        content = _mix(content * _ONE + block[first + offset])
    return gram[at[first]], content, first, count


def _pieces(batch: pa.RecordBatch, length: int, size: int):
    """(row, offset, bytes) with pieces of long texts overlapping by a string less a byte."""
    for i, text in enumerate(utf8(batch.column(2))):
        text = text or b""
        for at in range(0, max(1, len(text) - length + 1), size):
            yield i, at, text[at : at + size + length - 1]


def _find_runs(batches: Iterator[pa.RecordBatch], length: int, piece_bytes: int):
    """Runs of each piece of input; those that repeat an earlier one there are settled."""
    for batch in batches:
        held, size = [], 0
        for piece in _pieces(batch, length, piece_bytes):
            if held and size + len(piece[2]) > piece_bytes:
                yield from _settled(batch, held, length)
                held, size = [], 0
            held.append(piece)
            size += len(piece[2])
        if held:
            yield from _settled(batch, held, length)


def _settled(batch: pa.RecordBatch, held: list, length: int):
    sizes = np.array([len(p[2]) for p in held])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    anchor, content, first, count = anchored_runs(b"".join(p[2] for p in held), starts, ends, length)
    if not len(first):
        return
    piece = np.searchsorted(starts, first, "right") - 1
    row = np.array([p[0] for p in held])[piece]
    start = first - starts[piece] + np.array([p[1] for p in held])[piece]
    ids, prints = (batch.column(c).to_numpy()[row] for c in (0, 1))
    order = np.lexsort((start, prints, ids, content, anchor))
    new = _changes(anchor[order], content[order])
    o = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    # a repeated row isn't earlier
    same = (ids[o] == ids[order]) & (prints[o] == prints[order]) & (start[o] == start[order])
    repeat = np.zeros(len(order), bool)
    repeat[order] = ~same
    keep = np.zeros(len(order), bool)
    keep[order] = new
    yield _rows(0, anchor[keep], content[keep], ids[keep], prints[keep], start[keep], count[keep])
    if repeat.any():
        # neighbouring repeats of a document in one row
        i, p, s, c = (x[repeat] for x in (ids, prints, start, count))
        o = np.lexsort((s, p, i))
        i, p, s, c = i[o], p[o], s[o], c[o]
        begin = _changes(i, p)
        begin[1:] |= s[1:] > s[:-1] + c[:-1]
        at = np.flatnonzero(begin)
        total = np.maximum.reduceat(s + c, at) - s[at]
        none = np.zeros(len(at), np.uint64)
        yield _rows(1, none, none, i[at], p[at], s[at], total)


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


_NAMES = ["kind", "anchor", "content", "id", "print", "start", "count"]
_SCHEMA = (
    "kind int, anchor bigint, content bigint, id bigint, print bigint, start bigint, count bigint"
)


def _rows(kind: int, anchor, content, ids, prints, start, count) -> pa.RecordBatch:
    columns = [np.full(len(ids), kind, np.int32), anchor, content, ids, prints, start, count]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], _NAMES)


def _judge(batches: Iterator[pa.RecordBatch]):
    """Sorted runs: those whose content is there before repeat it (kind 1); of anchors with
    several contents the first run of each has to be compared (kind 2).

    What stays from one batch to the next are the first run of the anchor and the first of
    the content, so an anchor of any size streams through.
    """
    carried = None
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in _NAMES[1:]]
        sent = np.zeros(batch.num_rows, bool)
        old = sent.copy()
        if carried is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(carried[0], cols, strict=True)]
            sent = np.concatenate([carried[1], sent])
            old = np.concatenate([np.ones(len(carried[1]), bool), old])
        if not len(sent):
            continue
        anchor, content, ids, prints, start, count = cols
        new_anchor = _changes(anchor)
        new = _changes(anchor, content)
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        same = (ids == ids[lead]) & (prints == prints[lead]) & (start == start[lead])
        repeat = ~same & ~old
        of = np.cumsum(new_anchor) - 1
        several = np.bincount(of, new) > 1
        compare = new & several[of] & ~sent
        none = np.zeros(int(repeat.sum()), np.int64)
        yield _rows(1, none, none, *(c[repeat] for c in (ids, prints, start, count)))
        yield _rows(2, *(c[compare] for c in cols))
        begin = int(np.flatnonzero(new_anchor)[-1])
        stay = np.unique([begin, int(lead[-1])])
        carried = ([c[stay] for c in cols], np.full(len(stay), bool(several[-1])))


# ---- suffix arrays


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes (Larsson and Sadakane).

    Suffixes are sorted by eight bytes; then each pass sorts the groups that are still
    equal by the rank of the suffix as many bytes further on as are known to be equal,
    which doubles that number. Groups of one are left alone.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)]).tobytes()
    key = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    # beyond the end all suffixes are alike and come first
    rank = np.zeros(n + depth, np.int64)
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[order] = group + 1
    known = 8
    while known < depth:
        step = min(known, depth - known)
        bounds = np.append(np.flatnonzero(new), n)
        open_groups = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        slots = np.flatnonzero(open_groups)
        if not len(slots):
            break
        members = order[slots]
        pair = rank[members] << np.int64(32) | rank[members + step]
        by = np.argsort(pair, kind="stable")
        order[slots] = members[by]
        pair = pair[by]
        fresh_group = np.ones(len(slots), bool)
        fresh_group[1:] = pair[1:] != pair[:-1]
        new[slots] = fresh_group
        group = slots[fresh_group][np.cumsum(fresh_group) - 1]
        later = rank.copy()
        later[order[slots]] = group + 1
        rank = later
        known += step
    return order


def common_prefixes(
    text: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray, depth: int
) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix in ``order`` shares with the one before it.

    Kasai's walk in the order of the text, where a step loses at most one byte of what was
    equal. It goes along all strings side by side: ``starts`` and ``counts`` say where the
    suffixes of ``order`` lie, which are ``counts`` neighbours from each start on. Where the
    order looked at ``depth`` bytes only, two next suffixes may come the other way round;
    the walk then begins anew.
    """
    padded = np.concatenate([text, np.zeros(depth + 1, np.uint8)])
    rank = np.zeros(len(text) + 1, np.int64)
    rank[order] = np.arange(len(order))
    ends = np.zeros(len(text) + 1, bool)
    ends[starts + counts - 1] = True
    lanes = np.argsort(-counts, kind="stable")
    starts, counts = starts[lanes], counts[lanes]
    shared = np.zeros(len(order), np.int64)
    equal = np.zeros(len(starts), np.int64)
    for k in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts, -k, "left"))
        i = starts[:live] + k
        at = rank[i]
        before = order[at - 1]
        now = equal[:live]
        now[at == 0] = 0
        work = np.flatnonzero((at > 0) & (now < depth))
        while len(work):
            work = work[padded[i[work] + now[work]] == padded[before[work] + now[work]]]
            now[work] += 1
            work = work[now[work] < depth]
        shared[at] = now
        # the walk goes on only beside a string that comes before the next one, too
        goes_on = (at > 0) & ~ends[before] & (rank[before + 1] < rank[i + 1])
        now[:] = np.where(goes_on, np.maximum(now - 1, 0), 0)
    return shared


class _Shard:
    """Runs as one text, its suffix array, and which of its strings are repeats."""

    def __init__(self, rows: list[tuple], length: int):
        self.rows, self.length = rows, length
        parts = [np.frombuffer(r[4], np.uint8) for r in rows]
        sizes = np.array([len(p) for p in parts])
        self.text = np.concatenate(parts)
        self.starts = np.cumsum(sizes) - sizes
        self.counts = sizes - length + 1
        live = np.zeros(len(self.text) + 1, np.int8)
        live[self.starts] += 1
        live[self.starts + self.counts] -= 1
        order = suffix_array(self.text, length)
        self.order = order[(np.cumsum(live[:-1]) > 0)[order]]
        shared = common_prefixes(self.text, self.order, self.starts, self.counts, length)
        self.heads = np.flatnonzero(shared < length)
        self.run = np.searchsorted(self.starts, self.order, "right") - 1
        # rows come by document and place, so the first place in the text is the earliest
        first = np.minimum.reduceat(self.order, self.heads)
        group = np.zeros(len(self.order), np.int64)
        group[self.heads] = 1
        self.group = np.cumsum(group) - 1
        self.first = first
        # a repeated row holds the same place of the same document
        self.identity = self._identity()
        self.repeat = self.identity[self.order] != self.identity[first][self.group]

    def _identity(self) -> np.ndarray:
        documents: dict[tuple, int] = {}
        out = np.zeros(len(self.text), np.int64)
        for row, at, count in zip(self.rows, self.starts, self.counts, strict=True):
            number = documents.setdefault(row[1:3], len(documents))
            out[at : at + count] = (number << 40) + row[3] + np.arange(count)
        return out

    def strings(self, anchor: tuple) -> np.ndarray:
        """The different strings of one anchor, sorted."""
        mine = np.array([r[0] == anchor for r in self.rows])
        at = self.first[mine[np.searchsorted(self.starts, self.first, "right") - 1]]
        order = np.sort(self.group[np.isin(self.order, at)])
        windows = np.lib.stride_tricks.sliding_window_view(self.text, self.length)
        return np.ascontiguousarray(windows[self.first[order]]).view(f"S{self.length}").ravel()

    def merge(self, before: np.ndarray) -> None:
        """Mark all strings that an earlier shard has, by binary search in its order."""
        windows = np.lib.stride_tricks.sliding_window_view(self.text, self.length)
        mine = np.ascontiguousarray(windows[self.first]).view(f"S{self.length}").ravel()
        at = np.minimum(np.searchsorted(before, mine), len(before) - 1)
        self.repeat |= (before[at] == mine)[self.group]

    def results(self) -> pa.RecordBatch:
        places = np.sort(self.order[self.repeat])
        run = np.searchsorted(self.starts, places, "right") - 1
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (run[1:] != run[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(places)))
        rows = [self.rows[k] for k in run[at]]
        start = np.array([r[3] for r in rows], np.int64) + places[at] - self.starts[run[at]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array(start, pa.int64()),
                pa.array(count, pa.int64()),
            ],
            ["id", "print", "start", "count"],
        )


def _shards(batches: Iterator[pa.RecordBatch], length: int, shard_bytes: int):
    """Shards of whole anchors; an anchor that is larger than a shard goes through several,
    each of which is merged with those before it."""
    rows: list[tuple] = []
    size = 0
    before: list[np.ndarray] = []
    anchor = None

    def close():
        shard = _Shard(rows, length)
        for strings in before:
            shard.merge(strings)
        return shard

    for batch in batches:
        for a, sub, i, p, s, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, sub) != anchor:
                if rows and (size >= shard_bytes or before):
                    yield close().results()
                    rows, size, before = [], 0, []
                anchor = (a, sub)
            elif size >= shard_bytes:
                shard = close()
                yield shard.results()
                before.append(shard.strings(anchor))
                rows, size = [], 0
            rows.append((anchor, i, p, s, text))
            size += len(text)
    if rows:
        yield close().results()


# ---- the operator


def _fetch(batches: Iterator[pa.RecordBatch], length: int):
    """The bytes of a document's runs."""
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["anchor", "id", "print", "start", "bytes"]
    columns: list[list] = [[] for _ in names]
    size = 0
    for batch in batches:
        ids, prints = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        runs = batch.column(3)
        for k, text in enumerate(utf8(batch.column(2))):
            for r in runs[k].as_py():
                part = text[r["start"] : r["start"] + r["count"] + length - 1]
                row = (r["anchor"], ids[k], prints[k], r["start"], part)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                size += len(part)
            if size >= PIECE_BYTES:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)
                columns, size = [[] for _ in names], 0
    if size:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)


def _cut_out(batches: Iterator[pa.RecordBatch], text_at: int, runs_at: int, length: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(text_at))]
        for part in slices(batch, sizes, 4 << 20):
            spans, kept = [], []
            for text, runs in zip(utf8(part.column(text_at)), part.column(runs_at), strict=True):
                text, mine, left, end = text or b"", [], [], 0
                runs = runs.as_py() or []
                for s, c in sorted((r["start"], r["count"]) for r in runs):
                    if mine and s <= mine[-1]["end"]:
                        mine[-1]["end"] = max(mine[-1]["end"], s + c + length - 1)
                    else:
                        mine.append({"start": s, "end": s + c + length - 1})
                for m in mine:
                    left.append(text[end : m["start"]])
                    end = m["end"]
                left.append(text[end:])
                spans.append(mine)
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(spans, kind), pa.array(kept, pa.binary())],
                [*part.schema.names, "spans", "kept"],
            )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep_text: bool = True,
    piece_bytes: int = PIECE_BYTES,
    shard_bytes: int = SHARD_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``docs`` plus ``spans`` and ``kept``: what to cut out of the UTF-8 text, and the rest.

    A byte is cut out if a string of ``length`` bytes covers it that also starts earlier, in
    a document of a smaller id or earlier in the same one. Strings are judged on the input.

    Equal strings are brought together by an anchor, a gram that they must share. Strings
    that lie side by side with one anchor travel as a run, as hashes. Runs that repeat one
    in the same piece of input are settled before the shuffle, so what all documents have
    costs a row a piece. Where an anchor comes with one content only, the first run keeps
    its strings and the others don't. Else the first run of each content goes, as bytes, to
    a shard: a suffix array orders its strings, common prefixes tell which are equal, and
    shards of one anchor are merged by binary search. An anchor of more than ``group_bytes``
    is spread over groups by a hash of each string, which equal strings share.

    Ids are whole numbers. A null id comes before all others. Rows of one id and one text
    are one document and get equal results; texts of one id come in the order of a hash.
    Null and empty texts have no bytes. An empty table gives an empty table. Columns named
    like the results are replaced, all others are kept, except the text where ``keep_text``
    is false.
    """
    assert length >= 64 + GRAM
    docs = fresh(docs, "spans", "kept")
    key = {
        "__id": F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)),
        "__print": F.xxhash64(F.col(text_col)),
    }
    texts = docs.select(
        key["__id"].alias("id"), key["__print"].alias("print"), F.col(text_col).alias("text")
    )
    long_enough = texts.where(F.octet_length("text") >= length)
    runs = cut(long_enough.mapInArrow(partial(_find_runs, length=length, piece_bytes=piece_bytes), _SCHEMA), "runs")
    order = ["anchor", "content", "id", "print", "start"]
    judged = cut(
        runs.where("kind = 0")
        .repartition("anchor")
        .sortWithinPartitions(*order)
        .mapInArrow(_judge, _SCHEMA),
        "judged",
    )
    open_runs = judged.where("kind = 2")
    large = cut(
        open_runs.groupBy("anchor")
        .agg(F.sum(F.col("count") + length - 1).alias("size"))
        .where(F.col("size") > group_bytes)
        .select("anchor", F.ceil(F.col("size") * length / group_bytes).cast("int").alias("groups")),
        "large",
    )
    by_document = open_runs.groupBy("id", "print").agg(
        F.collect_list(F.struct("anchor", "start", "count")).alias("runs")
    )
    fetched = (
        long_enough.join(by_document, ["id", "print"])
        .select("id", "print", "text", "runs")
        .mapInArrow(
            partial(_fetch, length=length),
            "anchor bigint, id bigint, print bigint, start bigint, bytes binary",
        )
    )
    marked = fetched.join(large, "anchor", "left")
    whole = marked.where("groups IS NULL").select(
        "anchor", F.lit(0).alias("sub"), "id", "print", "start", "bytes"
    )
    single = (
        marked.where("groups IS NOT NULL")
        .withColumn("k", F.explode(F.expr(f"sequence(0, length(bytes) - {length})")))
        .withColumn("bytes", F.expr(f"substring(bytes, k + 1, {length})"))
        .select(
            "anchor",
            F.pmod(F.xxhash64("bytes"), F.col("groups")).cast("int").alias("sub"),
            "id", "print", (F.col("start") + F.col("k")).alias("start"), "bytes",
        )
    )
    compared = cut(
        whole.unionByName(single)
        .repartition("anchor", "sub")
        .sortWithinPartitions("anchor", "sub", "id", "print", "start")
        .mapInArrow(
            partial(_shards, length=length, shard_bytes=shard_bytes),
            "id bigint, print bigint, start bigint, count bigint",
        ),
        "compared",
    )
    columns = ["id", "print", "start", "count"]
    repeats = (
        runs.where("kind = 1")
        .select(*columns)
        .unionByName(judged.where("kind = 1").select(*columns))
        .unionByName(compared)
    )
    per_document = cut(
        repeats.groupBy(F.col("id").alias("__id"), F.col("print").alias("__print")).agg(
            F.collect_list(F.struct("start", "count")).alias("__runs")
        ),
        "repeats",
    )
    forget(runs)
    forget(judged)
    joined = docs.withColumns(key).join(per_document, ["__id", "__print"], "left").drop("__id", "__print")
    run = partial(
        _cut_out,
        text_at=joined.columns.index(next(c for c in joined.columns if c.lower() == text_col.lower())),
        runs_at=joined.columns.index("__runs"),
        length=length,
    )
    added = "spans array<struct<start:bigint,end:bigint>>, kept binary"
    done = joined.mapInArrow(run, extended(joined.schema, added)).drop("__runs")
    return done if keep_text else done.drop(text_col)


def op10_substring_dedup(docs: DataFrame, **limits: int) -> DataFrame:
    """The contract's row per document."""
    done = remove_repeats(docs.select("doc_id", "text"), **limits)
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return done.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
