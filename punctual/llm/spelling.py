"""Spelling variants: words that differ by one character, found by variable-length grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import UPPER, cut

MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2
RATIO = 10  # how much more frequent a word's form is
DROP_ONE_IN = 31
SHORTEST = 2  # characters of a gram
FREQUENT = 1024  # a gram with more than one in so many places is extended
HOT_LIST = 32_768  # words of a list that one task compares, which takes under a second

_RUN = f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the contract: runs of letters, a few of them with a character dropped.

    Runs shorter than a word can't become one, so they are left at once.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(_RUN), F.lit(0))).alias("run"),
    )
    plain = F.octet_length("run") == F.char_length("run")
    lower = F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, UPPER.lower()))
    size = F.char_length("run").cast("long")
    at = (F.col("h") % size).cast("int")
    dropped = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))
    )
    return (
        runs.select("id", lower.alias("run"))
        .withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        .select(F.when(F.col("h") % DROP_ONE_IN == 0, dropped).otherwise(F.col("run")).alias("word"))
        .where(F.char_length("word") >= MIN_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= MIN_COUNT)
    )


# ---- the grams


def gram_dictionary(words: DataFrame, longest: int, frequent: int = FREQUENT) -> frozenset[str]:
    """The grams that are extended: those of more than one in ``frequent`` places.

    A gram begins with two characters. While it is frequent it is extended by the next one,
    up to ``longest``, so common beginnings give longer and rarer grams. The dictionary is
    pruned to what decides that: fewer than ``frequent`` grams of each length, however many
    words there are.
    """
    found: set[str] = set()
    for size in range(SHORTEST, longest):
        places = F.sequence(F.lit(1), F.char_length("word") - size + 1)
        grams = (
            words.where(F.char_length("word") >= size)
            .select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(size)))).alias("gram"))
            .groupBy("gram")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        total = grams.agg(F.sum("n").alias("total")).scalar()
        rows = grams.where(F.col("n") * frequent > total).select("gram").collect()
        found |= {r["gram"] for r in rows}
    return frozenset(found)


def grams(word: str, dictionary: frozenset[str], longest: int) -> list[tuple[int, int]]:
    """(start, end) of the word's variable grams; one inside the gram before it is left out."""
    size, found, reach = len(word), [], 0
    for p in range(size - SHORTEST + 1):
        end = p + SHORTEST
        while end - p < longest and end < size and word[p:end] in dictionary:
            end += 1
        if end > reach:
            found.append((p, end))
            reach = end
    return found


def unaffected(word: str, own: list[tuple[int, int]], dictionary: frozenset[str], longest: int) -> int:
    """How many contexts (see ``marks``) a word of one edit away shares with it at least.

    An edit splits a word into what stands before and behind it. Before it, grams are
    affected from the first on that reaches the edit or could be extended by what it
    changes. Behind it, those are affected that a gram from before could cover. A context
    as long as the shorter of two words counts for nothing, as no word has it of itself.
    """
    size = len(word)
    least = size
    for at in range(size + 1):
        stop = at  # where the first affected gram starts
        for p in range(max(0, at - longest + 1), at):
            if at - p < SHORTEST or word[p:at] in dictionary:
                stop = p
                break
        left = [end for p, end in own if p < stop and end <= at]
        for behind in (at, at + 1):  # a character is added, or lost or replaced
            if behind > size:
                continue
            right = [size - p for p, end in own if p >= behind and end - behind >= longest]
            # lost at either end, the other word is what remains; added, it is this one
            whole = size if behind == at else size - 1
            least = min(least, sum(x < whole for x in left) + sum(x < whole for x in right))
    return least


def marks(word: str, dictionary: frozenset[str], longest: int) -> list[int]:
    """The lists that a word is in, as 2 * length + 1 for a beginning and 2 * length for an
    ending of the word.

    A gram that an edit leaves alone has the same characters before it, or the same behind
    it, in both words. So a gram is listed with all of the word up to its end, and with all
    from its start on. Of these contexts the shortest, which have the longest lists, are
    left out: one less than those that any word of one edit away shares.

    A word of more than 4 * ``longest`` characters needs no more than 2 * ``longest`` lists.
    Before the edit or behind it stands half of it or more, and there every gram is left
    alone that ends ``longest`` characters or more from the edit. In each ``longest``
    lengths there is a context, so those just below that are enough. The shortest word of
    this kind has the lists of both kinds, as words on either side can be near it.
    """
    own = grams(word, dictionary, longest)
    size = len(word)
    found = sorted(
        [2 * end + 1 for _, end in own if end < size] + [2 * (size - p) for p, _ in own if p],
        reverse=True,
    )
    least = 4 * longest + 1
    half = (size - 1) // 2
    middle = [m for m in found if size >= least and half - 2 * longest < m // 2 <= half - longest]
    if size > least:
        return middle
    shared = unaffected(word, own, dictionary, longest)
    some = found[: len(found) - max(0, shared - 1)]
    return some + [m for m in middle if m not in some]


def _marked(batches: Iterator[pa.RecordBatch], sent, longest: int):
    for batch in batches:
        lists = [marks(w, sent.value, longest) for w in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lists, pa.list_(pa.int32()))], ["word", "n", "marks"]
        )


def inverted_lists(words: DataFrame, longest: int, frequent: int = FREQUENT) -> DataFrame:
    """The index: a row per word and context, with the context's hash as ``key``."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(gram_dictionary(words, longest, frequent))
    # the words are few bytes, and so few files; what is done to each takes longer to do
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = words.select("word", "n").repartition(tasks, "word").mapInArrow(
        partial(_marked, sent=sent, longest=longest), "word string, n bigint, marks array<int>"
    )
    mark, half = F.col("mark"), (F.col("mark") / 2).cast("int")
    beginning = F.xxhash64(F.lit(1), F.substring("word", F.lit(1), half))
    ending = F.xxhash64(F.lit(0), F.substring("word", -half, half))
    return cut(marked, "marked").withColumn("mark", F.explode("marks")).withColumn(
        "key", F.when(mark % 2 == 1, beginning).otherwise(ending)
    )


# ---- comparing the words of a list

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Words:
    """The words of some lists, flat, with hashes of each and of it without one character."""

    def __init__(self, texts: list[str], lists: np.ndarray):
        self.lists = lists
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.start = np.cumsum(self.size) - self.size
        codes = "".join(texts).encode("utf-32-le", "surrogatepass")
        self.codes = np.frombuffer(codes, np.uint32).astype(np.uint64)
        self.row = np.repeat(np.arange(len(texts)), self.size)
        self.at = np.arange(len(self.codes)) - self.start[self.row]
        longest = int(self.size.max(initial=0))
        power = np.cumprod(np.full(longest + 1, _BASE))[: longest + 1] * _BACK
        with np.errstate(over="ignore"):
            each = self.codes * power[self.at]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each)])
            before = total[:-1] - total[self.start[self.row]]
            whole = total[self.start + self.size] - total[self.start]
            shorter = before + (whole[self.row] - before - each) * _BACK
            own = (self.lists.astype(np.uint64) + np.uint64(1)) * _MIX
            self.whole = _mixed(whole + own, self.size)
            self.shorter = _mixed(shorter + own[self.row], self.size[self.row] - 1)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a list whose hashes say that they differ by one character."""
        replaced = _equal(_mixed(self.shorter, self.at))
        one, other = self.row[replaced[0]], self.row[replaced[1]]
        order = np.argsort(self.whole, kind="stable")
        sorted_whole = self.whole[order]
        low = np.searchsorted(sorted_whole, self.shorter, "left")
        count = np.searchsorted(sorted_whole, self.shorter, "right") - low
        added = np.repeat(np.arange(len(low)), count)
        step = np.arange(len(added)) - np.repeat(np.cumsum(count) - count, count)
        one = np.concatenate([one, self.row[added]])
        other = np.concatenate([other, order[low[added] + step]])
        both = np.unique(np.stack([np.minimum(one, other), np.maximum(one, other)]), axis=1)
        return both[0], both[1]

    def common(self, one: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
        """How many characters the words share from the start (1) or from the end (-1)."""
        least = np.minimum(self.size[one], self.size[other])
        first, second = self.start[one], self.start[other]
        if step < 0:
            first, second = first + self.size[one] - 1, second + self.size[other] - 1
        shared = np.zeros(len(one), np.int64)
        alive = np.flatnonzero(least > 0)
        while len(alive):
            k = shared[alive]
            same = self.codes[first[alive] + step * k] == self.codes[second[alive] + step * k]
            alive = alive[same]
            shared[alive] += 1
            alive = alive[shared[alive] < least[alive]]
        return shared


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * _MIX + y.astype(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * _BASE
        return x ^ (x >> np.uint64(31))


def _equal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places with equal values."""
    order = np.argsort(x, kind="stable")
    x = x[order]
    one, other, apart = [], [], 1
    near = np.flatnonzero(x[1:] == x[:-1])
    while len(near):
        one.append(order[near])
        other.append(order[near + apart])
        apart += 1
        near = near[near + apart < len(x)]
        near = near[x[near] == x[near + apart]]
    none = np.zeros(0, np.int64)
    return (np.concatenate(one), np.concatenate(other)) if one else (none, none)


def _compared(table: pa.Table) -> pa.RecordBatch:
    """Near words of whole lists, in both directions, each pair in one of its lists only."""
    texts = table["word"].to_pylist()
    key = table["key"].to_numpy()
    n, mark = table["n"].to_numpy(), table["mark"].to_numpy().astype(np.int64)
    lists = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else key
    some = _Words(texts, lists)
    one, other = some.pairs()
    left, right = some.common(one, other, 1), some.common(one, other, -1)
    short = np.minimum(some.size[one], some.size[other])
    long = np.maximum(some.size[one], some.size[other])
    near = (short == long) & (left + right == long - 1)
    near |= (short == long - 1) & (left + right >= short)
    near &= (lists[one] == lists[other]) & (mark[one] == mark[other])
    one, other, left, right = (x[near] for x in (one, other, left, right))
    # of the lists that have both, the one of the longest context
    marks = table["marks"].combine_chunks()
    bounds, flat = marks.offsets.to_numpy().astype(np.int64), marks.values.to_numpy().astype(np.int64)
    count = np.diff(bounds)
    codes = np.repeat(np.arange(len(count)), count) * (1 << 32) + flat[bounds[0] : bounds[-1]]
    codes = np.sort(codes)
    pair = np.repeat(np.arange(len(one)), count[one])
    step = np.arange(len(pair)) - np.repeat(np.cumsum(count[one]) - count[one], count[one])
    mine = flat[bounds[one][pair] + step]
    wanted = other[pair] * (1 << 32) + mine
    there = codes[np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)] == wanted if len(codes) else wanted > 0
    there &= mine >> 1 <= np.where(mine & 1, left[pair], right[pair])
    best = np.zeros(len(one), np.int64)
    np.maximum.at(best, pair[there], mine[there])
    kept = best == mark[one]
    one, other = one[kept], other[kept]
    column = table["word"].combine_chunks()
    a, b = np.concatenate([one, other]), np.concatenate([other, one])
    return pa.RecordBatch.from_arrays(
        [column.take(pa.array(a)), column.take(pa.array(b)), pa.array(n[b])], ["word", "near", "near_n"]
    )


def _near(batches: Iterator[pa.RecordBatch]):
    """Lists lie one after the other; the last of a batch may go on in the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1])
        last = int(change[-1]) + 1 if len(change) else 0
        if waiting and waiting[-1].column("key")[-1].as_py() != key[0]:
            yield _compared(pa.Table.from_batches(waiting))
            waiting = []
        if last:
            yield _compared(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield _compared(pa.Table.from_batches(waiting))


def _split(batches: Iterator[pa.RecordBatch]):
    """Rows of too long lists, once for each hash under which a near word of theirs is."""
    for batch in batches:
        some = _Words(batch.column("word").to_pylist(), np.zeros(batch.num_rows, np.int64))
        key = batch.column("key").to_numpy().astype(np.uint64)
        row = np.concatenate([some.row, np.arange(batch.num_rows)])
        part = np.concatenate([some.shorter, some.whole])
        found = np.unique(np.stack([row.astype(np.uint64), _mixed(part, key[row])]), axis=1)
        taken = batch.take(pa.array(found[0].astype(np.int64)))
        place = batch.schema.get_field_index("key")
        yield taken.set_column(place, "key", pa.array(found[1].view(np.int64)))


def near_words(words: DataFrame, shortest: int = MIN_LENGTH, frequent: int = FREQUENT, hot: int = HOT_LIST) -> DataFrame:
    """(word, near, near_n) for all words of one insertion, deletion or replacement apart.

    ``words`` has (word, n), each word once. Grams have at most half as many characters as
    the shortest word, so an edit always leaves one alone. A list of more than ``hot``
    words goes to many tasks: by the hash of the word and of what is left of it without
    one character, of which near words have one in common.
    """
    longest = shortest // 2
    if longest < SHORTEST:
        raise ValueError(f"words need {2 * SHORTEST} characters or more")
    lists = inverted_lists(words, longest, frequent)
    large = cut(lists.groupBy("key").count().where(F.col("count") > hot).select("key"), "hot")
    if large.isEmpty():
        return _listed(lists)
    few = lists.join(large, "key", "left_anti").select(lists.columns)
    many = lists.join(large, "key", "left_semi").select(lists.columns)
    # words can have more than one such hash in common
    return _listed(few).unionByName(_listed(many.mapInArrow(_split, lists.schema)).distinct())


def _listed(lists: DataFrame) -> DataFrame:
    return (
        lists.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_near, "word string, near string, near_n bigint")
    )


def variant_groups(words: DataFrame, ratio: int = RATIO, shortest: int = MIN_LENGTH, frequent: int = FREQUENT, hot: int = HOT_LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table (word, n) of distinct words.

    ``form`` is the near word of largest n (of equal ones the smallest by code points) where
    that n is at least ``ratio`` times the word's, else NULL. ``root`` follows forms to the
    last; a word without a form is its own root. Chains are followed by doubling: each step
    multiplies n by ``ratio``, so there are few. Null words and counts are ignored, rows of
    one word are added up, and words shorter than ``shortest`` are an error. An empty table
    gives no rows.
    """
    once = cut(
        words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    if not once.where(F.char_length("word") < shortest).isEmpty():
        raise ValueError(f"a word has fewer than {shortest} characters")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    seen = near_words(once, shortest, frequent, hot).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    joined = cut(
        once.join(seen, "word", "left").select(
            "word",
            F.when(enough, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return joined.join(_roots(joined), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form."""
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        roots = cut(roots, "roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots
        further: Column = F.coalesce("next", "root")
        roots = roots.join(ahead, "root", "left").select("word", further.alias("root"))


def op13_spelling(docs: DataFrame) -> DataFrame:
    """The contract's row per word."""
    return variant_groups(words(docs))
