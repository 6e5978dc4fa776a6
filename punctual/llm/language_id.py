"""Language ID by cross-parsing entropy against suffix automata of labelled text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import appended, extended, fold, fresh, slices, utf8
from punctual.llm.lanes import Lanes

FOLDS = 5
SAMPLE_BYTES = 64 << 10  # of labelled text per language
PIECE_CHARS = 2048  # that one document gives
TABLE_BYTES = 128 << 20  # of the automata that a worker has in a table at a time
EDGE_BYTES = 128 << 20  # of the transitions that it keeps to make the tables of several blocks
LANES = 512
SLICE_BYTES = 8 << 20
UNKNOWN = "und"

# in Spark, what has_letter() finds, and what letters() makes a blank
LETTER, OTHERS = r"\p{L}", r"[\x00-\x60\x7b-\x7f]+"
LEVELS = 8  # of the hash of pieces from one to its half

_maybe = re.compile(r"[^\W\d_]")  # letters, and numerals such as ½ and Ⅷ


def has_letter(text: str) -> bool:
    """Whether a character of ``text`` is of one of Unicode's categories of letters."""
    return any(m[0].isalpha() for m in _maybe.finditer(text))


def letters(text: bytes | None) -> np.ndarray | None:
    """Lower-case UTF-8 bytes with each run of other ASCII as one blank; None without a letter."""
    plain = (text or b"").decode(errors="replace")
    if not has_letter(plain):
        return None
    raw = np.frombuffer(plain.lower().encode(errors="replace"), np.uint8)
    raw = np.where((raw >= 97) & (raw <= 122) | (raw >= 128), raw, np.uint8(32))
    keep = raw != 32
    keep[1:] |= raw[:-1] != 32
    return raw[keep]


def suffix_automaton(text: bytes | list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts the substrings of ``text``."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in following[p]:
            following[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = following[p][symbol]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(symbol) == q:
                    following[p][symbol] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return following


class Edges:
    """The suffix automaton of one sample as arrays of transitions, some 16 bytes a symbol."""

    def __init__(self, sample: bytes):
        following = suffix_automaton(sample)
        self.states = len(following)
        counts = np.fromiter(map(len, following), np.int32, self.states)
        n = int(counts.sum())
        byte = np.fromiter(chain.from_iterable(following), np.uint8, n)
        target = np.fromiter(chain.from_iterable(d.values() for d in following), np.int32, n)
        keep = byte > 0  # which separates pieces
        self.state = np.repeat(np.arange(self.states, dtype=np.int32), counts)[keep]
        self.byte, self.target = byte[keep], target[keep]

    def nbytes(self) -> int:
        return self.state.nbytes + self.byte.nbytes + self.target.nbytes


class Block:
    """The automata of some languages in one table, for parsing many texts at once.

    An entry is the place of the next state's row. Where the longest match ends it is the
    complement of the place to which the symbol leads from the start, as a new phrase
    begins with it. A symbol that the language lacks is a phrase of its own; that and the
    end of a text lead to a state from which each symbol begins a phrase.
    """

    def __init__(self, automata: list[Edges], known: list[int]):
        # symbols: end of text, unknown, then the bytes seen
        self.symbol = np.ones(256, np.uint8)
        self.symbol[0] = 0
        self.symbol[known] = np.arange(2, len(known) + 2)
        width = len(known) + 2
        rows = sum(a.states + 1 for a in automata)
        kind = np.int32 if rows * width < 1 << 31 else np.int64
        self.sign = 8 * np.dtype(kind).itemsize - 1
        table, start, base = np.full((rows, width), -1, kind), [], 0
        for a in automata:
            part = table[base : base + a.states + 1]
            fresh_state = (base + a.states) * width
            part[a.state, self.symbol[a.byte]] = (a.target.astype(kind) + base) * width
            begin = np.where(part[0] < 0, kind(fresh_state), part[0])
            np.copyto(part, ~begin, where=part < 0)
            part[:, 0] = fresh_state
            start.append(fresh_state)
            base += a.states + 1
        self.table, self.start = table.ravel(), np.array(start, kind)

    def phrases(self, flat: np.ndarray, lanes: Lanes) -> np.ndarray:
        """How many longest matches make up each text, by language of the block."""
        rows = lanes.spread(self.symbol[flat], 0)
        count = len(self.start)
        # lane by lane, the languages side by side, so that the living lanes come first
        state = np.tile(self.start, lanes.count)
        done = np.zeros_like(state)
        out = np.zeros((len(lanes.lengths), count), np.int64)
        so_far = np.zeros((lanes.count, count), np.int64)
        steps, bounds, order = lanes.endings()
        event = 0
        for t in range(lanes.steps):
            k = int(lanes.width[t]) * count
            at = state[:k] + np.repeat(rows[t, : lanes.width[t]], count)
            following = self.table[at]
            ended = following >> self.sign
            state[:k] = following ^ ended
            done[:k] -= ended
            if event < len(steps) and steps[event] == t:
                which = order[bounds[event] : bounds[event + 1]]
                lane = lanes.lane[which]
                now = done.reshape(-1, count)[lane]
                out[which] = now - so_far[lane]
                so_far[lane] = now
                event += 1
        return out


class Automata:
    """The automata of all languages, of each one's whole sample.

    As many languages as fit into ``table_bytes`` make a block, one with a larger sample a
    block of its own. If there are several, their tables are made anew for each slice of
    texts from transitions, of which up to ``edge_bytes`` are kept; what is beyond that is
    built from the samples again. So memory is bounded for any number of languages.
    """

    def __init__(
        self, samples: dict[str, bytes], table_bytes: int = TABLE_BYTES, edge_bytes: int = EDGE_BYTES
    ):
        self.languages = sorted(samples)
        self.samples = [samples[name] for name in self.languages]
        self.bits = np.array([np.log2(len(s) + 2) for s in self.samples])
        self.edges: dict[int, Edges] = {}
        self.edge_room = edge_bytes
        self.blocks: list[tuple[range, list[int]]] = []  # languages, bytes seen
        first, length, seen = 0, 0, set()
        for i, sample in enumerate(self.samples):
            both = seen | (set(sample) - {0})
            # at most two states a symbol, and two more
            if i > first and 8 * (length + len(sample) + i + 1 - first) * (len(both) + 2) > table_bytes:
                self.blocks.append((range(first, i), sorted(seen)))
                first, length, both = i, 0, set(sample) - {0}
            seen, length = both, length + len(sample)
        if self.languages:
            self.blocks.append((range(first, len(self.languages)), sorted(seen)))
        self.only = self._block(0) if len(self.blocks) == 1 else None

    def _edges(self, i: int) -> Edges:
        found = self.edges.get(i)
        if found is None:
            found = Edges(self.samples[i])
            if len(self.blocks) > 1 and found.nbytes() <= self.edge_room:
                self.edge_room -= found.nbytes()
                self.edges[i] = found
        return found

    def _block(self, number: int) -> Block:
        languages, known = self.blocks[number]
        return Block([self._edges(i) for i in languages], known)

    def _counts(self, texts: list[np.ndarray]) -> Iterator[tuple[range, np.ndarray]]:
        ends = np.zeros(1, np.uint8)
        flat = np.concatenate([x for t in texts for x in (t, ends)])
        lanes = Lanes(np.array([len(t) + 1 for t in texts]), LANES)
        for number, (languages, _) in enumerate(self.blocks):
            yield languages, (self.only or self._block(number)).phrases(flat, lanes)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """How many longest matches make up each text, by language."""
        return np.concatenate([counts for _, counts in self._counts(texts)], axis=1)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        plain = [letters(t) for t in texts]
        live = [i for i, t in enumerate(plain) if t is not None]
        if not live or not self.languages:
            return names, scores
        best, low = np.zeros(len(live), np.int64), np.full((len(live), 2), np.inf)
        for languages, counts in self._counts([plain[i] for i in live]):
            cost = counts * self.bits[languages.start : languages.stop]
            better = cost.min(axis=1) < low[:, 0]
            best[better] = languages.start + cost[better].argmin(axis=1)
            low = np.partition(np.concatenate([low, cost], axis=1), 1, axis=1)[:, :2]
        for i, k in zip(live, best, strict=True):
            names[i] = self.languages[k]
        if len(self.languages) == 1:
            scores[live] = 1.0
        else:
            scores[live] = low[:, 1] / low.sum(axis=1)
        return names, scores


@lru_cache(maxsize=1)
def _automata(samples: tuple) -> Automata:
    return Automata(dict(samples))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = FOLDS,
    sample_bytes: int = SAMPLE_BYTES,
    piece_chars: int = PIECE_CHARS,
) -> dict[str, bytes]:
    """A sample of text per language, from documents outside fold 0 with a language.

    At most ``sample_bytes`` of normalised text per language, in the order of a hash of the
    pieces, so that it doesn't depend on the order or number of partitions. A document gives
    ``piece_chars`` characters, from a place in its whole text that a hash of the text
    chooses; if these have no letter, those from its first letter on. Equal pieces of a
    language count once. Documents without a letter, without an id or without a language
    aren't learned from, nor counted or fetched. One pass sums the bytes of each language by
    levels of the hash, one fetches the levels that fill the sample; the driver holds about
    the samples only.
    """
    text, n = F.col("text"), F.lit(piece_chars)
    start = F.pmod(F.xxhash64(text), F.greatest(F.char_length(text) - n, F.lit(0)) + 1)
    somewhere = F.substring(text, (start + 1).cast("int"), n)
    first = F.regexp_extract(text, f"(?s){LETTER}.{{0,{piece_chars - 1}}}", 0)
    rank = F.xxhash64("piece", F.lit("rank")) / F.lit(2.0**64) + 0.5
    train = (
        docs.where((fold(id_col, folds) != 0) & F.col(lang_col).isNotNull())
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .select("lang", F.when(somewhere.rlike(LETTER), somewhere).otherwise(first).alias("piece"))
        .where("piece <> ''")
        .select("lang", "piece", rank.alias("rank"))
        .withColumn("level", F.floor(F.log2(F.greatest("rank", F.lit(2.0**-64))) * -LEVELS))
    )
    size = F.octet_length(F.ltrim(F.regexp_replace(F.lower("piece"), OTHERS, " ")))
    once = train.groupBy("lang", "rank", "level").agg(F.max(size).alias("bytes"))
    sizes = once.groupBy("lang", "level").agg(F.sum("bytes").alias("bytes")).collect()
    least: dict[str, int] = {}
    so_far: Counter = Counter()
    for r in sorted(sizes, key=lambda r: -r["level"]):
        if so_far[r["lang"]] < sample_bytes:
            least[r["lang"]] = r["level"]
            so_far[r["lang"]] += r["bytes"]
    if not least:
        return {}
    wanted = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))
    picked = train.where(F.col("level") >= wanted[F.col("lang")]).distinct().collect()
    samples: dict[str, list[bytes]] = {}
    room = dict.fromkeys(least, sample_bytes)
    for r in sorted(picked, key=lambda r: (r["rank"], r["piece"])):
        plain = letters(r["piece"].encode())
        if plain is not None and room[r["lang"]] > 0:
            part = plain.tobytes()[: room[r["lang"]]]
            room[r["lang"]] -= len(part)
            samples.setdefault(r["lang"], []).append(part)
    return {name: b"\0".join(parts) for name, parts in samples.items()}


def predict(docs: DataFrame, samples: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``.

    A text is cut from the left into the longest pieces that occur in a language's sample.
    The language with the fewest phrases, each weighted by the bits that point into its
    sample, wins; of equals the first by name. ``score`` is the share of the runner-up in
    the sum of both costs: 0.5 where both are equal, towards 1 where the winner needs far
    fewer; 1 if only one language is known. Case, digits and ASCII punctuation don't count.

    A null text or one without a letter is ``und`` with score 0, as is any text if nothing
    was learned. Whole texts are parsed. Columns named like the results are replaced, all
    others are kept.
    """
    docs = fresh(docs, "lang_pred", "score")
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    sent = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples.items())))
    return docs.mapInArrow(
        partial(_predict, at=at, sent=sent),
        extended(docs.schema, "lang_pred string, score double"),
    )


def _predict(batches: Iterator[pa.RecordBatch], at: int, sent):
    automata = _automata(sent.value)
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(at))]
        for part in slices(batch, sizes, SLICE_BYTES):
            names, scores = automata.predict(utf8(part.column(at)))
            yield appended(part, ["lang_pred", "score"], [pa.array(names, pa.string()), pa.array(scores)])


def op8_language_id(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    done = predict(docs.select("doc_id", "text"), learn(docs)).drop("text")
    held_out = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False))
    return done.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
