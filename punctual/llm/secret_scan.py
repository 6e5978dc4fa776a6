"""Secret scans: fixed patterns, and strings that look drawn at random rather than named."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import appended, extended, fresh, slices, utf8

KINDS = ("assign", "access", "hex", "random")  # in the order in which spans of one start stand
BASE = KINDS[:3]
SLICE_BYTES = 4 << 20
SAMPLE_DOCS = 20_000
MIN_LENGTH = 16  # of a random string
EVIDENCE = 20.0  # how much likelier a string must be as a random one, as a logarithm
ORDINARY = (4, 64)  # characters of an ordinary sample
SMOOTH = 8.0  # occurrences that the next shorter context counts for

# The base patterns, with the least characters of what must be that long.
ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SYMBOLS = len(ALPHABET) + 1  # and what stands before a string
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, SYMBOLS)
_RUN = _CODE > 0
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPLIT = bytes(b if _RUN[b] else 32 for b in range(256))
# Words and numbers, alone or joined by signs; what mixes letters and digits is no sample.
_NAMED = re.compile(rb"[+/_.=-]*(?:(?:[A-Za-z]+|[0-9]+)(?:[+/_.=-]+|\Z))+")


# ---- finding runs and patterns


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins, with the end behind."""
    texts = utf8(column)
    lengths = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
    flat = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    return flat, np.concatenate([[0], np.cumsum(lengths)])


def _runs(inside: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that don't cross a bound, of ``least`` places or more."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(inside))]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    keep = end - start >= least
    return start[keep], end[keep]


def _hits(text: bytes, words: tuple[bytes, ...], bounds: np.ndarray) -> list[int]:
    """The rows that hold one of ``words``."""
    rows = set()
    for word in words:
        at = text.find(word)
        while at >= 0:
            row = int(np.searchsorted(bounds, at, "right")) - 1
            rows.add(row)
            at = text.find(word, int(bounds[row + 1]))
    return sorted(rows)


def base_spans(flat: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, in bytes of ``flat``, by start and kind.

    A match too short for its kind is dropped, and what it covers isn't searched again.
    """
    text = flat.tobytes()
    found = []
    for row in _hits(text.translate(_LOWER), KEYWORDS, bounds):
        begin, end = int(bounds[row]), int(bounds[row + 1])
        for m in ASSIGN.finditer(text[begin:end]):
            if len(m[1]) >= MIN_ASSIGN:
                found.append((0, begin + m.start(), begin + m.end()))
    for row in _hits(text, (b"AKIA",), bounds):
        begin, end = int(bounds[row]), int(bounds[row + 1])
        for m in ACCESS.finditer(text[begin:end]):
            if len(m[0]) >= MIN_ACCESS:
                found.append((1, begin + m.start(), begin + m.end()))
    start, end = _runs(_HEX[flat], bounds, MIN_HEX)
    found += [(2, s, e) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    return sorted(found, key=lambda x: (x[1], x[0]))


# ---- the two models


@dataclass
class Model:
    """``ratio[a, b, c]``: logarithm of how much likelier ``c`` follows ``a b`` in a random
    string than in an ordinary one."""

    ratio: np.ndarray
    counts: np.ndarray  # by class (ordinary, random) and the three symbols


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (sample: binary, random: boolean) from texts.

    Random ones are what the fixed patterns take for secrets (the value alone); ordinary
    ones are runs of 4 to 64 letters, digits and ``+/_.=-`` whose letters and digits are
    apart, i.e. words, names of several words, numbers and dates. Each counts once, however
    often it occurs, so a group of copies teaches no more than one of them.
    """
    slim = docs.select(F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_label, "sample binary, random boolean").distinct()


def _label(batches: Iterator[pa.RecordBatch]):
    least, most = ORDINARY
    for batch in batches:
        for part in slices(batch, [len(t or b"") for t in utf8(batch.column(0))], SLICE_BYTES):
            flat, bounds = _flat(part.column(0))
            text = bytearray(flat.tobytes())
            random = set()
            for kind, start, end in base_spans(flat, bounds):
                value = bytes(flat[start:end])
                if kind == 0:
                    value = ASSIGN.match(value)[1]
                random.add(value.removeprefix(b"AKIA") if kind == 1 else value)
                text[start:end] = b" " * (end - start)
            ends = bounds.tolist()
            apart = b" ".join(text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
            ordinary = {
                w
                for w in set(apart.translate(_SPLIT).split())
                if least <= len(w) <= most and _NAMED.fullmatch(w)
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*random, *ordinary], pa.binary()),
                    pa.array([True] * len(random) + [False] * len(ordinary), pa.bool_()),
                ],
                ["sample", "random"],
            )


def train(samples: DataFrame) -> Model:
    """The model of (sample, random) rows; null samples and labels are ignored.

    Spark counts symbol triples; the driver gets at most one count a triple and class. A
    context's counts are smoothed by those of the next shorter one, and at last by all
    symbols being equally likely, so a class without a sample is that of uniform strings.
    """
    rows = samples.select(
        F.col("sample").cast("binary").alias("sample"), F.col("random")
    ).where("sample IS NOT NULL AND random IS NOT NULL")
    cells = rows.mapInArrow(_triples, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(2 * SYMBOLS**3)
    for row in cells.collect():
        counts[row["cell"]] = row["n"]
    counts = counts.reshape(2, SYMBOLS, SYMBOLS, SYMBOLS)
    ordinary, random = (np.log(_smoothed(c)) for c in counts)
    return Model((random - ordinary).astype(np.float32), counts)


def _triples(batches: Iterator[pa.RecordBatch]):
    counts = np.zeros(2 * SYMBOLS**3, np.int64)
    for batch in batches:
        flat, bounds = _flat(batch.column(0))
        label = np.asarray(batch.column(1).to_pylist(), np.int64)
        triple = _cells(flat, bounds[:-1][np.diff(bounds) > 0])
        kept = _RUN[flat]
        cell = triple + np.repeat(label, np.diff(bounds)) * SYMBOLS**3
        counts += np.bincount(cell[kept], minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["cell", "n"]
    )


def _cells(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The triple that ends at each place, as one number; runs begin at ``starts``."""
    code = _CODE[flat]
    one, two = np.zeros_like(code), np.zeros_like(code)
    one[1:], two[2:] = code[:-1], code[:-2]
    one[starts] = two[starts] = 0
    second = starts + 1
    two[second[second < len(code)]] = 0
    return (two * SYMBOLS + one) * SYMBOLS + code


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the third symbol after the first two."""
    p = np.full(SYMBOLS, 1 / (SYMBOLS - 1))
    for level in (counts.sum((0, 1)), counts.sum(0), counts):
        p = (level + SMOOTH * p) / (level.sum(-1, keepdims=True) + SMOOTH)
    return p


def random_spans(
    flat: np.ndarray, bounds: np.ndarray, ratio: np.ndarray, least: int, evidence: float
) -> list[tuple[int, int, float]]:
    """(start, end, score) of the runs that the model takes for random, by start.

    In each run of symbols the stretch with the largest sum of log-likelihood ratios
    counts, so a key at the end of a path is found too. It is widened to whole words of
    letters and digits; its sum must reach ``evidence``, its length ``least``.
    """
    inside = _RUN[flat]
    start, end = _runs(inside, bounds, least)
    if not len(start):
        return []
    size = end - start
    begin = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(begin[-1]) + np.repeat(start - begin[:-1], size)
    gain = ratio.reshape(-1)[_cells(flat[place], begin[:-1])].astype(np.float64)
    # the best stretch is the sums' highest rise, with each run lifted clear of the one
    # before; that is for choosing runs only, as its rounding depends on the neighbours
    total = np.concatenate([[0.0], np.cumsum(gain)])
    clear = np.repeat(np.arange(len(size)), size) * (4 * np.abs(ratio).max() * (size.max() + 1.0))
    rise = total[1:] - clear - np.minimum.accumulate(total[:-1] - clear)
    found = []
    for i in np.flatnonzero(np.maximum.reduceat(rise, begin[:-1]) >= evidence - 1).tolist():
        a, b = int(begin[i]), int(begin[i + 1])
        sums = np.concatenate([[0.0], np.cumsum(gain[a:b])])
        stop = int(np.argmax(sums[1:] - np.minimum.accumulate(sums[:-1]))) + 1
        first = int(np.argmin(sums[:stop]))
        if sums[stop] - sums[first] < evidence:
            continue
        solid = _CODE[flat[place[a:b]]] <= 62
        while first > 0 and solid[first - 1] and solid[first]:
            first -= 1
        while stop < b - a and solid[stop] and solid[stop - 1]:
            stop += 1
        score = float(sums[stop] - sums[first])
        if stop - first >= least and score >= evidence:
            found.append((int(place[a + first]), int(place[a + stop - 1]) + 1, score))
    return found


# ---- the operator


def sample(docs: DataFrame, id_col: str = "doc_id", most: int = SAMPLE_DOCS) -> DataFrame:
    """About ``most`` documents, the same ones each time, chosen by their ids' hash."""
    rate = min(1.0, most / max(1, docs.count()))
    return docs if rate == 1 else docs.where(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < int(rate * 1_000_000)
    )


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCS) -> Model:
    """A model from the documents themselves, labelled by the fixed patterns.

    It is fitted on at most about ``most`` documents (``sample_docs``); the scan itself
    reads all of them.
    """
    return train(labelled_samples(sample(docs, id_col, most), text_col))


def scan(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    least: int = MIN_LENGTH,
    evidence: float = EVIDENCE,
) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end, score), by start and kind.

    Places count code points, the end is exclusive. Kinds ``assign``, ``access`` and ``hex``
    are the fixed patterns (score NULL), found from left to right without overlaps in a
    kind. ``random`` are strings of ``least`` or more letters, digits and ``+/_.=-`` whose
    log-likelihood as a random string exceeds that as an ordinary one by ``evidence``; those
    that overlap a fixed pattern are left to it. Null and empty texts have none. Texts are
    read whole, whatever their length; each row gives a row, repeated ones too. A column
    ``secrets`` of the input is replaced; other columns stay as they are.
    """
    rows = fresh(docs, "secrets")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model.ratio)
    added = "secrets array<struct<kind:string,start:int,end:int,score:double>>"
    place = rows.columns.index(text_col)
    return rows.mapInArrow(
        partial(_scan, place=place, sent=sent, least=least, evidence=evidence),
        extended(rows.schema, added),
    )


def _scan(batches: Iterator[pa.RecordBatch], place: int, sent, least: int, evidence: float):
    for batch in batches:
        for part in slices(batch, [len(t or b"") for t in utf8(batch.column(place))], SLICE_BYTES):
            flat, bounds = _flat(part.column(place))
            base = base_spans(flat, bounds)
            taken = np.zeros(len(flat) + 1, bool)
            for _, start, end in base:
                taken[start:end] = True
            spans = [(start, kind, end, None) for kind, start, end in base]
            spans += [
                (start, 3, end, score)
                for start, end, score in random_spans(flat, bounds, sent.value, least, evidence)
                if not taken[start:end].any()
            ]
            spans.sort(key=lambda x: x[:2])
            yield appended(part, ["secrets"], [_column(flat, bounds, spans)])


def _column(flat: np.ndarray, bounds: np.ndarray, spans: list) -> pa.Array:
    """Spans in bytes of all texts as a list a row, in code points of its text."""
    leads = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80, dtype=np.int32)])
    start = np.array([s[0] for s in spans], np.int64)
    end = np.array([s[2] for s in spans], np.int64)
    row = np.searchsorted(bounds, start, "right") - 1
    zero = leads[bounds[row]] if len(row) else row
    kinds = pa.array([KINDS[s[1]] for s in spans], pa.string())
    fields = [
        kinds,
        pa.array((leads[start] - zero).astype(np.int32)),
        pa.array((leads[end] - zero).astype(np.int32)),
        pa.array([s[3] for s in spans], pa.float64()),
    ]
    n = np.searchsorted(row, np.arange(len(bounds)))
    return pa.ListArray.from_arrays(
        pa.array(n.astype(np.int32)),
        pa.StructArray.from_arrays(fields, ["kind", "start", "end", "score"]),
    )


def op11_secret_scan(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    found = scan(docs.select("doc_id", "text"), learn(docs)).drop("text")

    def joined(kinds: tuple[str, ...]):
        mine = F.filter("secrets", lambda s: s["kind"].isin(*kinds))
        text = F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(text, ",")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined(BASE).cast("binary"), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        count("random").alias("n_random"),
    )
