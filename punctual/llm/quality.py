"""Quality classifier: Naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import appended, cut, extended, fold, fresh, slices, utf8

FOLDS = 5
THRESHOLD = 0.3
BITS = 18
WORD_BYTES = 32  # longer words count by their first bytes and their length
SAMPLE_DOCS = 8_000
CALIBRATION = 4  # one sampled document in so many sets the scale of the scores
PASSES = 12
COST = 1.0
SLICE_BYTES = 2 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def features(texts: list[bytes | None], bits: int = BITS) -> list[np.ndarray]:
    """The distinct n-grams of each text as numbers below ``2 ** bits``.

    N-grams are words, pairs of neighbouring words and three neighbouring bytes, all as
    written. A word that repeats the one before it counts as a mark instead.
    """
    raw = [t or b"" for t in texts]
    buf = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.cumsum(sizes + 1) - sizes
    blank = _BLANK[buf]
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    length = last - first
    h = length.astype(np.uint64)
    live = np.arange(len(first))
    for k in range(min(WORD_BYTES, int(length.max(initial=0)))):
        live = live[length[live] > k]
        h[live] = (h[live] ^ buf[first[live] + k]) * _MULTIPLIER
        h[live] ^= h[live] >> np.uint64(32)
    bounds = np.searchsorted(first, np.append(begin, len(buf)))
    new_doc = np.zeros(len(h) + 1, bool)
    new_doc[bounds] = True
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & ~new_doc[1 : len(h)]
    h[same] = np.uint64(1)
    shift = np.uint64(64 - bits)
    single = (_mix(h) * _MULTIPLIER >> shift).astype(np.int32)
    pair = (_mix(h[:-1] * np.uint64(3) + _mix(h[1:])) * _MULTIPLIER >> shift).astype(np.int32)
    wide = buf.astype(np.uint64)
    three = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)
    three = (_mix(three + np.uint64(1 << 40)) * _MULTIPLIER >> shift).astype(np.int32)
    seen = np.empty(1 << bits, np.int32)
    out = []
    for i in range(len(raw)):
        a, b = bounds[i], bounds[i + 1]
        at = int(begin[i])
        f = np.concatenate(
            [single[a:b], pair[a : max(a, b - 1)], three[at : max(at, at + int(sizes[i]) - 2)]]
        )
        order = np.arange(len(f), dtype=np.int32)
        seen[f] = order
        out.append(f[seen[f] == order])
    return out


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    scale: float
    shift: float

    def margin(self, f: np.ndarray) -> float:
        r = self.ratio[f]
        norm = np.sqrt(r @ r)
        return float(self.weights[f] @ r / norm + self.weights[-1]) if norm else float(self.weights[-1])

    def score(self, f: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.margin(f) + self.shift, -500, 500))))


def log_count_ratio(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Log of the ratio of the classes' smoothed and normalised n-gram counts."""
    p, q = positive + 1.0, negative + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = COST, passes: int = PASSES
) -> np.ndarray:
    """Weights of a linear model with hinge loss, by dual coordinate descent.

    Rows are scaled to length one, the last weight is the bias. Both classes have the same
    total cost. Rows are visited in a random but fixed order.
    """
    values = []
    for f in rows:
        r = ratio[f]
        values.append(r / max(np.sqrt(r @ r), 1e-12))
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.array([max(1, (y < 0).sum()), max(1, (y > 0).sum())])
    upper = cost * len(y) / (2.0 * np.where(y > 0, share[1], share[0]))
    w = np.zeros(len(ratio) + 1)
    alpha = np.zeros(len(y))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            f, v = rows[i], values[i]
            slope = y[i] * (w[f] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[f] += step * y[i] * v
                w[-1] += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make a margin the log-odds of label 1, by Newton's method."""
    hits, misses = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (hits + 1.0) / (hits + 2.0), 1.0 / (misses + 2.0))
    x = np.stack([margins, np.ones(len(margins))])
    theta = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -500, 500)))
        gradient = x @ (p - target) + 1e-6 * theta
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def fit(
    counts: tuple[np.ndarray, np.ndarray], rows: list[np.ndarray], labels: np.ndarray
) -> Model:
    """A model from the classes' n-gram counts and a sample in random order."""
    ratio = log_count_ratio(*counts)
    part = np.arange(len(rows)) % CALIBRATION == 0
    if len(np.unique(labels[~part])) < 2:
        part[:] = False
    weights = descend([r for r, p in zip(rows, part, strict=True) if not p], labels[~part], ratio)
    model = Model(ratio, weights, 1.0, 0.0)
    if part.any():
        margins = np.array([model.margin(r) for r, p in zip(rows, part, strict=True) if p])
        model.scale, model.shift = calibrate(margins, labels[part])
    return model


_LEARNED = "f bigint, pos bigint, neg bigint, rank bigint, label int, features binary"


def _learned(batches: Iterator[pa.RecordBatch], limit: int):
    """Counts of n-grams per class, with those of documents at -1, and the sampled rows."""
    names = [part.split()[0] for part in _LEARNED.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]

    def rows(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind)
                for name, kind in zip(names, kinds, strict=True)
            ],
            names,
        )

    counts = np.zeros((2, 1 << BITS), np.int64)
    documents = np.zeros(2, np.int64)
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(2))]
        for part in slices(batch, sizes, SLICE_BYTES):
            ranks, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
            found = features(utf8(part.column(2)))
            for label, f in zip(labels, found, strict=True):
                counts[label][f] += 1
                documents[label] += 1
            picked = [k for k, rank in enumerate(ranks) if rank < limit]
            if picked:
                yield rows(
                    rank=[ranks[k] for k in picked],
                    label=[labels[k] for k in picked],
                    features=[found[k].tobytes() for k in picked],
                )
    if documents.any():
        seen = np.flatnonzero(counts.any(axis=0))
        yield rows(
            f=np.append(seen, -1),
            pos=np.append(counts[1][seen], documents[1]),
            neg=np.append(counts[0][seen], documents[0]),
        )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = FOLDS,
    sample_docs: int = SAMPLE_DOCS,
) -> Model | None:
    """The model, from labelled documents outside fold 0; None without both labels.

    The classes' n-gram counts cover all labelled documents. The linear model and the scale
    of its scores are fitted on at most ``sample_docs`` of them, those of the smallest hash
    of the id, so that it doesn't depend on partitions. The driver holds that sample's
    n-gram numbers and one count per number and class. Texts are shuffled once, to their
    labels, whatever the sizes: neither side is bounded, so none is broadcast. Rows with a
    null label or id are left out; a label other than 0 counts as 1.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) != 0).cast("int").alias("label")
    ).where(fold("id", folds) != 0).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        fold("id", folds) != 0
    )
    share = 1.2 * sample_docs / max(1, known.count())
    limit = min(int(share * 2.0**64) - 2**63, 2**63 - 1)
    learned = cut(
        texts.join(known.hint("merge"), "id")
        .select(F.xxhash64("id").alias("rank"), "label", "text")
        .mapInArrow(partial(_learned, limit=limit), _LEARNED),
        "learned",
    )
    counts = np.zeros((2, (1 << BITS) + 1), np.int64)  # documents come last
    summed = (
        learned.where("f IS NOT NULL")
        .groupBy("f")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .toArrow()
    )
    f = summed["f"].to_numpy()
    counts[1][f], counts[0][f] = summed["pos"].to_numpy(), summed["neg"].to_numpy()
    if not counts[:, -1].all():
        return None
    order = ["rank", "label", "features"]
    sample = learned.where("rank IS NOT NULL").select(*order).orderBy(*order).limit(sample_docs)
    got = sample.toArrow()
    return fit(
        (counts[1][:-1], counts[0][:-1]),
        [np.frombuffer(blob.as_buffer(), np.int32) for blob in got["features"]],
        got["label"].to_numpy(),
    )


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``score``, the model's probability of label 1, and ``predicted``.

    A null or empty text has no n-grams and gets the score of the bias; without a model all
    scores are 0.5. Whole texts are read. Columns named like the results are replaced, all
    others are kept.
    """
    docs = fresh(docs, "score", "predicted")
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.mapInArrow(
        partial(_predict, at=at, sent=sent), extended(docs.schema, "score double")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _predict(batches: Iterator[pa.RecordBatch], at: int, sent):
    model = sent.value
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(at))]
        for part in slices(batch, sizes, SLICE_BYTES):
            scores = [model.score(f) if model else 0.5 for f in features(utf8(part.column(at)))]
            yield appended(part, ["score"], [pa.array(scores, pa.float64())])


def op7_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document."""
    done = predict(docs.select("doc_id", "text"), learn(docs, labels)).drop("text")
    held_out = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False))
    return done.select("doc_id", held_out.alias("held_out"), "score", "predicted")
