"""Embedding near-dedup: PCA-ordered tiles whose products stop at a bound."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import components, cut, fresh

THRESHOLD = 0.98
LEADING = 4  # principal components by which the space is cut into cells
TILE_ROWS = 2048
PAIRS = 1 << 18  # whose products are continued at a time
SLACK = 1e-9  # for rounding in bounds; the decision itself is on the plain cosine


def usable(label: Column, vector: Column) -> Column:
    """Whether a vector can link: labelled, finite throughout and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _by_width(batch: pa.RecordBatch, at: int):
    """The batch by the width of its vectors: (width, rows, vectors)."""
    column = batch.column(at)
    widths = np.diff(column.offsets.to_numpy())
    for width in np.unique(widths):
        rows = pa.array(np.flatnonzero(widths == width))
        yield int(width), rows, _vectors(column.take(rows), int(width))


def _moments(batches: Iterator[pa.RecordBatch]):
    """Sums and products of unit vectors, by width; one table per task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for width, _, x in _by_width(batch, 0):
            x = np.concatenate([np.ones((len(x), 1)), _unit(x)], axis=1)
            total[width] = total.get(width, 0) + x.T @ x
    for width, t in total.items():
        flat = t.ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(flat), width, np.int32)),
                pa.array(np.arange(len(flat), dtype=np.int32)),
                pa.array(flat),
            ],
            ["width", "i", "value"],
        )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per width, the principal axes of the unit vectors, by falling variance.

    ``vectors`` has one array column. Moments are summed by Spark over all rows; the driver
    gets the square of the width.
    """
    sums = vectors.mapInArrow(_moments, "width int, i int, value double")
    by_width: dict[int, dict[int, float]] = {}
    for r in sums.groupBy("width", "i").agg(F.sum("value").alias("value")).toLocalIterator():
        by_width.setdefault(r["width"], {})[r["i"]] = r["value"]
    axes = {}
    for width, values in by_width.items():
        t = np.array([values[i] for i in range((width + 1) ** 2)]).reshape(width + 1, width + 1)
        mean = t[0, 1:] / t[0, 0]
        _, vectors_ = np.linalg.eigh(t[1:, 1:] / t[0, 0] - np.outer(mean, mean))
        axes[width] = vectors_[:, ::-1].copy()
    return axes


def _place(batches: Iterator[pa.RecordBatch], sent, reach: float):
    """Each vector into its cell, and as a guest into later cells that it can reach into.

    Cells are cubes of twice the reach on the leading axes. Vectors within the reach of
    each other are in one cell, or one is a guest in the other's.
    """
    side = 2 * reach
    for batch in batches:
        for width, rows, x in _by_width(batch, 2):
            y = _unit(x) @ sent.value[width][:, :LEADING]
            home = np.floor(y / side).astype(np.int64)
            part = batch.take(rows)
            within = y - home * side
            for step in product((-1, 0, 1), repeat=y.shape[1]):
                if step < (0,) * len(step):
                    continue
                step = np.array(step)
                gap = np.where(step < 0, within, np.where(step > 0, side - within, 0.0))
                near = np.flatnonzero(np.square(gap).sum(axis=1) <= reach * reach)
                if not len(near):
                    continue
                cells = home[near] + step
                names = [",".join(map(str, c)) for c in np.column_stack([np.full(len(near), width), cells]).tolist()]
                guest = pa.array(np.full(len(near), int(step.any()), np.int32))
                chosen = part.take(pa.array(near))
                yield pa.RecordBatch.from_arrays(
                    [*chosen.columns, pa.array(names, pa.string()), guest],
                    [*chosen.schema.names, "cell", "guest"],
                )


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two tiles of rotated unit vectors whose product may reach the threshold.

    Products are summed over the leading axes first. What the others can add is at most the
    product of the lengths of both rests; a pair is dropped where that doesn't suffice.
    """
    width = a.shape[1]
    stops = sorted({min(width, s) for s in (8, 16, 32, 64, 128, 256, 512)} | {width})
    rest = [
        [np.sqrt(np.square(x[:, s:]).sum(axis=1)) for s in stops] for x in (a, b)
    ]
    sums = a[:, : stops[0]] @ b[:, : stops[0]].T
    i, j = np.nonzero(sums + np.outer(rest[0][0], rest[1][0]) >= threshold - SLACK)
    sums = sums[i, j]
    out = []
    for at in range(0, len(i), PAIRS):
        p, q, s = i[at : at + PAIRS], j[at : at + PAIRS], sums[at : at + PAIRS]
        for k in range(1, len(stops)):
            if not len(p):
                break
            cols = slice(stops[k - 1], stops[k])
            s = s + np.einsum("ij,ij->i", a[p, cols], b[q, cols])
            keep = s + rest[0][k][p] * rest[1][k][q] >= threshold - SLACK
            p, q, s = p[keep], q[keep], s[keep]
        out.append((p, q))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in out]), np.concatenate([q for _, q in out])


class _Cell:
    """The home tile of a cell, and what its links come to."""

    def __init__(self, threshold: float, axes: dict[int, np.ndarray]):
        self.threshold, self.axes = threshold, axes
        self.homes: list[tuple] = []
        self.ready = None

    def _rotated(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.axes[x.shape[1]]

    def add(self, ids, sizes, x):
        self.homes.append((ids, sizes, x))

    def close(self):
        """Compare the home tile with itself."""
        ids, sizes, x = (np.concatenate(c) for c in zip(*self.homes, strict=True))
        self.ready = (ids, sizes, x, self._rotated(x))
        return self._links(*self.ready, *self.ready, same=True)

    def visit(self, ids, sizes, x):
        for at in range(0, len(ids), TILE_ROWS):
            part = slice(at, at + TILE_ROWS)
            y = self._rotated(x[part])
            yield self._links(*self.ready, ids[part], sizes[part], x[part], y, same=False)

    def _links(self, ids, sizes, x, y, ids2, sizes2, x2, y2, same: bool):
        i, j = close_pairs(y, y2, self.threshold)
        if same:
            i, j = i[i < j], j[i < j]
        keep = []
        for at in range(0, len(i), PAIRS):
            p, q = i[at : at + PAIRS], j[at : at + PAIRS]
            a, b = x[p], x2[q]
            dot = np.einsum("ij,ij->i", a, b)
            norms = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
            keep.append(dot / norms >= self.threshold)
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j = i[keep], j[keep]
        if not len(i):
            return None
        n = len(ids)
        nodes, weights = (ids, sizes) if same else (np.append(ids, ids2), np.append(sizes, sizes2))
        j = j if same else j + n
        links = np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
        root = _roots(i, j, len(nodes))
        got = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(nodes[got]),
                pa.array(nodes[root[got]]),
                pa.array(links[got].astype(np.int64)),
            ],
            ["node", "root", "links"],
        )


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """A common member for each set of linked numbers below ``n``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(batches: Iterator[pa.RecordBatch], sent, threshold: float):
    """Tiles come sorted by cell, homes before guests, and stand in memory one at a time."""
    now, cell = None, None
    for batch in batches:
        keys = batch.select(["cell", "label", "sub"]).to_pylist()
        guests = batch.column("guest").to_numpy()
        ids = batch.column("cid").to_numpy()
        sizes = batch.column("size").to_numpy()
        vectors = batch.column("vector")
        cuts = [
            k for k in range(1, len(keys)) if keys[k] != keys[k - 1] or guests[k] != guests[k - 1]
        ]
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if not a < b:
                continue
            if keys[a] != now:
                if cell and cell.homes and cell.ready is None and (out := cell.close()):
                    yield out
                now, cell = keys[a], _Cell(threshold, sent.value)
            part = vectors.slice(a, b - a)
            row = ids[a:b], sizes[a:b], _vectors(part, len(part[0]))
            if not guests[a]:
                cell.add(*row)
            elif cell.homes:
                if cell.ready is None and (out := cell.close()):
                    yield out
                yield from (out for out in cell.visit(*row) if out)
    if cell and cell.homes and cell.ready is None and (out := cell.close()):
        yield out


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``vectors`` plus ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label are linked where their cosine, in double precision, is at least
    ``threshold``. ``n_links`` counts the other vectors linked to one, ``component_id`` is
    the smallest id that links reach, ``kept`` whether that is the vector's own.

    Equal vectors are one member with a size, so a group of copies is never expanded. A
    cosine of at least t is a distance of at most sqrt(2 - 2t) between unit vectors, so
    only vectors near each other on the leading principal axes are brought together, in
    cells of the space. A cell of more than ``tile_rows`` is split into tiles by a hash,
    which meet pair by pair in tasks of their own. A task holds one tile and gives the sum
    of links per vector and a tree of each linked set, never the pairs.

    A vector links with nothing if it or its label is null, if it is zero, or if it holds a
    null or a number that isn't finite; neither do vectors of different lengths. A null id
    comes after all others; rows with one id stand for themselves. An empty table gives an
    empty table. Columns named like the results are replaced, all others are kept.
    """
    vectors = fresh(vectors, "n_links", "component_id", "kept")
    label, vector = F.col(label_col).cast("string"), F.col(vector_col).cast("array<double>")
    ok = usable(F.col(label_col), vector)
    keyed = vectors.withColumns(
        {
            "__k1": F.when(ok, F.xxhash64(label, F.lit(1), vector)),
            "__k2": F.when(ok, F.xxhash64(label, F.lit(2), vector)),
        }
    )
    members = cut(
        keyed.where("__k1 IS NOT NULL")
        .groupBy("__k1", "__k2")
        .agg(
            F.first(label).alias("label"),
            F.first(vector).alias("vector"),
            F.count(F.lit(1)).alias("size"),
            F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))).alias("first"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "members",
    )
    axes = members.sparkSession.sparkContext.broadcast(principal_axes(members.select("vector")))
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    placed = cut(
        members.select("cid", "size", "vector", "label").mapInArrow(
            partial(_place, sent=axes, reach=reach),
            "cid bigint, size bigint, vector array<double>, label string, cell string, guest int",
        ),
        "placed",
    )
    large = (
        placed.where("guest = 0")
        .groupBy("cell", "label")
        .count()
        .where(F.col("count") > tile_rows)
        .select("cell", "label", F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("cid"), tiles).cast("int")
    subs = F.when(
        F.col("guest") == 0, F.sequence(own, tiles - 1)
    ).otherwise(F.sequence(F.lit(0), tiles - 1))
    spread = (
        placed.join(cut(large, "large"), ["cell", "label"], "left")
        .withColumn("own", F.when(F.col("guest") == 0, own).otherwise(-1))
        .withColumn("sub", F.explode(subs))
        .withColumn("guest", (F.col("sub") != F.col("own")).cast("int"))
        .select("cell", "label", "sub", "guest", "cid", "size", "vector")
    )
    links = cut(
        spread.repartition("cell", "label", "sub")
        .sortWithinPartitions("cell", "label", "sub", "guest")
        .mapInArrow(
            partial(_compare, sent=axes, threshold=threshold),
            "node bigint, root bigint, links bigint",
        ),
        "links",
    )
    joined = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy(F.col("node").alias("cid")).agg(F.sum("links").alias("links"))
    grouped = (
        members.join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        .join(counted, "cid", "left")
        .select(
            "__k1", "__k2", "first",
            F.coalesce("component", "cid").alias("group"),
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("__links"),
        )
    )
    grouped = cut(grouped, "groups")
    firsts = grouped.groupBy("group").agg(F.min("first").alias("__of"))
    found = grouped.join(firsts, "group").select("__k1", "__k2", "__links", "__of")
    own_id = F.col(id_col)
    component = F.when(F.col("__of").isNull(), own_id).otherwise(F.col("__of.id"))
    return (
        keyed.join(found, ["__k1", "__k2"], "left")
        .withColumns(
            {
                "n_links": F.coalesce("__links", F.lit(0)).cast("long"),
                "component_id": component,
                "kept": own_id.eqNullSafe(component),
            }
        )
        .drop("__k1", "__k2", "__links", "__of")
    )


def op4_embedding_dedup(embeddings: DataFrame) -> DataFrame:
    """The contract's row per vector."""
    done = near_vectors(embeddings.select("vec_id", "embedding", "label"))
    return done.select("vec_id", "n_links", "component_id", "kept")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
ok AS (
  SELECT * FROM v WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM c
"""
