"""Centroid clustering in integers, with far centroids ruled out in rotated coordinates.

Vectors are whole numbers, and every distance and mean that decides anything is
computed in them. A rotation onto the principal axes only spares work: of each
vector the leading rotated coordinates and the length of the rest are stored.
For a centroid, the distance of the leading parts plus the squared difference of
the two lengths is never above the true distance, so a centroid whose bound
exceeds an exact distance already found needn't be looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from marketflow.llm.common import stored

#: Components up to this size give distances that fit a bigint.
LARGEST = 1 << 27
#: Rows multiplied at once.
BLOCK = 4096


def whole(df: DataFrame, vector: str, dimensions: int, scale: int, *keep: Column) -> DataFrame:
    """``keep`` and v: floor(scale * component), of rows with just ``dimensions`` components, none null or non-finite.

    A component beyond ``LARGEST`` stops the job, since its distances would not fit a bigint.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    kept = df.filter((F.size(x) == dimensions) & finite)
    small = lambda c: F.when(F.abs(c) <= LARGEST, F.floor(c).cast("int")).otherwise(F.raise_error("component too large for integer distances").cast("int"))
    return kept.select(*keep, F.transform(x, lambda c: small(c * scale)).alias("v"))


def seeds(vectors: DataFrame, k: int, id: str = "vec_id") -> np.ndarray:
    """The vectors of the ``k`` least SHA-256 of ``1:id``, ties by components; null ids come last."""
    name = F.sha2(F.concat(F.lit("1:"), F.col(id).cast("string")).cast("binary"), 256)
    rows = vectors.select(name.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), -1)


def _matrix(column: pa.Array, dimensions: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(kind)


def rotation(vectors: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of all vectors, and their principal axes as columns, leading ones first.

    Each task gives one row of sums per dimension; these are added up by
    dimension, so ``dimensions`` rows reach the driver whatever the input.
    """
    names = ["i", "n", "s", *(f"c{j}" for j in range(dimensions))]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, m = 0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
        for batch in batches:
            x = _matrix(batch.column(0), dimensions, np.float64)
            n, s, m = n + len(x), s + x.sum(0), m + x.T @ x
        if n:
            columns = [pa.array(range(dimensions), pa.int32()), pa.array([n] * dimensions, pa.int64()), pa.array(s), *(pa.array(m[:, j]) for j in range(dimensions))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "i int, n bigint, s double, " + ", ".join(f"c{j} double" for j in range(dimensions))
    rows = vectors.select("v").mapInArrow(moments, schema).groupBy("i").agg(*(F.sum(c).alias(c) for c in names[1:])).orderBy("i").collect()
    n = rows[0]["n"]
    mean = np.array([r["s"] for r in rows]) / n
    spread = np.array([r[3:] for r in rows]) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return mean, axes[:, ::-1]


class Rotated:
    """A rotation cut after ``leading`` coordinates."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, leading: int):
        self.mean, self.axes = mean, axes[:, :leading]

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the length of what they leave."""
        y = x - self.mean
        lead = y @ self.axes
        rest = y - lead @ self.axes.T
        return lead, np.sqrt(np.einsum("ij,ij->i", rest, rest))


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotated: Rotated) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller) and squared distance, both exact; and how many distances that took.

    The centroid of least bound is measured first. Whichever other bound, less a
    margin for rounding, isn't above that distance is measured too.
    """
    c_lead, c_rest = rotated.of(centroids.astype(np.float64))
    bound = ((lead[:, None, :] - c_lead[None]) ** 2).sum(2) + (rest[:, None] - c_rest[None]) ** 2
    square = lambda a, j: ((d := x[a] - centroids[j]) * d).sum(-1)
    rows = np.arange(len(x))
    best = bound.argmin(1)
    distance = square(rows, best)
    size = (lead**2).sum(1) + rest**2 + ((c_lead**2).sum(1) + c_rest**2).max() + (rotated.mean**2).sum()
    open_ = bound <= (distance + 1e-9 * size + 1e-3)[:, None]
    open_[rows, best] = False
    measured = len(x) + int(open_.sum())
    for j in range(len(centroids)):
        at = np.nonzero(open_[:, j])[0]
        d = square(at, j)
        closer = (d < distance[at]) | (d == distance[at]) & (j < best[at])
        best[at[closer]], distance[at[closer]] = j, d[closer]
    return best, distance, measured


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            column = dict(zip(part.schema.names, part.columns))
            lead = column["lead"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield part, _matrix(column["v"], dimensions), lead, column["rest"].to_numpy()


class Clustering:
    """Vectors stored with their rotated forms, and what is done to them in each round."""

    def __init__(self, vectors: DataFrame, dimensions: int, leading: int):
        """``vectors``: columns v and whatever identifies them."""
        self.dimensions = dimensions
        vectors = stored(vectors, "whole_vectors")
        self.empty = vectors.isEmpty()
        self.rotated = None if self.empty else Rotated(*rotation(vectors, dimensions), leading)
        self.vectors = vectors if self.empty else stored(self._rotate(vectors), "rotated_vectors")

    def _rotate(self, vectors: DataFrame) -> DataFrame:
        shared = vectors.sparkSession.sparkContext.broadcast(self.rotated)
        at, dimensions = vectors.columns.index("v"), self.dimensions
        schema = StructType([*vectors.schema.fields, StructField("lead", ArrayType(DoubleType())), StructField("rest", DoubleType())])

        def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lead, rest = shared.value.of(_matrix(batch.column(at), dimensions, np.float64))
                leads = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1) * lead.shape[1], pa.int32()), pa.array(lead.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, leads, pa.array(rest)], names=[*batch.schema.names, "lead", "rest"])

        return vectors.mapInArrow(rotate, schema)

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """Centroids after one round: floors of the means of what is nearest to each; an empty one stays.

        A task gives one row of sums per centroid, added up by centroid.
        """
        shared = self.vectors.sparkSession.sparkContext.broadcast((centroids, self.rotated))
        dimensions = self.dimensions
        names = ["cluster", "n", *(f"s{j}" for j in range(dimensions))]

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, rotated = shared.value
            n, s = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
            for _, x, lead, rest in _blocks(batches, dimensions):
                best = nearest(x, lead, rest, c, rotated)[0]
                n += np.bincount(best, minlength=len(c))
                np.add.at(s, best, x)
            own = np.nonzero(n)[0]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own]), *(pa.array(s[own, j]) for j in range(dimensions))], names=names)

        schema = "cluster int, n bigint, " + ", ".join(f"s{j} bigint" for j in range(dimensions))
        total = self.vectors.select("v", "lead", "rest").mapInArrow(sums, schema).groupBy("cluster").agg(*(F.sum(c).alias(c) for c in names[1:]))
        out = centroids.copy()
        for r in total.collect():  # one row per centroid
            out[r["cluster"]] = np.array([s // r["n"] for s in r[2:]], np.int64)
        return out

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """The identifying columns with cluster and distance."""
        shared = self.vectors.sparkSession.sparkContext.broadcast((centroids, self.rotated))
        keep = [c for c in self.vectors.columns if c not in ("v", "lead", "rest")]
        source = self.vectors.select(*keep, "v", "lead", "rest")
        schema = StructType([*source.select(*keep).schema.fields, StructField("cluster", IntegerType()), StructField("distance", LongType())])
        dimensions = self.dimensions

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, rotated = shared.value
            for part, x, lead, rest in _blocks(batches, dimensions):
                best, distance, _ = nearest(x, lead, rest, c, rotated)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(best.astype(np.int32)), pa.array(distance)], names=[*keep, "cluster", "distance"])

        return source.mapInArrow(assign, schema)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, leading: int = 16, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector kept: id, cluster, distance, cluster_inertia, inertia, centroid (array of bigint).

    Kept are vectors of ``dimensions`` components, none null or non-finite, as
    whole numbers floor(``scale`` * component). ``k`` of them begin as centroids
    (``seeds``; fewer if there are fewer), ``rounds`` times every vector goes to
    its nearest centroid and the centroids move to the floors of their means;
    then the vectors are assigned once more. Ties go to the smaller number, so of
    two equal centroids the second stays empty and where it was. Repeated rows and
    null ids count like any other; an empty table gives no rows; other columns are
    not read. A sum of distances beyond a bigint is null. What moves between tasks
    and to the driver are k rows of sums a task and round.
    """
    shape = f"`{id}` {df.schema[id].dataType.simpleString()}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    found = Clustering(whole(df, vector, dimensions, scale, F.col(id)), dimensions, min(leading, dimensions))
    if found.empty:
        return df.sparkSession.createDataFrame([], shape)
    centroids = seeds(found.vectors, k, id)
    for _ in range(rounds):
        centroids = found.moved(centroids)
    rows = stored(found.assigned(centroids), "assigned_vectors")
    own = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()  # k rows
    sums = {r["cluster"]: r["cluster_inertia"] for r in own}
    whole_sum = None if None in sums.values() or sum(sums.values()) >= 1 << 63 else sum(sums.values())
    told = [(j, sums[j], whole_sum, [int(x) for x in centroids[j]]) for j in sums]
    table = df.sparkSession.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return rows.join(F.broadcast(table), "cluster").select(id, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def sql(k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64) -> str:
    """The same over ``embeddings`` by plain distances, one step per round."""
    square = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = [
        f"kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v "
        f"FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS j, v AS c FROM kept WHERE vec_id IS NOT NULL QUALIFY j < {k})",
    ]
    for i in range(rounds + 1):
        out.append(f"d{i} AS (SELECT r, j, CAST({square} AS BIGINT) AS d FROM kept, c{i})")
        out.append(f"a{i} AS (SELECT r, arg_min(j, [d, j]) AS j, min(d) AS d FROM d{i} GROUP BY r)")
        if i < rounds:
            mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            sums = f"SELECT j, e, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, unnest(range({dimensions})) AS e FROM a{i} JOIN kept USING (r)) GROUP BY j, e"
            out.append(f"m{i} AS (SELECT j, list({mean} ORDER BY e) AS c FROM ({sums}) GROUP BY j)")
            out.append(f"c{i + 1} AS (SELECT j, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (j))")
    last = rounds
    return (
        "WITH " + ",\n".join(out) + f"\nSELECT vec_id, CAST(j AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{last} JOIN kept USING (r) JOIN c{last} USING (j)"
    )
