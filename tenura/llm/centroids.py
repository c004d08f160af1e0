"""Centroid clustering in integers, each vector placed by a tournament of bisectors.

Vectors become integers. The plane half way between centroids a < b has the integer normal 2 (b - a) and the threshold
|b|^2 - |a|^2; a vector is nearer b if its product with the normal is above the threshold, else it belongs to a (a tie
is the smaller number's). All normals and thresholds are made once for a task. A vector meets the centroids in
ascending order and keeps the winner, which takes k - 1 sign tests; only the last winner's distance is computed. A
round is one pass that returns a partial sum for each centroid and partition; the driver holds k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.storage import stored

LONG = (1 << 63) - 1
#: With components up to this size and up to 64 of them every product and sum below fits a 64-bit integer.
SMALL, SMALL_DIMS = 1 << 27, 64
#: The most bytes of normals that a task may hold.
MOST_TABLE = 256 << 20


def usable(embedding: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null, NaN or infinite; false for a null vector."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(embedding) == dims) & finite, F.lit(False))


def to_integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of a table of numbers; beyond 64 bits the largest or smallest long."""
    scaled = np.floor(np.float64(scale) * values.astype(np.float64))
    inside = np.abs(scaled) < 2.0**63
    out = np.where(inside, scaled, 0).astype(np.int64)
    out[~inside] = np.where(scaled[~inside] > 0, LONG, -LONG)
    return out


class Bisectors:
    """The normals and thresholds between all pairs of centroids."""

    def __init__(self, centroids: Sequence[Sequence[int]]):
        exact = np.array([list(c) for c in centroids], object)
        self.small = exact.shape[1] <= SMALL_DIMS and max(abs(x) for row in centroids for x in row) <= SMALL
        self.tables = {object: self._tables(exact)}
        if self.small:
            self.tables[np.int64] = tuple(t.astype(np.int64) for t in self.tables[object])

    @staticmethod
    def _tables(c):
        squares = (c * c).sum(1)
        return c, 2 * (c[None, :, :] - c[:, None, :]), squares[None, :] - squares[:, None]

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row and the squared distance to it."""
        kind = np.int64 if self.small and (not vectors.size or np.abs(vectors).max() <= SMALL) else object
        centroids, normals, thresholds = self.tables[kind]
        vectors = vectors.astype(kind)
        best = np.zeros(len(vectors), np.int64)
        for j in range(1, len(centroids)):
            side = (vectors * normals[best, j]).sum(1) - thresholds[best, j]
            best[side > 0] = j
        gap = vectors - centroids[best]
        return best, (gap * gap).sum(1)


def _rows(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return to_integers(flat.reshape(len(column), dims), scale)


def _batches(rows: np.ndarray, at_once: int = 4096) -> Iterator[np.ndarray]:
    for i in range(0, len(rows), at_once):
        yield rows[i:i + at_once]


def partial_sums(kept: DataFrame, centroids: Sequence[Sequence[int]], dims: int, scale: float) -> DataFrame:
    """``cluster``, ``n`` and ``total`` (componentwise) of the vectors of each partition."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for batch in batches:
            for rows in _batches(_rows(batch.column("v"), dims, scale)):
                best, _ = planes.place(rows)
                order = np.argsort(best, kind="stable")
                found, first = np.unique(best[order], return_index=True)
                part = rows if planes.small and np.abs(rows).max() <= SMALL else rows.astype(object)
                total[found] += np.add.reduceat(part[order], first, axis=0).astype(object)
                count += np.bincount(best, minlength=k)
        some = np.flatnonzero(count)
        sums = [[Decimal(int(x)) for x in total[i]] for i in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(sums, pa.list_(pa.decimal128(38, 0)))],
            ["cluster", "n", "total"])

    return kept.select("v").mapInArrow(add, "cluster int, n bigint, total array<decimal(38,0)>")


def next_centroids(kept: DataFrame, centroids: list[tuple[int, ...]], dims: int, scale: float) -> list[tuple[int, ...]]:
    """Each centroid replaced by floor(sum / count) of its vectors; one without vectors stays.

    The driver receives ``dims`` numbers for each of the k centroids.
    """
    parts = partial_sums(kept, centroids, dims, scale).select("cluster", "n", F.posexplode("total").alias("place", "x"))
    sums = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    made = [list(c) for c in centroids]
    for r in sums:
        made[r["cluster"]][r["place"]] = int(r["x"]) // r["n"]
    return [tuple(c) for c in made]


def first_centroids(kept: DataFrame, k: int, dims: int, scale: float, seed: str) -> list[tuple[int, ...]]:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<id>``, in that order; ids that are null come last."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(rank.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [tuple(int(x) for x in to_integers(np.array([r["v"]], np.float64), scale)[0]) for r in first]


def digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, seed: str = "2",
            vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) and the centroids.

    Vectors without exactly ``dims`` components or with a null or non-finite one are left out; the others become
    floor(``scale`` * x), a number beyond 64 bits the largest or smallest long. The centroids begin as the ``k``
    vectors of smallest hash (fewer, if there are fewer). Each round assigns all vectors to the nearest centroid (of
    equally near ones the smaller number) and moves each to floor(sum / count); rounds that would change nothing are
    left out. Distances and sums are exact; one that does not fit a long is given as the largest long.

    Rows with an equal or null id are vectors of their own; null ids are the last to begin as centroids, equal ones in the
    order of their components. Other columns are not looked at. An empty table has an empty result. The normals of all
    pairs must fit ``MOST_TABLE``: k * k * dims * 8 bytes, else an error.
    """
    if k < 1 or k * k * dims * 8 > MOST_TABLE:
        raise ValueError(f"k must be at least 1 and k * k * dims * 8 at most {MOST_TABLE}")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").alias("v"))
    kept = rows.where(usable(F.col("v"), dims))
    id_type = rows.schema["id"].dataType
    centroids = first_centroids(kept, k, dims, scale, seed)
    if not centroids:
        schema = T.StructType([T.StructField("vec_id", id_type)] + T._parse_datatype_string(
            "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").fields)
        return kept.sparkSession.createDataFrame([], schema), []
    for _ in range(rounds):
        moved = next_centroids(kept, centroids, dims, scale)
        if moved == centroids:
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for batch in batches:
            best, far = [], []
            for part in _batches(_rows(batch.column("v"), dims, scale)):
                b, d = planes.place(part)
                best.append(b)
                far += [min(int(x), LONG) for x in d]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.concatenate(best) if best else [], pa.int32()), pa.array(far, pa.int64())],
                ["vec_id", "cluster", "distance"])

    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    assigned = stored(kept.mapInArrow(assign, schema))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("far")).collect()
    inertia = {r["cluster"]: int(r["far"]) for r in sums}

    def of_cluster(values) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1)

    found = assigned.select(
        "*", of_cluster(min(inertia.get(i, 0), LONG) for i in range(len(centroids))).cast("bigint").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), LONG)).cast("bigint").alias("inertia"),
        of_cluster(digest(c) for c in centroids).alias("centroid_sha256"))
    return found, centroids
