"""Centroid clustering of vectors in integer arithmetic, by an incremental distance matrix.

Method: the exact dot product of every vector with every centroid is kept beside the vector. When centroids
move, a vector's products change by the vector's components times the centroid's changes, so a round reads
only the components in which a centroid changed (``step``), adds them up, and takes the nearest centroid
again: distance = vector² - 2 * product + centroid². Nothing is rounded and the smaller number wins a tie,
so results don't depend on the order or the partitions of the rows.

Scale: a round is one map over the table that the round before wrote (integers: components, products), and
one sum per (cluster, component), added up within each task first; a cluster that holds most vectors is one
row per task. Centroids, their sums and their digests are clusters x components numbers: the only thing that
reaches the driver, whatever the input.

Edge cases: vectors that are null, of another length, or with a null, NaN or infinite component are left out;
rows that share an id are separate vectors, and a row without an id is drawn as a first centroid only after
all others; fewer vectors than clusters give as many clusters; an empty table gives an empty result; other
columns are not read. A component whose distances could pass 64 bits (beyond about two million at 64
components) is an error, not a wrong number.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm.storage import written
from boreal.llm.worker import claim


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the kept vectors as integers ``floor(scale * component)``."""
    limit = math.isqrt((1 << 63) // (4 * dims)) - 1
    x = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter((F.size(x) == dims) & F.coalesce(finite, F.lit(False)))
    whole = F.transform(x, lambda c: F.when(F.abs(scale * c) <= limit, F.floor(scale * c).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {limit} / {scale}: distances would pass 64 bits")).cast("int")))
    return kept.select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of the smallest sha256 of salt and id; equal ids by their components."""
    drawn = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(drawn.alias("drawn"), "v").orderBy(F.asc_nulls_last("drawn"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def step(vectors: DataFrame, centroids: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """Vectors with their products, nearest centroid and distance; ``before`` are the centroids whose products
    ``vectors`` holds, None if it holds none yet."""
    k, dims = centroids.shape
    change = centroids - (0 if before is None else before)
    squares = (centroids * centroids).sum(axis=1)
    fresh = before is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("centroids")
        for batch in batches:
            if not len(batch):
                continue
            v = _matrix(batch.column("v"), dims)
            products = np.zeros((len(v), k), np.int64) if fresh else _matrix(batch.column("products"), k)
            for j in range(k):
                moved = np.flatnonzero(change[j])
                if len(moved):
                    products[:, j] += v[:, moved] @ change[j, moved]
            distances = (v * v).sum(axis=1)[:, None] - 2 * products + squares
            cluster = distances.argmin(axis=1)  # the first of equals
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), _lists(products), pa.array(cluster.astype(np.int32)),
                 pa.array(distances[np.arange(len(v)), cluster])], ["vec_id", "v", "products", "cluster", "distance"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {id_type}, v array<int>, products array<long>, cluster int, distance long")


def moved_centroids(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as the exact floor of its vectors' mean; one without vectors stays."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("centroids")
        for batch in batches:  # one row per cluster of a batch, so sums stay far inside 64 bits
            v, cluster = _matrix(batch.column("v"), dims), batch.column("cluster").to_numpy()
            present = np.unique(cluster)
            if len(present):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(present), pa.array(np.bincount(cluster, minlength=k)[present]),
                     _lists(np.stack([v[cluster == j].sum(axis=0) for j in present]))], ["cluster", "members", "totals"])

    partial = assigned.select("v", "cluster").mapInArrow(run, "cluster int, members long, totals array<long>")
    exact = "decimal(38,0)"
    sums = (partial.select("cluster", "members", F.posexplode("totals").alias("at", "total"))
            .groupBy("cluster", "at").agg(F.sum(F.col("total").cast(exact)).alias("total"), F.sum("members").alias("members")))
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"], r["at"]] = int(r["total"]) // r["members"]
    return out


def clusters(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 16, dims: int = 64,
             scale: int = 64, rounds: int = 3, salt: str = "1:") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared, to its centroid), cluster_inertia and inertia
    (distances summed over its cluster and over all), centroid_sha256 (of its centroid's components)."""
    kept = integer_vectors(vectors, vec_id, embedding, dims, scale)
    centroids = first_centroids(kept, k, salt)
    if not len(centroids):
        return kept.select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid_sha256", "string"))))
    assigned = written(step(kept, centroids, None), "vectors")
    for _ in range(rounds):
        moved = moved_centroids(assigned, centroids)
        if (moved == centroids).all():
            break  # nothing moves any more
        assigned, centroids = written(step(assigned, moved, centroids), "vectors"), moved
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of_cluster(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    return assigned.select(
        "vec_id", "cluster", "distance", of_cluster([sums.get(j, 0) for j in range(len(centroids))]).cast("long").alias(
            "cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"))
