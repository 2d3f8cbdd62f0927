"""Exact k-means on integer vectors, filtered by PCA-rotated coordinates and residual norms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import written
from payments_lake.llm.vectors import (
    as_array, finite, floor_means, group_sums, integers, long_array, matrix, squared,
)

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
# Rotated coordinates that are stored; what they leave over is one residual norm.
LEADING = 16
# Rounding of stored coordinates and norms, as a part of the vectors' norms: they are doubles, and
# 64 products lose far less than this.
SLACK = 2.0**-40


def rotation(vectors: DataFrame, dimensions: int, leading: int = LEADING) -> np.ndarray:
    """The leading principal directions of all vectors, as columns.

    Tasks add up products; Spark adds up one line per matrix cell. Any orthonormal columns give
    the same clusters, these close the filter best.
    """
    cells = np.triu_indices(dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total, n = np.zeros((dimensions, dimensions)), np.zeros(dimensions), 0
        for batch in batches:
            rows = matrix(batch.column("q")).astype(float).reshape(-1, dimensions)
            products += rows.T @ rows
            total += rows.sum(axis=0)
            n += len(rows)
        if n:
            values = np.concatenate([products[cells], total, [n]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["cell", "value"]
            )

    found = vectors.select("q").mapInArrow(run, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")
    ).collect()
    values = np.zeros(len(cells[0]) + dimensions + 1)
    for row in found:
        values[row["cell"]] = row["value"]
    spread = np.zeros((dimensions, dimensions))
    spread[cells] = values[: len(cells[0])]
    spread = spread + np.triu(spread, 1).T
    mean = values[len(cells[0]) : -1] / max(values[-1], 1)
    spread = spread / max(values[-1], 1) - np.outer(mean, mean)
    return np.ascontiguousarray(np.linalg.eigh(spread)[1][:, ::-1][:, : min(leading, dimensions)])


def projected(rows: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates of the rows, and the norms of what these leave over."""
    values = rows.astype(float)
    lead = values @ axes
    return lead, np.sqrt(((values - lead @ axes.T) ** 2).sum(axis=1))


def rotated(vectors: DataFrame, axes: np.ndarray) -> DataFrame:
    """The vectors with their leading coordinates and residual norm, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lead, rest = projected(matrix(batch.column("q")), axes)
            lead = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), lead, pa.array(rest)],
                ["vec_id", "q", "lead", "rest"],
            )

    kind = dict(vectors.dtypes)["vec_id"]
    return written(
        vectors.mapInArrow(run, f"vec_id {kind}, q array<bigint>, lead array<double>, rest double"), "rotated"
    )


def nearest(
    rows: np.ndarray, lead: np.ndarray, rest: np.ndarray, centres: np.ndarray, axes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centre, exact squared distance, exact distances computed) of the rows.

    With orthonormal axes, the squared distance of two vectors is that of their coordinates plus
    that of their residual vectors, and the latter is at least the squared difference of the
    residual norms. The centre with the least bound is measured first; every other one whose bound
    isn't above the distance so far is verified in integers. Ties go to the smaller number.
    """
    c_lead, c_rest = projected(centres, axes)
    bounds = np.sqrt(((lead[:, None, :] - c_lead[None]) ** 2).sum(axis=2) + (rest[:, None] - c_rest) ** 2)
    norms = np.sqrt((lead**2).sum(axis=1) + rest**2)
    bounds -= SLACK * (norms[:, None] + np.sqrt((c_lead**2).sum(axis=1) + c_rest**2))
    best = bounds.argmin(axis=1)
    distance = squared(rows, centres[best])
    measured = len(rows)
    first = best.copy()
    for number in range(len(centres)):
        # The root of an integer is rounded by less than the slack; equal ones are verified too.
        near = np.sqrt(distance.astype(float)) * (1 + SLACK) >= bounds[:, number]
        at = np.flatnonzero(near & (first != number))
        if not len(at):
            continue
        new = squared(rows[at], centres[number])
        measured += len(at)
        closer = (new < distance[at]) | ((new == distance[at]) & (number < best[at]))
        best[at[closer]] = number
        distance[at[closer]] = new[closer]
    return best, distance, measured


def clustered(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, seed: str = SEED, leading: int = LEADING,
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with exactly ``dimensions`` components, none null or non-finite, are kept; others give
    no row. First centroids are the vectors with the smallest SHA-256 of ``seed:vec_id``; of rows
    that repeat a vec_id, that with the smaller vector comes first, and a row without a vec_id
    comes after all others. With fewer vectors than clusters there are as many clusters as vectors.
    Repeated rows count and come back as often as they occur; no vectors give no rows; other
    columns are ignored. A component of 2**53 or more in integers, or a distance beyond a long,
    raises an overflow. To the driver come sums per cluster and component, never vectors.
    """
    q = integers(F.col("embedding"))
    vectors = embeddings.filter((F.size("embedding") == dimensions) & finite(F.col("embedding"))).select("vec_id", q.alias("q"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), "q").limit(clusters).collect()
    names = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256".split(", ")
    kinds = f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return embeddings.sparkSession.createDataFrame([], kinds)
    axes = rotation(vectors, dimensions, leading)
    table = rotated(vectors, axes)
    centres = [list(row["q"]) for row in first]

    def nearest_of(batch: pa.RecordBatch, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = matrix(batch.column("q"))
        if now.dtype != rows.dtype:
            rows, now = rows.astype(object), now.astype(object)
        lead = batch.column("lead").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        best, distance, _ = nearest(rows, lead, batch.column("rest").to_numpy(zero_copy_only=False), now, axes)
        return rows, best, distance

    for _ in range(rounds):

        def groups_of(batch: pa.RecordBatch, now: np.ndarray = as_array(centres)):
            if batch.num_rows:
                rows, best, _ = nearest_of(batch, now)
                yield best, rows

        centres = floor_means(centres, group_sums(table.select("q", "lead", "rest"), groups_of))
    now = as_array(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, best, distance = nearest_of(batch, now)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(best, pa.int32()), long_array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    assigned = written(table.mapInArrow(assign, ", ".join(kinds.split(", ")[:3])), "assigned")
    inertia = {
        row["cluster"]: int(row["total"])
        for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    cluster = F.col("cluster")
    of_cluster = F.array(*[F.lit(inertia.get(i, 0)).cast("bigint") for i in range(len(centres))])
    return assigned.select(
        "vec_id", "cluster", "distance",
        of_cluster[cluster].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.array(*map(F.lit, digests))[cluster].alias("centroid_sha256"),
    ).select(*names)
