"""Embeddings as integer vectors, and exact sums of them over groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
# Squared distances of components below this stay within 64 bits for up to 64 components.
FAST = 1 << 27
# Components from here on aren't told apart by a double's whole numbers.
MOST = 1 << 53


def finite(vector: Column) -> Column:
    """True where no component is null, NaN or infinite; null for a null vector."""
    return F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )


def integers(vector: Column) -> Column:
    """floor(1024 * x) of each component, x as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow column as rows. Their type is int64 where squares fit, else Python's
    integers, so that no distance is ever rounded."""
    if not len(column):
        return np.empty((0, 0), np.int64)
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    far = int(np.abs(rows.astype(float)).max()) if rows.size else 0
    if far >= MOST:
        raise OverflowError(f"a component of {far} has no exact squared distance")
    return rows.astype(np.int64) if far < FAST else rows.astype(object)


def squared(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one or to row-wise centres."""
    gap = rows - centre
    return (gap * gap).sum(axis=1)


def long_array(values) -> pa.Array:
    return pa.array([int(v) for v in values] if getattr(values, "dtype", None) == object else values, pa.int64())


def group_sums(frame: DataFrame, groups_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]) -> dict:
    """{group: (rows, exact sum vector)} over all rows of the frame.

    ``groups_of`` gives (group numbers, integer rows) of a batch. Each task adds its rows up and
    sends one line per group and component, Spark adds the lines up; what reaches the driver is as
    large as the groups' sums, whatever the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for groups, rows in groups_of(batch):
                order = np.argsort(groups, kind="stable")
                groups, rows = groups[order], rows[order]
                starts = np.flatnonzero(np.diff(groups, prepend=-1))
                if not len(starts):
                    continue
                sums = np.add.reduceat(rows, starts, axis=0)
                counts = np.diff(starts, append=len(groups))
                for group, total, n in zip(groups[starts].tolist(), sums, counts.tolist(), strict=True):
                    one = held.setdefault(group, [0, 0])
                    one[0] += n
                    one[1] = one[1] + total.astype(object)
        lines = [
            (group, place, n if not place else 0, Decimal(int(value)))
            for group, (n, total) in held.items()
            for place, value in enumerate(total)
        ]
        if lines:
            groups, places, counts, totals = zip(*lines, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.int32()), pa.array(places, pa.int32()), pa.array(counts, pa.int64()),
                 pa.array(totals, pa.decimal128(38, 0))],
                ["group", "place", "n", "total"],
            )

    lines = frame.mapInArrow(run, "group int, place int, n bigint, total decimal(38,0)")
    sums: dict[int, list] = {}
    for row in lines.groupBy("group", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        one = sums.setdefault(row["group"], [0, {}])
        one[0] += row["n"]
        one[1][row["place"]] = int(row["total"])
    return {group: (n, [parts[i] for i in range(len(parts))]) for group, (n, parts) in sums.items()}


def floor_means(centres: list[list[int]], sums: dict) -> list[list[int]]:
    """floor(sum / count) of each component; a centre without rows stays."""
    return [
        [total // sums[i][0] for total in sums[i][1]] if i in sums else list(centre)
        for i, centre in enumerate(centres)
    ]


def as_array(centres: list[list[int]]) -> np.ndarray:
    far = max((abs(v) for c in centres for v in c), default=0)
    return np.array(centres, np.int64 if far < FAST else object)
