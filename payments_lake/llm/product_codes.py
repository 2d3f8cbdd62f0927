"""Product codes of vectors: exact codebook training with norm-of-sum bounds on entry groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import written
from payments_lake.llm.vectors import as_array, finite, floor_means, group_sums, integers, long_array, matrix, squared

PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Entries of a codebook that share a bound.
GROUP = 32
# Rounding of roots, relative to them; doubles lose far less.
SLACK = 2.0**-40
SALTS = 16
# A stored bound of an entry group that has no entry but the assigned one.
NEVER = 1 << 62


class Codebooks:
    """The entries of one part in every round so far: ``now`` is the last round's, and
    ``moved(stamp)`` how far the entries of each group lie from where they were in an earlier one.

    That is the norm of the sum of an entry's steps, which is at most the sum of their norms: an
    entry that wanders back and forth loosens no bound for good.
    """

    def __init__(self, history: list[np.ndarray]) -> None:
        self.history, self.now, self.round = history, history[-1], len(history) - 1
        self.groups = [slice(at, min(at + GROUP, len(self.now))) for at in range(0, len(self.now), GROUP)]
        steps = [np.sqrt(squared(self.now, old).astype(float)) * (1 + SLACK) for old in history]
        # drift[stamp, group]
        self.drift = np.array([[step[g].max() for g in self.groups] for step in steps])


def below_root(values: np.ndarray) -> np.ndarray:
    """Whole numbers that are at most the roots of the integers."""
    return np.floor(np.sqrt(values.astype(float)) * (1 - SLACK)).astype(np.int64)


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows and entries."""
    if rows.dtype == object or entries.dtype == object:
        rows, entries = rows.astype(object), entries.astype(object)
        return np.array([[int(((r - e) ** 2).sum()) for e in entries] for r in rows], object).reshape(len(rows), len(entries))
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    if 4 * largest * largest * rows.shape[1] < 1 << 53:
        # All sums are whole numbers that a double holds exactly.
        x, c = rows.astype(float), entries.astype(float)
        found = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)
        return found.astype(np.int64)
    return (rows * rows).sum(axis=1)[:, None] - 2 * (rows @ entries.T) + (entries * entries).sum(axis=1)


def reassigned(
    rows: np.ndarray, books: Codebooks, code: np.ndarray | None, bounds: np.ndarray, stamps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entries, exact squared distances, distances computed); updates bounds and stamps.

    ``bounds[:, g]`` is below the distance of a row to every entry of group g, its own entry apart,
    as the entries were in round ``stamps[:, g]``. By the triangle inequality the bound less the
    group's net displacement since then holds now. Only groups where that isn't above the distance
    to the row's own entry are scanned again, in integers; ties go to the lower entry.
    """
    n = len(rows)
    scan_all = code is None
    code = np.zeros(n, np.int64) if scan_all else code.astype(np.int64)
    own = squared(rows, books.now[code])
    best, distance, measured = code.copy(), own.copy(), n
    radius = np.sqrt(own.astype(float)) * (1 + SLACK)
    for g, span in enumerate(books.groups):
        held = bounds[:, g] - books.drift[stamps[:, g], g]
        at = np.arange(n) if scan_all else np.flatnonzero(held * (1 - SLACK) <= radius)
        if not len(at):
            continue
        found = distances(rows[at], books.now[span])
        measured += found.size
        # The own entry has no part in its group's bound while it stays the nearest.
        inside = (code[at] >= span.start) & (code[at] < span.stop)
        least_at = found.argmin(axis=1)
        least = found[np.arange(len(at)), least_at]
        entry = least_at + span.start
        others = found.astype(object if found.dtype == object else np.int64)
        others[np.flatnonzero(inside), code[at[inside]] - span.start] = NEVER
        bounds[at, g] = np.where(others.min(axis=1) >= NEVER, NEVER, below_root(others.min(axis=1)))
        stamps[at, g] = books.round
        closer = (least < distance[at]) | ((least == distance[at]) & (entry < best[at]))
        best[at[closer]], distance[at[closer]] = entry[closer], least[closer]
    moved = np.flatnonzero(best != code)
    if len(moved):
        _release(moved, code, own, books, bounds, stamps)
        _exclude(moved, best, rows, books, bounds, stamps)
    return best, distance, measured


def _release(moved, code, own, books: Codebooks, bounds, stamps) -> None:
    """The entry that a row leaves counts in its group's bound from now on."""
    g = code[moved] // GROUP
    now = np.floor(bounds[moved, g] - books.drift[stamps[moved, g], g] - 1).astype(np.int64)
    bounds[moved, g] = np.minimum(now, below_root(own[moved]))
    stamps[moved, g] = books.round


def _exclude(moved, best, rows, books: Codebooks, bounds, stamps) -> None:
    """The bound of the new entry's group, without that entry. Its group was scanned this round."""
    for g, span in enumerate(books.groups):
        at = moved[best[moved] // GROUP == g]
        if len(at):
            found = distances(rows[at], books.now[span])
            found[np.arange(len(at)), best[at] - span.start] = NEVER
            least = found.min(axis=1)
            bounds[at, g] = np.where(least >= NEVER, NEVER, below_root(least))
            stamps[at, g] = books.round


def listed(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel(), kind)
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(kind))


def parts_of(batch: pa.RecordBatch, parts: int) -> list[np.ndarray]:
    return np.split(matrix(batch.column("q")), parts, axis=1)


def codes_of(batch: pa.RecordBatch, column: str = "code") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def reassign(state: DataFrame, history: list[list[list[list[int]]]], name: str, keep: bool = True) -> DataFrame:
    """The state after one more assignment, written: (vec_id, label, q, code, bounds, stamps, error).

    ``history`` has the codebooks of each round. Bounds and stamps are those of all parts' groups
    in a row; without ``keep`` they and q are left out, as after the last round nobody reads them.
    """
    parts = len(history[0])
    books = [Codebooks([as_array(codebooks[p]) for codebooks in history]) for p in range(parts)]
    started = "code" in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, wide = batch.num_rows, len(books[0].groups)
            codes, errors = np.zeros((n, parts), np.int64), 0
            if started:
                bounds, stamps, old = (codes_of(batch, c).astype(np.int64) for c in ("bounds", "stamps", "code"))
            else:
                bounds, stamps, old = np.zeros((n, parts * wide), np.int64), np.zeros((n, parts * wide), np.int64), None
            for p, rows in enumerate(parts_of(batch, parts)):
                span = slice(p * wide, (p + 1) * wide)
                if rows.dtype != books[p].now.dtype:
                    rows = rows.astype(object)
                codes[:, p], error, _ = reassigned(
                    rows, books[p], None if old is None else old[:, p], bounds[:, span], stamps[:, span]
                )
                errors = errors + error
            columns = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": listed(codes, pa.int16())}
            if keep:
                columns |= {
                    "q": batch.column("q"), "bounds": listed(bounds, pa.int64()), "stamps": listed(stamps, pa.int16()),
                }
            else:
                columns["error"] = long_array(errors)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = dict(state.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<smallint>, " + (
        "q array<bigint>, bounds array<bigint>, stamps array<smallint>" if keep else "error bigint"
    )
    return written(state.mapInArrow(run, schema), name)


def trained_codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame | None, list]:
    """(vec_id, label, code, error) of the kept vectors, and the final codebooks."""
    kept = embeddings.filter((F.size("embedding") > 0) & finite(F.col("embedding"))).select(
        "vec_id", "label", integers(F.col("embedding")).alias("q")
    )
    sizes = kept.groupBy(F.size("q").alias("size")).count().filter(F.col("size") % parts == 0)
    usual = sizes.orderBy(F.desc("count"), "size").first()
    if usual is None:
        return None, []
    dimensions = usual["size"]
    vectors = written(kept.filter(F.size("q") == dimensions), "vectors")
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    width = dimensions // parts
    codebooks = [[list(row["q"][p * width : (p + 1) * width]) for row in first] for p in range(parts)]
    history, state = [codebooks], vectors

    def groups_of(batch: pa.RecordBatch):
        if batch.num_rows:
            codes = codes_of(batch)
            for p, rows in enumerate(parts_of(batch, parts)):
                yield p * entries + codes[:, p].astype(np.int64), rows

    for number in range(rounds):
        state = reassign(state, history, f"round{number}")
        sums = group_sums(state.select("q", "code"), groups_of)
        codebooks = [
            floor_means(book, {g - p * entries: s for g, s in sums.items() if g // entries == p})
            for p, book in enumerate(codebooks)
        ]
        history = [*history, codebooks]
    return reassign(state, history, "codes", keep=False), codebooks


def product_codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Null vectors and those with null or non-finite components give no row. Vectors are compared
    within one length: that of most kept vectors which ``parts`` divides (the smaller of equally
    frequent ones); others, empty ones among them, give no row. Of rows that repeat a vec_id, that
    with the smaller vector comes first, and rows without a vec_id come last; with fewer vectors
    than ``entries`` there are as many entries as vectors. Repeated rows count as often as they
    occur; null labels are one label; no vectors give no rows; other columns are ignored. A
    component of 2**53 or more in integers, or an error beyond a long, raises an overflow. To the
    driver come the codebooks and their sums, never vectors.
    """
    coded, codebooks = trained_codes(embeddings, parts, entries, rounds)
    if coded is None:
        kind = dict(embeddings.dtypes)["vec_id"]
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        )
    text = ",".join(str(v) for book in codebooks for entry in book for v in entry)
    # A label may hold a third of the rows: both sides are salted.
    totals = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "error"), F.lit(SALTS)).cast("int"))
    same = (rows["salt"] == salted["salt"]) & rows["label"].eqNullSafe(salted["label"])
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("bigint")), 2, "0")))
    return rows.join(salted, same).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )
