"""Benchmark decontamination: containment search by size-partitioned MinHash, verified exactly."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from payments_lake.llm.common import text_or_empty
from payments_lake.llm.shingles import mixed, shingle_set, shingles

HASHES = 64
MIN_PERCENT = 75
# Benchmark text that is sent with the tasks at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 32 << 20
STRETCH = 8192  # shingles of a text that are hashed at once
SEEDS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]
FACTOR = np.uint64(0x9FB21C651E98DF25)
LOW = np.uint64(0xFFFF)
# Texts are looked at in segments of three units of this power; memory doesn't grow with the text.
SEGMENT = 16


def permuted(values: np.ndarray) -> np.ndarray:
    """One row of hash values per hash function."""
    return (values[None, :] ^ SEEDS) * FACTOR


class ItemIndex:
    """The test items of a block, partitioned by size.

    A partition holds the items of up to ``unit`` = 2, 4, 8, .. shingles. Documents are laid out in
    windows of two units, a unit apart, so that every place where such an item may stand lies in
    one window of comparable size. In the window the item keeps a Jaccard similarity of at least
    0.17 when three quarters of it are there; that all 64 minima differ has a chance of 4 in a
    million then, and none for an item that fills its window.
    """

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.ids, self.sets = [], []
        self.minima: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        self.maybe: dict[int, np.ndarray] = {}
        self.of_single: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            own = shingle_set(text)
            if not len(own):
                continue
            if len(own) == 1:
                # Looked up as it is: a window of one shingle would hold 64 minima for each word.
                self.of_single[int(own[0])].append(len(self.ids))
                self.ids.append(item_id)
                self.sets.append(own)
                continue
            power = math.ceil(math.log2(len(own)))
            for f, value in enumerate(permuted(own).min(axis=1)):
                self.minima[power][f, int(value)].append(len(self.ids))
                self.maybe.setdefault(power, np.zeros(1 << 16, bool))[int(value & LOW)] = True
            self.ids.append(item_id)
            self.sets.append(own)
        self.single = np.array(sorted(self.of_single), np.uint64)

    def candidates(self, places: np.ndarray) -> set[int]:
        """Items that share a minimum with a window of the text."""
        found: set[int] = set()
        if len(self.single):
            for i in np.flatnonzero(np.isin(self.single, places)):
                found.update(self.of_single[int(self.single[i])])
        if not self.maybe or not len(places):
            return found
        powers = sorted(self.maybe)
        near, far = [p for p in powers if p <= SEGMENT], [p for p in powers if p > SEGMENT]
        unit, whole = 1 << (near[0] if near else SEGMENT), 1 << SEGMENT
        # Segments overlap by the largest unit that they look at, so each window lies in one whole.
        length, tops = 2 * whole, []
        for at in range(0, len(places), length):
            units = self._units(places[at : at + length + whole], unit)
            self._look(units, unit, near, found)
            if far:
                tops.append(np.minimum.reduceat(units, np.arange(0, units.shape[1], whole // unit), axis=1)[:, :2])
        if far:
            self._look(np.concatenate(tops, axis=1), whole, far, found)
        return found

    @staticmethod
    def _units(places: np.ndarray, unit: int) -> np.ndarray:
        """The minima of each unit of a segment, a stretch at a time."""
        step = max(STRETCH // unit, 1) * unit
        stretches = [
            np.minimum.reduceat(permuted(part), np.arange(0, len(part), unit), axis=1)
            for part in (places[at : at + step] for at in range(0, len(places), step))
        ]
        return np.concatenate(stretches, axis=1)

    def _look(self, units: np.ndarray, unit: int, powers: list[int], found: set[int]) -> None:
        """Adds the items of these powers that share a minimum with a window of two units."""
        for power in powers:
            wider = (1 << power) // unit
            if wider > 1:
                units = np.minimum.reduceat(units, np.arange(0, units.shape[1], wider), axis=1)
                unit = 1 << power
            windows = np.minimum(units[:, :-1], units[:, 1:]) if units.shape[1] > 1 else units
            for f, w in zip(*np.nonzero(self.maybe[power][windows & LOW]), strict=True):
                found.update(self.minima[power].get((int(f), int(windows[f, w])), ()))

    def matches(self, text: bytes, min_percent: int) -> list[tuple[int, int, int]]:
        """(item id, its shingles, how many of them the text has) of each item contained."""
        places = shingles(text)
        out = []
        for i in sorted(self.candidates(places)):
            shared = int(np.isin(self.sets[i], places).sum())
            if 100 * shared >= min_percent * len(self.sets[i]):
                out.append((self.ids[i], len(self.sets[i]), shared))
        return out


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[ItemIndex]:
    """Indexes of the benchmark, a block of about ``block_bytes`` of text at a time."""
    items = benchmark.select("item_id", text_or_empty("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield ItemIndex([(r.item_id, bytes(r.text)) for r in own.collect()])


def contained_items(
    documents: DataFrame, benchmark: DataFrame, min_percent: int = MIN_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs doc_id, item_id with n_item_shingles, n_shared and containment.

    A pair is returned when the whole text has at least ``min_percent`` of the item's distinct
    5-word shingles. Documents are scanned where they lie, without a shuffle; the benchmark is the
    query set and goes to the tasks in blocks of bounded size, one scan for each block. Null and
    empty texts and items match nothing, an item of fewer than five words only a text that consists
    of these words; repeated rows give repeated pairs; other columns are ignored.
    """
    kinds = dict(documents.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = (
        f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item_shingles bigint, n_shared bigint,"
        " containment double"
    )
    rows = documents.select("doc_id", text_or_empty("text").cast("binary").alias("text"))

    def searched(index: ItemIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [
                    (doc, item, size, shared, shared / size)
                    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                    for item, size, shared in index.matches(text.as_py(), min_percent)
                ]
                if found:
                    types = [batch.schema.field("doc_id").type, item_type, pa.int64(), pa.int64(), pa.float64()]
                    columns = zip(zip(*found, strict=True), types, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in columns],
                        ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"],
                    )

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, map(searched, item_blocks(benchmark, block_bytes)))


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, min_percent: int = MIN_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents, with all their columns, in which no item is contained."""
    out = documents
    for index in item_blocks(benchmark, block_bytes):
        out = out.filter(~_leaks(index, min_percent)(text_or_empty("text").cast("binary")))
    return out


def _leaks(index: ItemIndex, min_percent: int):
    @F.pandas_udf("boolean")
    def leaks(texts):
        return texts.map(lambda text: bool(index.matches(bytes(text), min_percent))).astype(bool)

    return leaks
