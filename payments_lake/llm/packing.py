"""Packing documents into token sequences: sum-of-squares placing by fill level."""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from payments_lake.llm.common import text_or_empty
from payments_lake.llm.pieces import PieceCache, is_word
from payments_lake.llm.token_counts import byte_letters

SEQUENCE = 1024
# A task closes its partly filled windows once it has this many, which bounds its memory.
MOST_OPEN = 2048
SCHEMA = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class SumOfSquares:
    """Places sizes online into windows of a given capacity.

    ``levels[f]`` counts the open windows filled up to ``f``. A size goes to the level, or to a new
    window, for which the sum of the squared counts afterwards is smallest; of equal ones, to the
    fullest. That keeps all levels in stock, so most later sizes find an exact fit.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[int]] = [[] for _ in range(capacity)]
        self.open = 0
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and the offset in it."""
        room = self.capacity - size
        levels = self.levels
        rise = 2 * levels[size : self.capacity + 1] + 1
        rise[room] = 0  # a full window is no longer counted
        fall = 1 - 2 * levels[: room + 1]
        fall[0] = 0  # a new window leaves no level
        usable = levels[: room + 1] > 0
        usable[0] = True
        cost = np.where(usable, rise + fall, np.iinfo(np.int64).max)
        level = room - int(np.argmin(cost[::-1]))
        if level:
            window = self.windows[level].pop()
            levels[level] -= 1
            self.open -= 1
        else:
            window = self.made
            self.made += 1
        if level + size < self.capacity:
            self.windows[level + size].append(window)
            levels[level + size] += 1
            self.open += 1
        return window, level


class Packer:
    """Packs the documents of one task; pieces leave as soon as their window is full.

    Documents are cut into full windows and a rest, which is placed by :class:`SumOfSquares`. When
    too many windows are open, and at the end, they are closed: open windows join whole where they
    fit, the fullest first, and stand. Only the emptiest are torn, as many as the gaps of the others
    ask for. What then remains is cut into windows whose sizes are powers of two, so it needs no
    padding either. ``rests`` counts the ids placed by level, ``torn`` those whose place was undone.
    """

    def __init__(self, first_sequence: int, capacity: int = SEQUENCE, most_open: int = MOST_OPEN) -> None:
        self.capacity, self.most_open = capacity, most_open
        self.sequence = first_sequence
        self.rows: list[tuple] = []
        self.rests = self.torn = 0
        self._renew()

    def _renew(self) -> None:
        self.placing = SumOfSquares(self.capacity)
        self.held: dict[int, list[tuple]] = {}

    def add(self, doc, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc, start, ids[start : start + self.capacity], total)])
        if whole < total:
            self.rests += total - whole
            window, offset = self.placing.place(total - whole)
            held = self.held.setdefault(window, [])
            held.append((doc, whole, ids[whole:].copy(), total))
            if offset + total - whole == self.capacity:
                self._emit(self.held.pop(window))
            elif self.placing.open > self.most_open:
                self.refill()

    def refill(self) -> None:
        """Closes all open windows."""
        windows = self._joined()
        self._renew()
        full, left = divmod(sum(fill for fill, _ in windows), self.capacity)
        loose = deque(piece for _, window in windows[full:] for piece in window)
        self.torn += sum(len(ids) for _, _, ids, _ in loose)
        for fill, window in windows[:full]:
            self._fill(window, self.capacity - fill, loose)
            self._emit(window)
        while left:
            size, window = 1 << (left.bit_length() - 1), []
            self._fill(window, size, loose)
            self._emit(window)
            left -= size

    def _joined(self) -> list[tuple[int, list[tuple]]]:
        """The open windows, joined by best fit from the fullest on, with their fills, fullest first."""
        levels: list[list[list[tuple]]] = [[] for _ in range(self.capacity + 1)]
        for window in self.held.values():
            levels[sum(len(ids) for _, _, ids, _ in window)].append(window)
        joined = []
        for level in range(self.capacity, 0, -1):
            while levels[level]:
                window, fill = levels[level].pop(), level
                while fit := next((f for f in range(self.capacity - fill, 0, -1) if levels[f]), 0):
                    window += levels[fit].pop()
                    fill += fit
                joined.append((fill, window))
        return sorted(joined, key=lambda w: -w[0])

    @staticmethod
    def _fill(window: list[tuple], room: int, loose: deque[tuple]) -> None:
        while room:
            doc, start, ids, total = loose.popleft()
            window.append((doc, start, ids[:room], total))
            if len(ids) > room:
                loose.appendleft((doc, start + room, ids[room:], total))
            room -= min(room, len(ids))

    def _emit(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceCache:
    """The identifiers of a text as little-endian bytes, by the library and bounded caches."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    described = json.loads(library.to_str())
    splitting = described["pre_tokenizer"] or {}
    plain = (
        described["normalizer"] is None
        and splitting.get("type") == "ByteLevel"
        and not splitting["add_prefix_space"]
    )
    letters = {i: letter for i, letter in enumerate(byte_letters())}
    model = library.model

    tokenize, space = model.tokenize, letters[ord(" ")]

    def value(text: str) -> bytes:
        bare = text.removeprefix(" ")
        if plain and is_word(bare):
            # A single word needs no splitting rule: the model takes its bytes as letters, and
            # letters of ASCII stand for themselves.
            if bare.isascii():
                word = bare if len(bare) == len(text) else space + bare
            else:
                word = text.encode().decode("latin-1").translate(letters)
            ids = [token.id for token in tokenize(word)]
            return pack_ids(f"<{len(ids)}I", *ids)
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return PieceCache(value, b"".join)


def pack(
    documents: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = SEQUENCE,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    Each document is its token ids and ``end_id``; each id lies in exactly one piece. Every task
    packs the documents it reads, in one pass without a shuffle, so sequence ids begin with the
    task's number and no task waits for another. At most ``most_open`` windows are held in a task.
    Sequences are full or have a power of two as length, so nothing is padded. A null or empty text
    is its ``end_id`` alone; repeated rows are packed each; an empty table gives no rows; other
    columns are ignored. A lost task is packed again from the same rows, to the same pieces.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, most_open)
        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            texts = batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids = np.frombuffer(encode.of(texts[i].as_py()) + end, "<u4")
                packer.add(doc, ids)
            yield _batch(packer.taken(), doc_type)
        if doc_type is not None:
            packer.refill()
            yield _batch(packer.taken(), doc_type)

    rows = documents.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def _batch(rows: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 7
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = [doc_type] + [pa.int64()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
