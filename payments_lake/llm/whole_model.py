"""Cross-entropy difference: n-gram models of a target and a background over one vocabulary.

All words and word pairs of both tables are counted and looked up for each document.

Documents are dealt into stretches of a few MB. A stretch sends its distinct n-grams, each once, to
parts by hash; a part adds them up over all stretches and sends each stretch the counts of what it
asked for. So a word or pair that every document has is one item of a stretch, and no task or driver
holds a model.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import text_or_empty, written
from payments_lake.llm.shingles import FACTORS, mixed

BIGRAM_SHARE = 0.6
BIGRAM_PRIOR = 50.0
WORD_PRIOR = 0.5

STRETCH = 4_000_000  # bytes of text whose n-grams are counted at once in a task
PART_BYTES = 32_000_000  # bytes of text for each part of the n-grams
LEAST_PARTS = 1_024
CHUNK = 1_000_000  # bytes hashed at once

# N-grams are 64-bit hashes whose last two bits are their kind.
PAIR, WORD, BEFORE = 0, 1, 2
KINDS = np.uint64(3)

_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_VALUES = mixed(_LOWER.astype(np.uint64) + np.uint64(1))
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SPACE_AT = re.compile(rb"[\t-\r ]")
RADIX = FACTORS[0]
INVERSE = np.uint64(pow(int(RADIX), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class _Powers:
    """Powers of the radix and of its inverse, as many as were ever needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(RADIX, n), _powers(INVERSE, n)
        return cls.up, cls.down


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``CHUNK`` bytes; no word is cut."""
    at = 0
    while len(text) - at > CHUNK and (space := SPACE_AT.search(text, at + CHUNK)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (no ASCII white space, A to Z lower-cased) of all texts in order, and
    how many words each text has. Long texts are hashed piece by piece, so what is kept for it
    grows with the longest word only."""
    hashes, sizes = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    total = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            held.append(piece)
            owners.append(i)
            total += len(piece) + 1
            if total >= CHUNK:
                hashes.append(_counted(held, owners, sizes))
                held, owners, total = [], [], 0
    if held:
        hashes.append(_counted(held, owners, sizes))
    return np.concatenate(hashes), sizes


def _counted(texts: list[bytes], owners: list[int], sizes: np.ndarray) -> np.ndarray:
    hashes, counts = _hashed(texts)
    np.add.at(sizes, owners, counts)
    return hashes


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    up, down = _Powers.of(len(codes) + 1)
    space = IS_SPACE[codes]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    if space[-1] and len(edge) % 2:
        edge = edge[:-1]
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[codes] * up[: len(codes)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, text_ends), prepend=0)


class Grams:
    """The distinct n-grams of a list of texts: sorted hashes, counts, and for each word of the
    texts the places of its n-grams."""

    def __init__(self, texts: list[bytes]) -> None:
        hashes, self.sizes = hashed_words(texts)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        words, at = np.unique(hashes, return_inverse=True)
        self.word = at.reshape(-1) + 1  # 0 stands before a text
        self.base = len(words) + 1
        self.before = np.concatenate([[0], self.word[:-1]]) if len(hashes) else self.word
        begins = np.cumsum(self.sizes) - self.sizes
        self.before[begins[self.sizes > 0]] = 0
        pairs, at, counts = np.unique(self.before * self.base + self.word, return_inverse=True, return_counts=True)
        self.pair = at.reshape(-1)
        known = np.concatenate([np.zeros(1, np.uint64), words])
        earlier, later = known[pairs // self.base], known[pairs % self.base]
        befores = np.bincount(self.before, minlength=self.base)
        grams = np.concatenate([
            _kind(earlier * FACTORS[1] + later * FACTORS[2] + np.uint64(1), PAIR),
            _kind(words, WORD),
            _kind(known, BEFORE),
        ])
        counts = np.concatenate([counts, np.bincount(self.word, minlength=self.base)[1:], befores])
        order = np.argsort(grams, kind="stable")
        self.hashes, self.counts = grams[order], counts[order]
        self.order, self.pairs = order, len(pairs)

    def parts(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts that have n-grams, and where each part's n-grams begin, with the end."""
        part = ((self.hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        found, begins = np.unique(part, return_index=True)
        return found.astype(np.int64), np.append(begins, len(part))

    def losses(self, background: np.ndarray, target: np.ndarray, sums: tuple[int, int], size: int):
        """Per text the mean loss under the target and under the background without the text.

        ``background`` and ``target`` are counts of the n-grams in the order of ``hashes``, ``sums``
        the words of both tables, ``size`` the distinct words of both.
        """
        out = []
        n = len(self.sizes)
        scale = max(sums[1], 1) / max(sums[0], 1)
        for counts, total, scale, own in ((target, sums[1], 1.0, 0), (background, sums[0], scale, 1)):
            placed = np.empty(len(counts))
            placed[self.order] = counts
            words = np.concatenate([[0.0], placed[self.pairs : self.pairs + self.base - 1]])
            befores = placed[self.pairs + self.base - 1 :]
            word, before, pair = words[self.word], befores[self.before], placed[self.pair]
            if own:
                word = word - _repeats(self.doc * self.base + self.word)
                before = before - _repeats(self.doc * self.base + self.before)
                pair = pair - _repeats(self.doc * self.pairs + self.pair)
            rest = (total - own * self.sizes[self.doc]) * scale
            p_word = (word * scale + WORD_PRIOR) / (rest + WORD_PRIOR * size)
            p_pair = (pair * scale + BIGRAM_PRIOR * p_word) / (before * scale + BIGRAM_PRIOR)
            p = BIGRAM_SHARE * p_pair + (1 - BIGRAM_SHARE) * p_word
            out.append(-np.bincount(self.doc, np.log(p), minlength=n) / np.maximum(self.sizes, 1) + 0.0)
        return out


def _kind(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(kind)) & ~KINDS) | np.uint64(kind)


def _repeats(values: np.ndarray) -> np.ndarray:
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[inverse.reshape(-1)]


def packed(values: np.ndarray) -> bytes:
    """The bytes of the values, all first bytes first: what is alike in neighbours compresses."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _dealt(documents: DataFrame, stretch: int) -> DataFrame:
    """doc_id and text of the documents, written with the number of a stretch and the place in it.
    A stretch has rows of one task, of ``stretch`` bytes at most or a single one."""
    kind = dict(documents.dtypes)["doc_id"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, at, total = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            numbers, places = [], []
            for n in pc.binary_length(batch.column("text")).to_pylist():
                if at and total + n > stretch:
                    number, at, total = number + 1, 0, 0
                numbers.append(number)
                places.append(at)
                at, total = at + 1, total + n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64()), pa.array(places, pa.int64())],
                ["doc_id", "text", "stretch", "at"],
            )

    rows = documents.select("doc_id", text_or_empty("text").cast("binary").alias("text"))
    return written(rows.mapInArrow(deal, f"doc_id {kind}, text binary, stretch bigint, at bigint"), "stretches")


def _blocks(texts: DataFrame, is_target: bool, parts: int, stretch: int) -> DataFrame:
    """The distinct n-grams and their counts, by part, of each piece of a stretch that a task reads.
    The target's pieces get no answer, so they have no number."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        total, number, first, after = 0, None, 0, None

        def counted() -> pa.RecordBatch:
            grams = Grams(held)
            found, edges = grams.parts(parts)
            cuts = list(zip(edges[:-1], edges[1:]))
            counts = grams.counts.astype("<u4")
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array([number] * n, pa.int64()), pa.array([first] * n, pa.int64()),
                 pa.array([packed(grams.hashes[a:b]) for a, b in cuts], pa.binary()),
                 pa.array([packed(counts[a:b]) for a, b in cuts], pa.binary())],
                ["part", "stretch", "first", "grams", "counts"],
            )

        for batch in batches:
            rows = batch.num_rows
            numbers = [None] * rows if is_target else batch.column("stretch").to_pylist()
            places = [None] * rows if is_target else batch.column("at").to_pylist()
            for i, text in enumerate(batch.column("text")):
                value = text.as_py()
                cut = total + len(value) > stretch if is_target else (numbers[i], places[i]) != (number, after)
                if held and cut:
                    yield counted()
                    held, total = [], 0
                if not held:
                    number, first = numbers[i], places[i]
                held.append(value)
                total += len(value)
                after = None if is_target else places[i] + 1
        if held:
            yield counted()

    return texts.mapInArrow(block, "part bigint, stretch bigint, first bigint, grams binary, counts binary")


def _answered(blocks: DataFrame) -> DataFrame:
    """For each piece of a stretch and each part the counts of its n-grams in both tables. One more
    row of each part, without a stretch, has the distinct words and the words of both tables."""

    def answer(table: pa.Table) -> pa.Table:
        stretches, firsts = table.column("stretch").to_pylist(), table.column("first").to_pylist()
        grams = [unpacked(g.as_py(), "<u8") for g in table.column("grams")]
        counts = np.concatenate([unpacked(c.as_py(), "<u4") for c in table.column("counts")])
        sizes = [len(g) for g in grams]
        wanted = np.repeat([s is None for s in stretches], sizes)
        distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
        at = at.reshape(-1)
        totals = [
            np.bincount(at[side], counts[side], minlength=len(distinct)).astype("<i8") for side in (~wanted, wanted)
        ]
        words = (distinct & KINDS) == WORD
        rows, end = [], 0
        for number, first, n in zip(stretches, firsts, sizes):
            own, end = at[end : end + n], end + n
            if number is not None:
                rows.append((number, first, *(packed(t[own]) for t in totals), 0, 0, 0))
        rows.append((None, None, None, None, int(words.sum()), *(int(t[words].sum()) for t in totals)))
        part = table.column("part")[0].as_py()
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array([part] * len(rows), pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            names=["part", "stretch", "first", "background", "target", "words", "n_background", "n_target"],
        )

    schema = (
        "part bigint, stretch bigint, first bigint, background binary, target binary,"
        " words bigint, n_background bigint, n_target bigint"
    )
    return blocks.groupBy("part").applyInArrow(answer, schema)


def whole_difference(
    documents: DataFrame, target: DataFrame, parts: int | None = None, stretch: int = STRETCH
) -> DataFrame:
    """Per row: doc_id, n_words, target_loss, background_loss and score, their difference.

    ``target`` (text) is the domain wanted, the documents are the background. Losses are in nats
    per word; a negative score says that a document is more like the target. Both models count
    every word and word pair of whole texts of whole tables, over all words of both tables; a
    document's own counts are taken out of the background. ``parts`` and ``stretch`` don't change
    results.

    Null and empty texts have zero words, losses and score; repeated rows count and are scored
    each; a very long text is a stretch of its own; with an empty target its model is uniform; an
    empty table gives no rows; other columns are ignored.
    """
    dealt = _dealt(documents, stretch)
    wanted = target.select(text_or_empty("text").cast("binary").alias("text"))
    if parts is None:
        sizes = dealt.select("text").unionAll(wanted).agg(F.sum(F.octet_length("text"))).first()[0]
        parts = max(LEAST_PARTS, (sizes or 0) // PART_BYTES)
    answers = written(
        _answered(_blocks(dealt, False, parts, stretch).unionAll(_blocks(wanted, True, parts, stretch))), "answers"
    )
    found = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "n_background", "n_target")]).first()
    size, sums = found[0], (found[1], found[2])

    def score(rows: pa.Table, given: pa.Table) -> pa.Table:
        rows, given = rows.sort_by("at"), given.sort_by([("first", "ascending"), ("part", "ascending")])
        texts = [t.as_py() for t in rows.column("text")]
        firsts = given.column("first").to_numpy()
        cuts = [*np.unique(firsts).tolist(), len(texts)]
        counts, losses = [np.zeros(cuts[0], np.int64)], [[np.zeros(cuts[0])], [np.zeros(cuts[0])]]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            grams = Grams(texts[begin:end])
            own = given.filter(pa.array(firsts == begin))
            both = [
                np.concatenate([unpacked(c.as_py(), "<i8") for c in own.column(side)]) for side in ("background", "target")
            ]
            counts.append(grams.sizes)
            for out, found in zip(losses, grams.losses(*both, sums, size)):
                out.append(found)
        wanted_loss, background_loss = map(np.concatenate, losses)
        return pa.table(
            [rows.column("doc_id"), pa.array(np.concatenate(counts), pa.int64()), pa.array(wanted_loss),
             pa.array(background_loss), pa.array(wanted_loss - background_loss)],
            names=["doc_id", "n_words", "target_loss", "background_loss", "score"],
        )

    kind = dict(documents.dtypes)["doc_id"]
    given = answers.filter("stretch is not null").select("stretch", "part", "first", "background", "target")
    return dealt.groupBy("stretch").cogroup(given.groupBy("stretch")).applyInArrow(
        score, f"doc_id {kind}, n_words bigint, target_loss double, background_loss double, score double"
    )
