"""Token counts by byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from payments_lake.llm.common import text_or_empty
from payments_lake.llm.pieces import MOST_CACHED, PieceCache

# White space and the words of the vocabulary's splitting rule.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges.

    A heap holds the adjacent pairs by rank, then place; a linked list joins each symbol to its
    neighbours. A popped pair whose symbols have changed since is stale and skipped. Each merge
    takes one symbol away, so the count is the first number of symbols less the merges.
    """
    symbols = list(symbols)
    count = len(symbols)
    after = list(range(1, count)) + [-1]
    before = list(range(-1, count - 1))
    rank_of = ranks.get
    heap = []
    for i, pair in enumerate(pairwise(symbols)):
        rank = rank_of(pair)
        if rank is not None:
            heap.append((rank, i))
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if j < 0 or rank_of((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        after[i] = k = after[j]
        after[j] = -1
        count -= 1
        if k >= 0:
            before[k] = i
            rank = rank_of((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i))
        k = before[i]
        if k >= 0:
            rank = rank_of((symbols[k], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, k))
    return count


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: bytes that print stand for themselves, the
    others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else extra))
        extra += byte not in plain
    return letters


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCache:
    """The counting cache of a vocabulary file, read once in each Python worker."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    ranks = {tuple(pair): rank for rank, pair in enumerate(described["model"]["merges"])}
    special = [t["content"] for t in described["added_tokens"]]
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    letters = byte_letters()
    words: dict[str, int] = {}

    def word(text: str) -> int:
        found = words.get(text)
        if found is None:
            found = merged_length([letters[b] for b in text.encode()], ranks)
            if len(text) <= 64:
                if len(words) >= MOST_CACHED:
                    words.clear()
                words[text] = found
        return found

    def value(text: str) -> int:
        if cut is None or not cut.search(text):
            return sum(map(word, SPLIT.findall(text)))
        return sum(1 if i % 2 else sum(map(word, SPLIT.findall(part))) for i, part in enumerate(cut.split(text)))

    return PieceCache(value, sum)


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and over_limit (n_tokens above ``limit``).

    Counts equal the library's for the same file, without added begin or end tokens; a special
    token's string inside a text counts as that one token. Null and empty texts have no tokens.
    One narrow pass without a shuffle; repeated rows are counted each, an empty table gives none,
    other columns are ignored. A text without spaces costs n log n, and every cache is bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = counter(tokenizer_path)
        for batch in batches:
            found = [cache.of(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64()),
                 pa.array([n > limit for n in found], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    text = text_or_empty("text")
    rows = documents.select("doc_id", text.alias("text"))
    rows = rows.selectExpr("doc_id", "text", "cast(octet_length(text) as bigint) as n_bytes")
    kind = dict(documents.dtypes)["doc_id"]
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
