"""Secret scan: fixed patterns, and character Markov models of random strings and of identifiers."""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import text_or_empty

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY_HINTS = ("passw", "secret", "token", "apikey", "api_key")
MIN_VALUE = 6

# Candidates of the models: unbroken runs of this alphabet.
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
STATES = len(ALPHABET) + 1  # the last state is any other character, and the edge of a run
CODES = np.full(256, STATES - 1, np.int64)
CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
# Alphabets in which random strings are commonly written; labelled samples of the corpus are added.
RANDOM_ALPHABETS = (
    "0123456789abcdef",
    string.ascii_uppercase + "234567",
    string.ascii_uppercase + string.digits,
    string.ascii_lowercase + string.digits,
    string.ascii_letters + string.digits,
    string.ascii_letters + string.digits + "+/",
    string.ascii_letters + string.digits + "-_",
)
# Labelled samples of ordinary identifiers: common words joined in the usual ways, and separators.
ORDINARY_WORDS = (
    "get set user name value max min count index file path data base table column row key list map"
    " open close read write start stop connection pool size buffer string number date time error"
    " message request response handler service config default version test build result update"
).split()
ORDINARY_OTHERS = ("=" * 40, "-" * 40, "_" * 40, "2024-01-31-12-59-30", "1234567890" * 3, "/usr/local/lib/", "+" * 40)
SAMPLE_WEIGHT = 20
# A candidate is a secret when random characters explain it this much better (natural logarithm).
# That outweighs odds of one secret in a million candidates. Long unusual names add up slowly, so
# the mean over the characters has a bound too.
MIN_RATIO = 14.0
MIN_MEAN = 1.2


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the fixed patterns, per kind leftmost and not overlapping."""
    spans = []
    lowered = text.lower()
    if any(hint in lowered for hint in KEY_HINTS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def secret_values(text: str) -> list[str]:
    """What the fixed patterns mark as secret: the labelled samples of random strings."""
    values = [m[0] for pattern in (ACCESS, HEX) for m in pattern.finditer(text)]
    if any(hint in text.lower() for hint in KEY_HINTS):
        values += [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE and re.search(r"\d", m[2])]
    return values


def pair_counts(text: bytes) -> np.ndarray:
    """Counts of adjacent characters, as a flat matrix; other characters share one state."""
    codes = CODES[np.frombuffer(b" " + text + b" ", np.uint8)]
    return np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES * STATES)


def train(documents: DataFrame) -> np.ndarray:
    """Log-likelihood ratios of character pairs, random over ordinary, from all documents.

    Labelled samples: values that the fixed patterns find are random strings, all other text is
    ordinary. Each task adds up its matrix, so at most 2 x 68 x 68 counts leave a task and come to
    the driver, whatever the size of the corpus. Uniform strings over the usual alphabets are added
    to the random side, so an empty table gives usable models too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary = np.zeros(STATES * STATES, np.int64)
        random = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            for item in batch.column("text"):
                text = item.as_py()
                values = secret_values(text)
                ordinary += pair_counts(text.encode())
                for value in values:
                    own = pair_counts(value.encode())
                    random += own
                    ordinary -= own
        for is_random, counts in ((False, ordinary), (True, random)):
            pairs = np.flatnonzero(counts > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([is_random] * len(pairs), pa.bool_()), pa.array(pairs, pa.int32()), pa.array(counts[pairs], pa.int64())],
                ["is_random", "pair", "n"],
            )

    rows = documents.select(text_or_empty("text").alias("text"))
    counts = rows.mapInArrow(count, "is_random boolean, pair int, n bigint")
    totals = counts.groupBy("is_random", "pair").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros((2, STATES * STATES))
    for row in totals:
        seen[int(row.is_random), row.pair] = row.n
    return log_ratios(*seen)


def ordinary_samples() -> list[str]:
    """Identifiers of three words each, in the usual spellings."""
    out = list(ORDINARY_OTHERS)
    for i, first in enumerate(ORDINARY_WORDS):
        words = [first, ORDINARY_WORDS[i * 7 % len(ORDINARY_WORDS)], ORDINARY_WORDS[i * 11 % len(ORDINARY_WORDS)]]
        capital = "".join(w.capitalize() for w in words)
        out += [capital, first + capital[len(first) :], "".join(words)]
        out += [sep.join(words) for sep in ("_", "-", "/")] + ["_".join(words).upper(), f"{capital}{i % 10}"]
    return out


def log_ratios(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Of pair counts, the corpus's and the fixed samples', the matrix of random over ordinary."""
    samples = [SAMPLE_WEIGHT * pair_counts(text.encode()) for text in ordinary_samples()]
    ordinary = (np.maximum(ordinary, 0) + sum(samples)).reshape(STATES, STATES)
    random = random.reshape(STATES, STATES).astype(float)
    for alphabet in RANDOM_ALPHABETS:
        codes = CODES[[ord(c) for c in alphabet]]
        random[np.ix_(codes, codes)] += 200.0 / len(alphabet)
    return np.log(_rates(random) / _rates(ordinary))


def _rates(counts: np.ndarray) -> np.ndarray:
    """Transition probabilities with half a count added everywhere."""
    counts = counts + 0.5
    return counts / counts.sum(axis=1, keepdims=True)


def ratio(value: str, ratios: np.ndarray) -> float:
    """Log-likelihood ratio of a run's characters, each given the one before."""
    codes = CODES[np.frombuffer(value.encode(), np.uint8)]
    return float(ratios[codes[:-1], codes[1:]].sum())


def all_spans(text: str, ratios: np.ndarray, min_ratio: float = MIN_RATIO) -> list[tuple[str, int, int]]:
    """Fixed spans and those of the models, by start, then kind. Every run is scored, letters of one
    case too; of a run that fixed spans overlap, what they leave on each side is scored by itself."""
    spans = base_spans(text)
    fixed = sorted((start, end) for _, start, end in spans)
    for m in CANDIDATE.finditer(text):
        for start, end in _left(*m.span(), fixed):
            if ratio(text[start:end], ratios) >= max(min_ratio, MIN_MEAN * (end - start)):
                spans.append(("random", start, end))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def _left(start: int, end: int, fixed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a run between the fixed spans, which are sorted."""
    out = []
    for a, b in fixed:
        if a < end and start < b:
            if start < a:
                out.append((start, a))
            start = b
    return [*out, (start, end)] if start < end else out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(documents: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (code points, end exclusive).

    Null and empty texts have no spans; repeated rows are scanned each; an empty table gives no
    rows; other columns are ignored. The models are one fixed-size matrix sent with the tasks.
    """
    ratios = train(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(text.as_py(), ratios, min_ratio) for text in batch.column("text")]
            counts = [[sum(kind == k for k, _, _ in spans) for spans in found] for kind in KINDS[:3]]
            base = [joined([s for s in spans if s[0] != "random"]) for spans in found]
            hashes = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(hashes, pa.string()), pa.array(map(joined, found), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def redacted(documents: DataFrame, mark: str = "<secret>", min_ratio: float = MIN_RATIO) -> DataFrame:
    """The documents with every found span replaced by ``mark``; overlapping spans are one.

    Only the text changes (and n_chars, where there is one, to the new length); null texts stay
    null and all other columns are kept as they are.
    """
    ratios = train(documents)

    @F.pandas_udf("string")
    def clean(texts):
        def one(text):
            return None if text is None else _replaced(text, all_spans(text, ratios, min_ratio), mark)

        return texts.map(one)

    out = documents.withColumn("text", clean(F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in documents.columns])


def _replaced(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])
