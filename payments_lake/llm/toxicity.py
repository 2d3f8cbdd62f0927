"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import text_or_empty

# Labelled rows of each class that are taken to find lexicons and to fit the classifier. This
# bounded sample is drawn by a hash of the doc_id over all labelled rows that may be learned from.
SAMPLE_PER_CLASS = 6_000
# A word or word beginning joins a lexicon when so strong a tie to the label is this unlikely.
MAX_CHANCE = 1e-6
MOST_FEATURES = 4_000
MOST_CACHED = 400_000
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)

# A seed lexicon of common insults.
SEED_WORDS = frozenset(
    "asshole bastard bitch clown creep disgusting dumb filth freak garbage idiot imbecile loser"
    " moron pathetic pig scum stupid trash vermin worthless".split()
)
WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[^\W\d_][*#@$]{2,}[^\W\d_]?")
BANDS = ("sure", "strong", "likely")
VOTERS = (
    "seed", *(f"words_{band}" for band in BANDS), *(f"starts_{band}" for band in BANDS),
    "masked", "shouted", "capitals",
)
# Rate among clean rows over rate among toxic rows, up to which a tie is strong, or a tie at all.
STRONG, LIKELY = 0.02, 0.2


def features(text: str) -> set[str]:
    """The distinct words, lower-cased, and their beginnings (marked by a tilde)."""
    words = {w.lower() for w in WORD.findall(text)}
    return words | {"~" + w[:n] for w in words for n in PREFIXES if len(w) > n}


@dataclass
class Voters:
    """Lexicon and pattern voters; each votes for toxic or abstains."""

    lexicon: dict[str, int] = field(default_factory=dict)  # feature: the bits of its voters
    number: dict[str, int] = field(default_factory=dict)  # feature: its place in the classifier

    known: dict[str, tuple[int, tuple[int, ...]]] = field(default_factory=dict)  # by word as written

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}  # each worker fills its own

    def _look_up(self, word: str) -> tuple[int, tuple[int, ...]]:
        """The votes of a word and the features it has, from a cache of bounded size."""
        w = word.lower()
        found = [f for f in (w, *("~" + w[:n] for n in PREFIXES if len(w) > n)) if f in self.lexicon]
        bits = 0
        for f in found:
            bits |= self.lexicon[f]
        if len(self.known) >= MOST_CACHED:
            self.known.clear()
        entry = self.known[word] = (bits, tuple(self.number[f] for f in found))
        return entry

    def read(self, text: str) -> tuple[int, list[int]]:
        """The votes as bits, and the features that the classifier knows."""
        bits, known = 0, set()
        for word in set(WORD.findall(text)):
            votes, numbers = self.known.get(word) or self._look_up(word)
            if votes:
                bits |= votes
                known.update(numbers)
        masked = any(c in text for c in "*#@$") and MASKED.search(text) is not None
        written = text.encode()
        letters = len(written) - len(written.translate(None, LETTERS))
        capitals = len(written) - len(written.translate(None, CAPITALS))
        bits |= masked << VOTERS.index("masked")
        bits |= ("!!" in text) << VOTERS.index("shouted")
        bits |= (2 * capitals > letters > 0) << VOTERS.index("capitals")
        return bits, sorted(known)


CAPITALS = string.ascii_uppercase.encode()
LETTERS = string.ascii_letters.encode()


def chance(a: int, n: int, p: float) -> float:
    """Exact probability of at least ``a`` of ``n`` at a rate of ``p``."""
    if a <= n * p:
        return 1.0
    odds = math.log(p) - math.log1p(-p)
    term = math.lgamma(n + 1) - math.lgamma(a + 1) - math.lgamma(n - a + 1) + a * odds + n * math.log1p(-p)
    total, i = 0.0, a
    first = term
    while i <= n and term > first - 40:
        total += math.exp(term - first)
        term += math.log((n - i) / (i + 1)) + odds if i < n else 0
        i += 1
    return math.exp(first) * total


def find_lexicons(texts: list[str], labels: list[int]) -> Voters:
    """Voters from a labelled sample: the seed words, and words and beginnings tied to the label.

    Those never seen in a clean row, seldom seen there, and seen less than in toxic rows vote
    apart, as their accuracies differ.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for text, label in zip(texts, labels, strict=True):
        seen[label].update(features(text))
    toxic, clean = max(sum(labels), 1), max(len(labels) - sum(labels), 1)
    p = toxic / (toxic + clean)
    found = []
    for f, n in seen[1].items():
        other = seen[0][f]
        ratio = (other / clean) / (n / toxic)
        if n >= 3 and ratio <= LIKELY and (c := chance(n, n + other, p)) <= MAX_CHANCE:
            found.append((c, f, 0 if not other else 1 if ratio <= STRONG else 2))
    voters = Voters()
    for _, f, band in sorted(found)[:MOST_FEATURES]:
        kind = "starts" if f.startswith("~") else "words"
        voters.lexicon[f] = 1 << VOTERS.index(f"{kind}_{BANDS[band]}")
    for f in sorted(SEED_WORDS):
        voters.lexicon[f] = voters.lexicon.get(f, 0) | 1 << VOTERS.index("seed")
    voters.number = {f: i for i, f in enumerate(voters.lexicon)}
    return voters


# Rates of the votes among clean and toxic texts before any label is seen; they weigh two rows.
BELIEF = np.array([[0.01] * 7 + [0.05] * 3, [0.5] * 7 + [0.05] * 3])


class LabelModel:
    """A latent-class model of the votes, fitted to the counts of all vote patterns.

    For each voter its rates in both classes are estimated by expectation and maximisation; votes
    of labelled rows are the prior. From the posterior follow the voters' correlations within the
    classes, and a voter counts by one over the sum of its correlations, so that lexicons that
    repeat one another don't count as independent evidence.
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, labels: np.ndarray) -> None:
        votes = _bits(patterns)
        prior = np.array([2 * BELIEF[y] + _bits(known[labels == y]).sum(axis=0) for y in (0, 1)])
        sizes = np.array([2.0 + (labels == y).sum() for y in (0, 1)])
        self.rates, self.share = prior / sizes[:, None], 0.1
        self.weights = np.ones(len(VOTERS))
        self.correlations = np.eye(len(VOTERS))
        if len(labels):
            self.share = float(sizes[1] / sizes.sum())
        for _ in range(20):
            posterior = self.posterior(patterns)
            for y, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
                # Labelled rows keep half of the weight whatever the number of others.
                scale = sizes[y] / max(weight.sum(), 1e-9)
                self.rates[y] = (prior[y] + scale * (weight @ votes)) / (2 * sizes[y])
            self.rates = np.clip(self.rates, 1e-4, 1 - 1e-4)
            self._correlate(votes, counts, posterior)
            self.share = float(np.clip((counts @ posterior) / max(counts.sum(), 1), 1e-3, 0.5))

    def _correlate(self, votes: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> None:
        total = np.zeros((len(VOTERS), len(VOTERS)))
        for y, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            rest = votes - self.rates[y]
            total += (rest * weight[:, None]).T @ rest
        spread = np.sqrt(np.maximum(np.diag(total), 1e-9))
        self.correlations = total / spread[:, None] / spread[None, :]
        off = np.abs(self.correlations) - np.eye(len(VOTERS))
        self.weights = 1 / (1 + np.maximum(off, 0).sum(axis=1))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of toxic for each vote pattern."""
        votes = _bits(patterns)
        logs = [
            (self.weights * (votes * np.log(self.rates[y]) + (1 - votes) * np.log(1 - self.rates[y]))).sum(axis=1)
            for y in (0, 1)
        ]
        odds = logs[1] - logs[0] + math.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _bits(patterns: np.ndarray) -> np.ndarray:
    return ((patterns[:, None] >> np.arange(len(VOTERS))) & 1).astype(float)


class Classifier:
    """Logistic regression on the known features and the votes, trained on posterior labels."""

    def __init__(self, rows: list[tuple[int, list[int]]], targets: np.ndarray, size: int) -> None:
        self.size = size
        self.theta = np.zeros(size + len(VOTERS) + 1)
        if not rows:
            self.theta[-1] = -4.0
            return
        columns = [self.columns(*row) for row in rows]
        at = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
        column = np.concatenate(columns)
        moment = np.zeros_like(self.theta)
        square = np.zeros_like(self.theta)
        for step in range(1, 301):
            z = np.bincount(at, weights=self.theta[column], minlength=len(rows))
            error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - targets
            gradient = np.bincount(column, weights=error[at], minlength=len(self.theta)) / len(rows)
            gradient[:-1] += 1e-5 * self.theta[:-1]
            moment = 0.9 * moment + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            self.theta -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)

    def columns(self, bits: int, known: list[int]) -> np.ndarray:
        votes = [self.size + j for j in range(len(VOTERS)) if bits >> j & 1]
        return np.array([*known, *votes, len(self.theta) - 1], np.int64)

    def score(self, bits: int, known: list[int]) -> float:
        z = self.theta[self.columns(bits, known)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from. A null doc_id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_rows(documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """doc_id, text and toxic of at most about ``per_class`` documents of each class.

    Labels are cut to one row per document; those that contradict themselves are left out. The
    chosen ids, a bounded number, are sent to the documents, so no text is moved.
    """
    known = (
        labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter(F.col("toxic").isin(0, 1) & (F.col("toxic") == F.col("most")) & ~held_out(F.col("doc_id")))
    )
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    taken = None
    for toxic, size in sizes.items():
        own = (F.col("toxic") == toxic) & (part < min(1.0, per_class / size))
        taken = own if taken is None else taken | own
    chosen = known.filter(F.lit(False) if taken is None else taken).select("doc_id", "toxic")
    texts = documents.select("doc_id", text_or_empty("text").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def toxicity(
    documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Only the text enters a score. Lexicons come from a bounded sample of labelled rows that aren't
    held out; vote patterns are counted over all documents; the label model turns them into
    posterior labels, on which the classifier is trained. Without labels the seed lexicon and the
    patterns vote alone. Null and empty texts have a low score; repeated rows are scored each; an
    empty table gives no rows; other columns are ignored.
    """
    sample = [(r.text, r.toxic) for r in training_rows(documents, labels, per_class).collect()]
    sample.sort()  # the order in which rows arrive doesn't matter
    # Lexicons are found on two thirds; the accuracies start from the rest, which they haven't seen.
    found_on = [row for i, row in enumerate(sample) if i % 3]
    voters = find_lexicons([t for t, _ in found_on], [y for _, y in found_on])
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(voters.read(text.as_py())[0] for text in batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["votes", "n"]
        )

    # At most two to the number of voters rows come to the driver.
    patterns = (
        rows.select("text").mapInArrow(vote, "votes bigint, n bigint").groupBy("votes")
        .agg(F.sum("n").alias("n")).orderBy("votes").collect()
    )
    read = [voters.read(text) for text, _ in sample]
    rest = [(bits, y) for (bits, _), (_, y) in zip(read[::3], sample[::3], strict=True)]
    model = LabelModel(
        np.array([r.votes for r in patterns], np.int64), np.array([r.n for r in patterns], float),
        np.array([bits for bits, _ in rest], np.int64), np.array([y for _, y in rest], np.int64),
    )
    targets = model.posterior(np.array([bits for bits, _ in read], np.int64)) if read else np.empty(0)
    classifier = Classifier(read, targets, len(voters.number))
    if not sample:  # nothing to train on: the label model's own posterior is the score
        def score_of(bits: int, known: list[int]) -> float:
            return float(model.posterior(np.array([bits], np.int64))[0])
    else:
        score_of = classifier.score

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_of(*voters.read(text.as_py())) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
