"""Quality rules whose cutoffs are certified on labelled documents.

Signals are computed with built-in expressions in one pass over the texts. A cutoff is taken only
when an exact binomial test, corrected for the number of cutoffs tested, shows that it rejects at
most a given share of good documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import SPACE, bind, text_or_empty, written

WORDS = f"[^{SPACE}]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words

# Each rule rejects documents whose ratio is above its cutoff. The candidates are set
# before any label is seen, so the number of tests is known.
RATIOS = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "mark_ratio", "upper_ratio")
CUTOFFS = tuple(round(0.02 * step, 2) for step in range(1, 50))
ORDERED = "ordered"  # the sequence that goes through all rules


@dataclass(frozen=True)
class Certificate:
    """What a set of cutoffs guarantees.

    ``false_rejection``: the largest share of good documents that all rules together may reject in
    a stratum. ``error``: the probability that the chosen cutoffs of any stratum break that bound.
    """

    false_rejection: float = 0.02
    error: float = 0.05


def signals(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the integer signals of the base rules and the ratios of the tested ones.

    Added columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks, n_upper
    and those in ``RATIOS``; columns of these names in the input are replaced. A null text counts
    as empty; an empty text has zeros throughout.
    """
    text = text_or_empty(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    out = documents.withColumn("_signals", bind(text, lambda t: F.struct(
        bind(F.regexp_extract_all(t, F.lit(WORDS), F.lit(0)), _word_signals).alias("words"),
        _dropped(t, SYMBOLS).alias("n_symbols"),
        _dropped(t, "!?").alias("n_marks"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).alias("n_upper"),
    ))).withColumn("_dup", bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))))
    words = F.col("_signals.words")
    out = out.withColumns({
        "n_words": words["n_words"].cast("long"),
        "word_chars": words["word_chars"].cast("long"),
        "n_symbols": F.col("_signals.n_symbols").cast("long"),
        "n_dup_lines": F.col("_dup").cast("long"),
        "n_repeat_words": words["n_repeat_words"].cast("long"),
        "n_marks": F.col("_signals.n_marks").cast("long"),
        "n_upper": F.col("_signals.n_upper").cast("long"),
        "_lines": F.size(lines),
    })
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    out = out.withColumns({
        "symbol_ratio": F.col("n_symbols") / chars,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
        "mark_ratio": F.col("n_marks") / chars,
        "upper_ratio": F.col("n_upper") / chars,
    })
    return out.drop("_signals", "_dup", "_lines")


def base_failed() -> Column:
    """The fixed rules: too few words, or too many words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )


def _dropped(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _word_signals(words: Column) -> Column:
    n = F.size(words)
    return F.struct(
        n.alias("n_words"),
        F.length(F.array_join(words, "")).alias("word_chars"),
        F.when(n < 4, F.lit(0)).otherwise(_repeated(words)).alias("n_repeat_words"),
    )


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return bind(windows, lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)
    ).otherwise(_covered(_repeated_starts(hashes))))


def _repeated_starts(hashes: Column) -> Column:
    """Places of the hashes that occur again, in order: equal ones are neighbours once sorted."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p: Column) -> Column:
        def again(x: Column, j: Column) -> Column:
            before, after = F.get(p, j - 1)["h"], F.get(p, j + 1)["h"]
            return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

        return F.array_sort(F.transform(F.filter(p, again), lambda x: x["i"]))

    return bind(placed, places)


def _covered(starts: Column) -> Column:
    """Words covered by windows of three at these starts."""

    def total(s: Column) -> Column:
        steps = F.transform(
            s, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(s, j + 1) - x, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda sofar, x: sofar + x)

    return bind(starts, total)


def certified_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    certificate: Certificate = Certificate(),
) -> DataFrame:
    """One row per stratum with the lowest certified cutoff of each rule (null: rule unused).

    ``measured`` has the output of :func:`signals`, ``labels`` the columns doc_id and quality.
    Good documents are those labelled 1 and never 0; those that fail the base rules don't count.
    Cutoffs are tested from the most lenient downwards; a test passes when, were the share of good
    documents rejected larger than allowed, so few would be seen with a small probability only
    (exact binomial tail). The order is fixed and the tail grows as cutoffs fall, so each sequence
    keeps its level, and the levels of all sequences add up to ``certificate.error``.

    The number of good documents decides how a stratum spends the bound. Where it could certify
    every rule by a share of the bound of its own, each rule has its own sequence. Elsewhere there
    is one sequence through the rules in the order of ``RATIOS``: each step tests what all cutoffs
    so far reject together, against the whole bound; the first that fails ends it, and the rules
    after it are unused. The labels are cut to one row per document before the
    join, so repeated label rows change nothing; null ids and null qualities are left out.
    """
    good = (
        labels.groupBy(F.col("doc_id").alias("doc_id"))
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .filter("doc_id is not null and least = 1 and most = 1")
        .select("doc_id")
    )
    ratios = F.array(*[
        F.struct(F.lit(r).alias("rule"), _cutoffs_below(F.col(r)).alias("below")) for r in RATIOS
    ])
    held = measured.filter(~base_failed()).select(
        "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), ratios.alias("ratios")
    )
    ordered = F.struct(F.lit(ORDERED).alias("rule"), _steps_below(F.col("ratios")).alias("below"))
    counts = (
        held.join(good, "doc_id", "left_semi")
        .select("stratum", F.inline(F.concat("ratios", F.array(ordered))))
        .groupBy("stratum", "rule", "below")
        .count()
    )
    counts = written(counts, "cutoff_counts")
    strata = counts.select("stratum").distinct().count()
    steps = F.when(F.col("rule") == ORDERED, len(RATIOS) * len(CUTOFFS)).otherwise(len(CUTOFFS))
    tested = (
        counts.withColumn("step", F.explode(F.sequence(F.lit(0), steps - 1)))
        .groupBy("stratum", "rule", "step")
        .agg(
            F.sum("count").alias("n"),
            F.sum(F.when(F.col("below") > F.col("step"), F.col("count")).otherwise(0)).alias("k"),
        )
    )
    n, k, whole = F.col("n"), F.col("k"), certificate.false_rejection
    level = certificate.error / max(strata, 1)
    share, share_level = whole / len(RATIOS), math.log(level / len(RATIOS))
    many = n * math.log1p(-share) <= share_level
    passed = tested.filter(
        F.when(F.col("rule") == ORDERED, ~many & (_log_tail(n, k, whole) <= math.log(level)))
        .otherwise(many & (_log_tail(n, k, share) <= share_level))
    )
    cutoffs = F.array(*map(F.lit, CUTOFFS))
    lowest = {rule: F.min(F.when(F.col("rule") == rule, F.col("step"))) for rule in (*RATIOS, ORDERED)}
    return passed.groupBy("stratum").agg(*[
        F.get(cutoffs, F.coalesce(lowest[rule], _own_step(lowest[ORDERED], i)).cast("int")).alias(f"{rule}_cutoff")
        for i, rule in enumerate(RATIOS)
    ])


def _steps_below(ratios: Column) -> Column:
    """How many steps of the sequence through all rules reject a document. The steps are numbered
    from its end: the last rule's lowest cutoff is 0, the first rule's highest the last number."""
    n = len(CUTOFFS)
    return F.array_max(F.transform(
        ratios, lambda x, i: F.when(x["below"] > 0, n * (len(RATIOS) - 1 - i) + x["below"]).otherwise(0)
    ))


def _own_step(step: Column, i: int) -> Column:
    """The cutoff that rule ``i`` has at a step of the sequence through all rules."""
    n = len(CUTOFFS)
    reached = len(RATIOS) - 1 - F.floor(step / n)
    return F.when(F.lit(i) < reached, 0).when(F.lit(i) == reached, step % n)


def _cutoffs_below(ratio: Column) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda cutoff: ratio > cutoff))


def _log_tail(n: Column, k: Column, p: float) -> Column:
    """Logarithm of the exact probability of at most ``k`` successes in ``n`` trials.

    The terms follow from one another and are added as logarithms, so large ``n`` don't underflow.
    At or above the mean the tail is no smaller than about a half: there it is taken as one.
    """
    odds = math.log(p / (1 - p))
    first = n * math.log1p(-p)

    def step(sofar: Column, i: Column) -> Column:
        term = sofar["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        larger = F.greatest(term, sofar["total"])
        total = larger + F.log(F.exp(term - larger) + F.exp(sofar["total"] - larger))
        return F.struct(term.alias("term"), total.alias("total"))

    places = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.when(k >= n * p, F.lit(0.0)).otherwise(
        F.aggregate(places, start, step, lambda end: end["total"])
    )


def judged(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """The measured documents with base_failed and kept.

    A document is kept unless it fails the base rules or one of its ratios is above the certified
    cutoff of its stratum. A stratum without labels has no cutoffs: only the base rules apply.
    """
    own = F.coalesce(F.col(stratum).cast("string"), F.lit("")).eqNullSafe(F.col("_stratum"))
    joined = measured.join(cutoffs.withColumnRenamed("stratum", "_stratum"), own, "left")
    above = [F.coalesce(F.col(r) > F.col(f"{r}_cutoff"), F.lit(False)) for r in RATIOS]
    rejected = above[0]
    for rule in above[1:]:
        rejected = rejected | rule
    out = joined.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality_rules(
    documents: DataFrame, labels: DataFrame, stratum: str = "lang",
    certificate: Certificate = Certificate(),
) -> DataFrame:
    """Per document its signals, base_failed and kept (columns doc_id, text, ``stratum`` are read).

    The signals of all documents are written once as a narrow table that both the calibration and
    the verdict read. Empty tables give no rows; null and empty texts have zero signals and fail
    the base rules; repeated rows are judged one by one; other columns are ignored.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *RATIOS)
    base = documents.select("doc_id", "text", F.col(stratum).alias("stratum_value"))
    measured = written(signals(base).select("doc_id", "stratum_value", *names), "signals")
    cutoffs = written(
        certified_cutoffs(measured, labels, "stratum_value", certificate), "cutoffs"
    )
    return judged(measured, cutoffs, "stratum_value")


def keep_good(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents, with all their columns, that :func:`quality_rules` keeps.

    The cutoffs come from the narrow table; texts are then measured again where they lie, which
    costs less than moving them to a join and judges every row by its own text. The signals of this
    pass are unfolded from an array of one, so that the filter reads them instead of being pushed
    below with a second copy of their expressions. Null and empty texts fail the base rules and go,
    a very long text is measured as a whole, of repeated rows all or none stay, an empty table gives
    no rows, and further columns may have any names.
    """
    base = documents.select("doc_id", "text", F.col(stratum).alias("stratum_value"))
    names = ("stratum_value", "n_words", "n_repeat_words", *RATIOS)
    measured = written(signals(base).select("doc_id", *names), "signals")
    cutoffs = written(certified_cutoffs(measured, labels, "stratum_value"), "cutoffs")
    whole = documents.select(F.struct("*").alias("document")).select(
        "document", F.col("document.text").alias("text"), F.col(f"document.{stratum}").alias("stratum_value")
    )
    own = signals(whole).select("document", F.inline(F.array(F.struct(*names))))
    return judged(own, cutoffs, "stratum_value").filter("kept").select("document.*")
