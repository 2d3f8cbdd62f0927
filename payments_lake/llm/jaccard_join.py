"""Exact Jaccard join on word shingles by a matrix of tokens and groups of similar documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payments_lake.llm.common import most_frequent, text_or_empty, written
from payments_lake.llm.components import components
from payments_lake.llm.shingles import shingle_set, shingles

PERCENT = 75
# Order of tokens: at most this many of the most frequent ones come last. Any order gives the same
# result; this one keeps passages that many documents share out of the prefixes.
MOST_COMMON = 200_000
COMMON_FROM = 50
# A task counts tokens over so many at a time and reports those it saw at least so often.
COUNT_STRETCH = 4_000_000
COUNT_FROM = 4
# Rounds in which groups of similar documents grow around pivots before the matrix is built.
ROUNDS = 2
PIVOTS = 2
# Prefixes are a tenth of the set longer than they must be for one token to be shared, so that the
# tokens they share tell more.
EXTRA = 10
# Sizes within a twentieth are one class; whole sets are bounded by classes of half a per cent.
CLASS = 1.05
FINE = 1.005


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Length of a set's prefix in the common order of tokens. Similar sets have at least
    ``percent`` of either in common, so they share at least one token within their prefixes."""
    return size - (percent * size + 99) // 100 + max(1, size // EXTRA)


def rest(size: Column, percent: int = PERCENT) -> Column:
    """Tokens of a set after its prefix."""
    return F.ceil(percent * size / 100) - F.greatest(F.lit(1), F.floor(size / EXTRA))


def asked(size: Column, other: Column, rests: Column, percent: int = PERCENT) -> Column:
    """Tokens that the prefixes of two similar sets of these sizes share at least.

    Similar sets overlap in ``percent / (100 + percent)`` of their sizes' sum. Of the two prefixes
    let one end first in the common order: all shared tokens up to there are in both prefixes, and
    after it come no more than its set's ``rests``.
    """
    return F.ceil(percent * (size + other) / (100 + percent)) - rests


def _set_id(tokens: np.ndarray) -> int:
    """64 bits that name a set; two sets of a billion get the same name with a chance of 3%."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def common_tokens(texts: DataFrame, most: int = MOST_COMMON) -> np.ndarray:
    """The most frequent shingles, counted over all documents, ascending; at most ``most``.

    Tasks count stretch by stretch and leave out what is rare within a stretch, so counts are
    somewhat low; they decide on the order of tokens only. Exact copies in a stretch count once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def counted() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= COUNT_FROM
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often].astype(np.int64))],
                ["token", "n"],
            )

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                name = xxhash.xxh3_64_intdigest(text)
                if name in seen:
                    continue
                seen.add(name)
                held.append(shingles(text))
                size += len(held[-1])
                if size >= COUNT_STRETCH:
                    yield counted()
                    held, seen, size = [], set(), 0
        if size:
            yield counted()

    counts = (
        texts.select("text").mapInArrow(count, "token bigint, n bigint")
        .groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_FROM)
    )
    rows = most_frequent(counts, most)
    return np.sort(np.array([r.token for r in rows], np.int64).view(np.uint64))


def shingle_sets(texts: DataFrame, common: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, row_hash, size, set_id (null without words), prefix and usual.

    The prefix of a set's tokens in the common order, which is uncommon ones by hash, then common
    ones by hash: ``usual`` has the common ones of it, ``prefix`` the others. Copies within a task
    have null prefixes, as one for each set is enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, names, rare, usual = [], [], [], []
            for text in batch.column("text"):
                tokens = shingle_set(text.as_py())
                sizes.append(len(tokens))
                names.append(_set_id(tokens) if len(tokens) else None)
                if names[-1] is None or names[-1] in seen:
                    rare.append(None)
                    usual.append(None)
                    continue
                seen.add(names[-1])
                at = np.searchsorted(common, tokens)
                at[at == len(common)] = 0
                is_common = common[at] == tokens if len(common) else np.zeros(len(tokens), bool)
                left = prefix_length(len(tokens), percent)
                rare.append(tokens[~is_common][:left].view(np.int64))
                usual.append(tokens[is_common][: left - len(rare[-1])].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(sizes, pa.int64()),
                 pa.array(names, pa.int64()), lists_of(rare), lists_of(usual)],
                ["doc_id", "row_hash", "size", "set_id", "prefix", "usual"],
            )

    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(
        run,
        f"doc_id {kind}, row_hash bigint, size bigint, set_id bigint, prefix array<bigint>, usual array<bigint>",
    )


def whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, tokens): all tokens, ascending, of the sets that ``wanted`` (set_id, doc_id,
    row_hash) names a row of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingle_set(text.as_py()).view(np.int64) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), lists_of(tokens)], ["set_id", "tokens"])

    named = wanted.select("set_id", F.col("doc_id").alias("of_doc"), F.col("row_hash").alias("of_row"))
    same = F.col("of_doc").eqNullSafe(F.col("doc_id")) & (F.col("of_row") == F.col("row_hash"))
    chosen = texts.join(named, same).select("set_id", "text").dropDuplicates(["set_id"])
    return chosen.mapInArrow(run, "set_id bigint, tokens array<bigint>")


def lists_of(arrays: list[np.ndarray | None]) -> pa.Array:
    """A list column of the arrays, null for None."""
    held = [a for a in arrays if a is not None]
    ends = np.cumsum([0, *(0 if a is None else len(a) for a in arrays)])
    missing = pa.array([a is None for a in arrays], pa.bool_())
    flat = pa.array(np.concatenate(held) if held else np.empty(0, np.int64))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=missing)


def arrays_of(batch: pa.RecordBatch, column: str = "tokens") -> Iterator[np.ndarray]:
    """The arrays of a list column, without a copy."""
    lists = batch.column(column)
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    ends = lists.offsets.to_numpy()
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        yield flat[start:end]


def size_class(size: Column, width: float = CLASS) -> Column:
    return F.floor(F.log(size) / F.log(F.lit(width))).cast("int")


def shared_places(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, set_id, size, class, centre) of the prefix tokens that two different sets have, for
    sets that may be similar to another; ``centre`` is the share of the prefix that is left.

    This is a first token-group matrix, with groups of sets of about the same size: its rows at a
    set's tokens add up to an overlap that bounds that with any other set of the size. A set for
    which all sizes stay closed is left out. Rows are at most the places times a few sizes. Common
    tokens are known to be shared, so only uncommon ones, which few sets have, are brought together.
    """
    token = Window.partitionBy("token")
    size = F.col("size")
    rare = (
        sets.select(F.explode("prefix").alias("token"), "set_id", "size")
        .withColumn("least", F.min("set_id").over(token))
        .withColumn("most", F.max("set_id").over(token))
        .filter("least <> most")
        .select("token", "set_id", "size")
        .distinct()
    )
    usual = sets.select(F.explode("usual").alias("token"), "set_id", "size").distinct()
    shared = written(rare.unionAll(usual).withColumn("class", size_class(size)), "shared")
    matrix = shared.groupBy("token", F.col("class").alias("met")).agg(
        F.count("*").alias("members"), F.min("size").alias("smallest"), F.max("size").alias("largest"),
        F.max(rest(size, percent)).alias("rests"),
    )
    least_size = F.greatest(F.col("smallest"), F.ceil(percent * size / 100))
    open_sizes = (
        shared.join(matrix, "token")
        .filter((F.col("members") > 1) | (F.col("class") != F.col("met")))
        .filter((100 * F.col("largest") >= percent * size) & (percent * F.col("smallest") <= 100 * size))
        .groupBy("set_id", "size", "met")
        .agg(F.count("*").alias("overlap"), F.min("smallest").alias("smallest"), F.max("rests").alias("rests"))
        .filter(F.col("overlap") >= asked(size, least_size, F.greatest(rest(size, percent), "rests"), percent))
    )
    kept = written(shared.join(open_sizes.select("set_id").distinct(), "set_id"), "open")
    prefix = size - rest(size, percent)
    centres = kept.groupBy("set_id", "size").agg((F.count("*") / F.first(prefix)).alias("centre"))
    return written(kept.join(centres.drop("size"), "set_id"), "places")


def met_by_others(places: DataFrame) -> DataFrame:
    """The places whose token occurs in more than one group."""
    groups = places.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most"))
    return places.join(groups.filter("least <> most").select("token"), "token")


def pivot_pairs(places: DataFrame, step: int, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of each set with its tokens' pivots, where they are in different groups.

    A pivot is one of the sets that have the token: first that with the most of its prefix in
    common with others, as the text that others were copied from has, then one drawn by hash.
    Tokens share ``PIVOTS`` ways to draw, so large groups have few pivots and pairs grow with the
    sets, not with their square. Pairs that meet at few tokens are left to the matrix.
    """
    key = F.xxhash64("set_id", F.pmod("token", F.lit(PIVOTS)), F.lit(step))
    drawn = F.struct(
        (-F.col("centre") if step == 0 else F.lit(0.0)).alias("order"), key.alias("key"),
        F.col("set_id").alias("pivot"), F.col("size").alias("size"), F.col("group").alias("group"),
    )
    size, other = F.col("size"), F.col("drawn.size")
    least = asked(size, other, F.greatest(rest(size, percent), rest(other, percent)), percent)
    pivots = places.groupBy("token").agg(F.min(drawn).alias("drawn"))
    return (
        places.join(pivots, "token")
        .filter("drawn.group <> group")
        .groupBy(F.col("drawn.pivot").alias("a"), F.col("set_id").alias("b"))
        .agg(F.count("*").alias("n"), F.min(least).alias("asked"))
        .filter(2 * PIVOTS * F.col("n") >= F.col("asked"))
        .select("a", "b")
    )


def qualifying_groups(places: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(set_id, met_group, met_class): the groups, by size classes, that a set can be similar to as
    far as prefixes tell.

    The matrix has a row for each token in the union of a group's prefixes, with the sizes of the
    members that have it. Its rows at a set's tokens add up to the overlap of the set with the
    union, which bounds that with any member. Where the bound is below what the sizes ask for, the
    group stays closed.
    """
    size = F.col("size")
    matrix = places.groupBy("token", F.col("group").alias("met_group"), F.col("class").alias("met_class")).agg(
        F.min("size").alias("smallest"), F.max("size").alias("largest"), F.max(rest(size, percent)).alias("rests")
    )
    least_size = F.greatest(F.col("smallest"), F.ceil(percent * size / 100))
    least = asked(size, least_size, F.greatest(rest(size, percent), "rests"), percent)
    return (
        places.join(matrix, "token")
        .filter(F.col("group") > F.col("met_group"))
        .filter((100 * F.col("largest") >= percent * size) & (percent * F.col("smallest") <= 100 * size))
        .groupBy("set_id", "size", "met_group", "met_class")
        .agg(F.count("*").alias("overlap"), F.min("smallest").alias("smallest"), F.max("rests").alias("rests"))
        .filter(F.col("overlap") >= least)
        .select("set_id", "met_group", "met_class")
    )


def matrix_pairs(places: DataFrame, sets: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) left after the token-group matrix: every pair of sets in different groups that
    may be similar, and some more. ``sets`` has set_id and all tokens.

    The groups that qualify by prefixes are cut into members of nearly one size and bounded again
    by whole sets: the matrix now has a row for each token in the union of such a part's sets, with
    the number of members that have it. A set
    that overlaps with the union in fewer tokens than it must share with a member of the group's
    smallest size leaves the group closed. An open group is asked at few tokens: of ``overlap``
    tokens that the union has, a similar member has at least ``least``, so it has one of any
    ``overlap - least + 1`` of them, and those that the fewest members have are taken. A set that
    barely qualifies, as those around a large group of near copies do, so meets few members.
    """
    met, coarse = ["met_group", "fine"], ["met_group", "met_class"]
    qualifying = written(qualifying_groups(places, percent), "qualifying")
    sized = sets.select("set_id", "tokens", F.size("tokens").cast("bigint").alias("size"))
    members = written(
        sized.join(groups, "set_id").select(
            "set_id", "size", "tokens", F.col("group").alias("met_group"),
            size_class(F.col("size")).alias("met_class"), size_class(F.col("size"), FINE).alias("fine"),
        ).join(qualifying.select(*coarse).distinct(), coarse, "left_semi"),
        "members",
    )
    places_of = members.select(*met, F.col("set_id").alias("b"), F.col("size").alias("b_size"), F.explode("tokens").alias("token"))
    matrix = places_of.groupBy(*met, "token").agg(F.count("*").alias("n"))
    sizes = members.groupBy(*coarse, "fine").agg(F.min("size").alias("smallest"))
    size, group = F.col("size"), Window.partitionBy("set_id", *met)
    least_size = F.greatest(F.col("smallest"), F.ceil(percent * size / 100))
    queries = (
        qualifying.join(sizes, coarse).join(sized, "set_id")
        .withColumn("least", F.ceil(percent * (size + least_size) / (100 + percent)))
        .select("set_id", "size", *met, "least", F.explode("tokens").alias("token"))
        .join(matrix, [*met, "token"])
        .withColumn("overlap", F.count("*").over(group))
        .filter("overlap >= least")
        .withColumn("place", F.row_number().over(group.orderBy("n", "token")))
        .filter("place <= overlap - least + 1")
        .select(*met, "token", F.col("set_id").alias("a"), "size")
    )
    return (
        queries.join(places_of, [*met, "token"])
        .filter((100 * size >= percent * F.col("b_size")) & (percent * size <= 100 * F.col("b_size")))
        .select("a", "b")
        .distinct()
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose whole sets are similar enough. ``sets`` has set_id and tokens, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for mine, other in zip(arrays_of(batch, "a_tokens"), arrays_of(batch, "b_tokens"), strict=True):
                shared = len(np.intersect1d(mine, other, assume_unique=True))
                kept.append(100 * shared >= percent * (len(mine) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    of_b = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("b_tokens"))
    of_a = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("a_tokens"))
    return pairs.join(of_b, "b").join(of_a, "a").mapInArrow(run, "a bigint, b bigint")


def row_hash(frame: DataFrame) -> Column:
    """A hash of all columns that can be hashed, whatever their names."""
    names = [f"`{c.replace('`', '``')}`" for c, kind in frame.dtypes if "map<" not in kind and kind != "variant"]
    return F.xxhash64(*map(F.col, names))


def labelled(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, row_hash, n_shingles, group (null without words) and component_id."""
    texts = documents.select("doc_id", text_or_empty("text").cast("binary").alias("text"), row_hash(documents).alias("row_hash"))
    sets = written(shingle_sets(texts, common_tokens(texts), percent), "sets")
    places = shared_places(sets.filter("prefix is not null").select("set_id", "size", "prefix", "usual"), percent)
    live = places.select("set_id").distinct()
    first = sets.filter("prefix is not null").groupBy("set_id").agg(F.min(F.struct("doc_id", "row_hash")).alias("first"))
    live_sets = written(whole_sets(texts, first.join(live, "set_id", "left_semi").select("set_id", "first.*")), "live")
    groups = live.select("set_id", F.col("set_id").alias("group"))
    for step in range(ROUNDS + 1):
        places = written(met_by_others(places.join(groups, "set_id")), "places")
        pairs = pivot_pairs(places, step, percent) if step < ROUNDS else matrix_pairs(places, live_sets, groups, percent)
        links = written(verified(written(pairs, "pairs"), live_sets, percent), "links")
        places = places.drop("group")
        if links.isEmpty():
            continue
        edges = links.join(groups.select(F.col("set_id").alias("a"), F.col("group").alias("ga")), "a").join(
            groups.select(F.col("set_id").alias("b"), F.col("group").alias("gb")), "b"
        )
        found = components(edges.select(F.col("ga").alias("a"), F.col("gb").alias("b")))
        groups = written(
            groups.join(found.withColumnRenamed("node", "group"), "group", "left").select(
                "set_id", F.coalesce("component", "group").alias("group")
            ),
            "groups",
        )
    grouped = sets.select("doc_id", "row_hash", F.col("size").alias("n_shingles"), "set_id").join(
        groups, "set_id", "left"
    ).withColumn("group", F.coalesce("group", "set_id"))
    ids = grouped.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    shared = grouped.filter("group is not null").join(ids, "group")
    alone = grouped.filter("group is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "row_hash", "n_shingles", "group", "component_id"]
    return shared.select(*columns).unionAll(alone.select(*columns))


def linked_components(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id it is linked with).

    Equal sets are one from the start. Groups of similar sets grow in ``ROUNDS`` rounds around
    pivots; the token-group matrix then finds every remaining pair between groups that can be
    similar, so no link that joins two components is lost. All pairs are verified on whole sets.

    Null and empty texts have no shingles and their own doc_id as component; a null doc_id counts
    in no minimum, so a component of such rows alone has a null id; repeated rows are one set; a
    very long text is one set of all its shingles, sixteen bytes for each of its words in memory;
    an empty table gives no rows; other columns are ignored.
    """
    return labelled(documents, percent).select("doc_id", "n_shingles", "component_id")


def one_per_component(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row, with all its columns, of each component: that with the smallest doc_id.

    Where several rows of a component have this doc_id, that with the smallest hash of all columns
    stays, whatever else the doc_id names. Of rows without words one stays for each doc_id. Rows
    without a doc_id can't be named and all stay. Further columns may have any names.
    """
    found = labelled(documents, percent).filter("doc_id = component_id")
    least = F.min("row_hash").alias("least_row")
    chosen = found.filter("group is not null").groupBy("group", "doc_id").agg(least).drop("group")
    empty = found.filter("group is null").groupBy("doc_id").agg(least)
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in documents.columns]
    rows = documents.select(F.col("doc_id").alias("of_doc"), row_hash(documents).alias("of_row"), F.struct(*columns).alias("row"))
    named = rows.join(
        chosen.unionAll(empty), (F.col("of_doc") == F.col("doc_id")) & (F.col("of_row") == F.col("least_row")), "left_semi"
    ).dropDuplicates(["of_doc", "of_row"])
    return named.unionAll(rows.filter("of_doc is null")).select("row.*")
