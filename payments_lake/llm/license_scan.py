"""License scan with a positional index of rare words, in built-in expressions only.

Templates are indexed word by word with their positions. Per file its rarest licence words are
looked up; occurrences of different words that agree on where a template would begin are counted
together; the mandatory key phrases of a template are then verified word by word.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from payments_lake.llm.common import bind, lower_ascii, text_or_empty, written

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A license notice: its label, its words, and the phrases without which it is no match."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


# Fixed values. The base phrases: each is a template that is its own key phrase.
BASE = (
    Template("mit", "mit license", ("mit license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("gpl", "general public license", ("general public license",), True),
)
# Short notices as they are usually written, with the phrase that tells each from the others.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license version",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("bsd", "licensed under the bsd license", ("bsd license",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
TEMPLATES = BASE + NOTICES
# Words that every text has; they are verified in key phrases but never looked up.
COMMON = frozenset("a and any are at by for from in into is it of on or that the this to use with without".split())
# A notice matches when words holding this share of its rarity stand where they should.
MIN_SHARE = 0.6
RAREST = 3  # a template is entered through the rarest words of a file, at least this many


def _words(text: str) -> list[str]:
    return re.findall(WORDS, text)


def vocabulary() -> list[str]:
    return sorted({w for t in TEMPLATES for w in _words(t.text)})


def indexed(documents: DataFrame) -> DataFrame:
    """Per row doc_id, n_words and its places of template words, as (word, position) pairs.

    This is the only pass over the texts. Rows without an uncommon template word, nearly all, keep
    an empty list; the others list common template words too, for the key phrases.
    """
    every = vocabulary()
    rare = [w for w in every if w not in COMMON]

    def places(words: Column) -> Column:
        listed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
        none = F.slice(listed, 1, 0)
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.when(
                F.arrays_overlap(words, F.array(*map(F.lit, rare))),
                F.filter(listed, lambda x: x["word"].isin(every)),
            ).otherwise(none).alias("places"),
        )

    found = bind(F.regexp_extract_all(lower_ascii(text_or_empty("text")), F.lit(WORDS), F.lit(0)), places)
    return documents.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def document_frequencies(hits: DataFrame) -> tuple[int, dict[str, int]]:
    """Rows, and per uncommon template word the rows that have it: at most one per word."""
    words = hits.select(F.explode(F.array_distinct("places.word")).alias("word"))
    counted = words.filter(~F.col("word").isin(*COMMON)).groupBy("word").count().collect()
    return hits.count(), {r["word"]: r["count"] for r in counted}


def postings(rarity: dict[str, float]) -> list[tuple]:
    """The index: (template, word, position, rarity, in_phrase, is_base) for each template word."""
    rows = []
    for number, template in enumerate(TEMPLATES):
        words = _words(template.text)
        in_phrase = set()
        for phrase in map(_words, template.phrases):
            begin = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
            in_phrase.update(range(begin, begin + len(phrase)))
        rows += [(number, w, i, rarity.get(w, 0.0), i in in_phrase) for i, w in enumerate(words)]
    return rows


def matches(hits: DataFrame, rarity: dict[str, float]) -> DataFrame:
    """Verified matches: row, template, start (a word number), share of the template's rarity.

    A file enters each template through the rarest of its words that the template has. A base
    phrase has at most ``RAREST`` words, so none of its places can be missed.
    """
    spark = hits.sparkSession
    index = F.broadcast(spark.createDataFrame(  # one row per word of the fixed templates
        postings(rarity), "template int, word string, position int, rarity double, in_phrase boolean"
    ))
    places = hits.select("row", F.inline("places"))
    known = places.select("row", "word").distinct().join(index.filter("rarity > 0"), "word")
    rank = F.dense_rank().over(
        Window.partitionBy("row", "template").orderBy(F.desc("rarity"), "word")
    )
    entered = known.withColumn("rank", rank).filter(F.col("rank") <= RAREST)
    starts = (
        entered.join(places, ["row", "word"])
        .select("row", "template", (F.col("at") - F.col("position")).alias("start"))
        .distinct()
    )
    stands = (
        starts.join(index, "template")
        .withColumn("at", F.col("start") + F.col("position"))
        .join(places.withColumn("stands", F.lit(True)), ["row", "word", "at"], "left")
    )
    there = F.coalesce(F.col("stands"), F.lit(False))
    return (
        stands.groupBy("row", "template", "start")
        .agg(
            (F.sum(F.when(there, F.col("rarity")).otherwise(0.0)) / F.sum("rarity")).alias("share"),
            F.bool_and(there | ~F.col("in_phrase")).alias("phrases"),
        )
        .filter(F.col("phrases") & (F.col("share") >= MIN_SHARE))
        .drop("phrases")
    )


def scanned(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a base phrase stands, else the largest share of a template's rarity that
    a verified match has, else 0. Null, empty and unmatched texts have no labels (empty strings)
    and null word numbers; repeated rows are scanned each, told apart by a row number; an empty
    table gives no rows; other columns are ignored. Only licence words are ever shuffled.
    """
    hits = written(
        indexed(documents).withColumn("row", F.monotonically_increasing_id()), "license_words"
    )
    rows, frequencies = document_frequencies(hits)
    rarity = {
        w: math.log((rows + 1) / (frequencies.get(w, 0) + 1)) + 1e-6
        for w in vocabulary() if w not in COMMON
    }
    labels = F.array(*[F.lit(t.label) for t in TEMPLATES])
    found = matches(hits, rarity).select(
        "row", "start", "share", F.get(labels, F.col("template")).alias("label"),
        (F.col("template") < len(BASE)).alias("is_base"),
    )
    base = F.col("is_base")
    per_row = found.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.least(F.lit(1.0), F.max(F.when(base, F.lit(1.0)).otherwise(F.col("share")))).alias("score"),
    )
    none = F.array().cast("array<string>")
    return hits.drop("places").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        *[F.array_join(F.sort_array(F.coalesce(c, none)), ",").alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
