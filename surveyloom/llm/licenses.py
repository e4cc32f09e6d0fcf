"""License scans by diagonal voting.

All rolling grams of a text's words are joined to the positions they have in the templates. A hit at word p
of the text and word t of a template votes for the diagonal p - t; words of one place share a diagonal, and a
word put in or left out moves the rest to a neighbouring one. Votes are summed by diagonal, neighbouring
diagonals merged, and a place is a candidate if enough of the template's grams voted for it. Its span is then
verified word by word: votes whose words are the template's are followed in the order of both, and the template's words they cover
are set against the words of the span. Phrases of the base hold only if every gram voted, on a single diagonal.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases and the labels they stand for.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wordings of well-known licenses, with labels after their public short names.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "under the bsd license": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
}

#: What separates words; letters A-Z are made small first.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LicenseRule:
    """Words of a gram, how far apart merged diagonals may be, and the share of grams a place needs, and of words its span.

    Templates of up to ``whole`` grams need all their words and no other: in so few, one more or less is another license.
    """

    gram: int = 3
    slack: int = 2
    share: float = 0.75
    whole: int = 6
    base: Mapping[str, str] = field(default_factory=lambda: BASE)
    templates: Mapping[str, str] = field(default_factory=lambda: TEMPLATES)


def words(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, with A-Z made small."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")


def _grams(of: Column, size: int) -> Column:
    """Each word with those after it, and a hash of them; near the end of fewer words, which no template has."""
    return F.transform(
        of,
        lambda w, i: F.struct(
            F.xxhash64(w, *[F.get(of, i + k) for k in range(1, size)]).alias("hash"), F.slice(of, i + 1, size).alias("words")
        ),
    )


def template_grams(spark: SparkSession, rule: LicenseRule) -> DataFrame:
    """``hash, gram, label, base, template, at, grams``: every gram of every template, and how many that has."""
    rows = []
    for no, (text, label, base) in enumerate(
        [(t, n, True) for t, n in rule.base.items()] + [(t, n, False) for t, n in rule.templates.items()]
    ):
        own = text.split()
        if len(own) < rule.gram:
            raise ValueError(f"a template needs {rule.gram} words: {text!r}")
        for at in range(len(own) - rule.gram + 1):
            gram = F.xxhash64(*[F.lit(w) for w in own[at : at + rule.gram]])
            spelt = F.array(*[F.lit(w) for w in own[at : at + rule.gram]])
            values = (gram, spelt, F.lit(label), F.lit(base), F.lit(no), F.lit(at), F.lit(len(own) - rule.gram + 1))
            names = ("hash", "gram", "label", "base", "template", "at", "grams")
            rows.append(F.struct(*[v.alias(n) for v, n in zip(values, names, strict=True)]))
    return spark.range(1).select(F.inline(F.array(*rows)))


def license_places(docs: DataFrame, rule: LicenseRule = LicenseRule()) -> DataFrame:
    """Places of templates: ``doc_id, text_key, template, label, base, first_word, last_word, score``.

    A row per place and distinct text of an id; ``last_word`` is the place's last word, ``score`` the template's words found in
    order, of the words of the template or, if these are more, of the place.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text"
    )
    grams = rows.select("doc_id", "text_key", words(F.col("text")).alias("words"))
    grams = grams.select("doc_id", "text_key", F.posexplode(_grams(F.col("words"), rule.gram)).alias("word", "own"))
    grams = grams.select("doc_id", "text_key", "word", F.col("own.hash").alias("hash"), F.col("own.words").alias("own"))
    # a fixed number of rows: the templates
    templates = F.broadcast(template_grams(docs.sparkSession, rule))
    hits = grams.join(templates, "hash").where("own = gram").drop("hash", "own", "gram").distinct()
    place = ["doc_id", "text_key", "template", "label", "base", "grams"]
    votes = hits.groupBy(*place, (F.col("word") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.collect_list(F.struct("at", "word")).alias("hits")
    )
    votes = votes.where(~F.col("base") | (F.col("votes") == F.col("grams")))
    # diagonals close to the one before belong to its place, but for the base, where each is its own
    along = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(along) > rule.slack)
    merged = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    merged = merged.withColumn("place", F.sum("new").over(along))
    found = merged.groupBy(*place, "place").agg(
        F.sum("votes").alias("votes"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits")
    )
    found = found.where(F.col("votes") >= rule.share * F.col("grams")).withColumn("span", _verified("hits", rule.gram))
    size = F.col("grams") + rule.gram - 1
    score = F.col("span.covered") / F.greatest(size, F.col("span.last") + rule.gram - F.col("span.first"))
    return (
        found.withColumn("score", score)
        .where((F.col("score") == 1) | ((F.col("score") >= rule.share) & (F.col("grams") > rule.whole)))
        .select(
            "doc_id", "text_key", "template", "label", "base", F.col("span.first").cast("long").alias("first_word"),
            (F.col("span.last") + rule.gram - 1).cast("long").alias("last_word"), "score",
        )
    )


def _verified(hits: str, gram: int) -> Column:
    """Of a place's votes, by place in the template: those that go on in the text as well, the first and last word where
    they begin, and how many of the template's words they cover."""
    none = F.lit(None).cast("int")
    start = F.struct(none.alias("at"), none.alias("first"), none.alias("last"), F.lit(0).alias("covered"))

    def follow(so_far: Column, hit: Column) -> Column:
        further = F.coalesce((hit["at"] > so_far["at"]) & (hit["word"] > so_far["last"]), F.lit(True))
        fresh = F.coalesce(F.least(F.lit(gram), hit["at"] - so_far["at"]), F.lit(gram))
        after = F.struct(
            hit["at"].alias("at"), F.coalesce(so_far["first"], hit["word"]).alias("first"), hit["word"].alias("last"),
            (so_far["covered"] + fresh).alias("covered"),
        )
        return F.when(further, after).otherwise(so_far)

    return F.aggregate(hits, start, follow)


def license_scan(docs: DataFrame, rule: LicenseRule = LicenseRule()) -> DataFrame:
    """Licenses every text names: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. A row per input row. ``n_base``
    counts all places of base phrases, ``first_word`` and ``last_word`` are their smallest and largest start, words
    counted from 0. Labels are distinct, sorted and joined by commas; ``score`` is the best place's.

    Defined cases: null and empty texts have no words, empty labels and score 0; rows that repeat id and text
    each have the same places; a null ``doc_id`` is scanned like any other. An empty table gives an empty one.
    """
    places = license_places(docs, rule)
    base = F.col("base")

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(of)), ",")

    found = places.groupBy("doc_id", "text_key").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    found = found.withColumnRenamed("doc_id", "found_id").withColumnRenamed("text_key", "found_key")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce(F.size(F.array_remove(F.split("text", BETWEEN), "")), F.lit(0)).cast("long").alias("n_words"),
    )
    same = (F.col("text_key") == F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id"))
    out = rows.join(found, same, "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
