"""License scans by diagonal voting, with DataFrame functions only.

Every pair of neighbouring words of every text is hashed and joined with the places of that pair
in known phrases and notices. A hit votes for the diagonal (word position less template
position) it lies on; the places voted for on neighbouring diagonals are united, which allows
for words put in or left out, and a span counts when it covers enough distinct places of its
template with as many distinct places of the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataline.llm.storage import stored

#: Phrases whose every place counts, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of common notices, with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "all rights reserved": "reserved",
}

#: Neighbouring diagonals that vote together, and the share of a notice's word pairs that a span covers.
NEIGHBOURS = 2
COVERAGE = 0.85
#: A notice of at least so many pairs also counts with one gap of up to so many neighbouring pairs: one
#: word put in (breaks one pair), left out or replaced (breaks two).
GAP_FROM, GAP = 4, 2
#: Pairs that tell licenses apart: a gap may hold none of them (`cc by sa 4 0` is not `cc by 4 0`).
KEY_PAIRS = frozenset(
    (
        "mit license", "apache license", "gnu general", "lesser general", "general public", "public license", "cc by", "by 4", "by sa",
        "sa 4", "by nc", "nc 4", "creative commons", "commons attribution", "attribution noncommercial", "mozilla public",
    )
)
#: With at most so many distinct pairs in the templates, other pairs of a text are sorted out
#: before they become rows; with more, all pairs are joined.
LISTED_PAIRS = 10_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a whole text after lower-casing A-Z; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def template_pairs(base: dict[str, str], notices: dict[str, str]) -> list[tuple]:
    """(template, is_base, label, pairs in all, position, first word, second word)."""
    rows = []
    for k, (phrase, label) in enumerate([*base.items(), *notices.items()]):
        words = phrase.split()
        if len(words) < 2 or any(not re.fullmatch(WORD, w) for w in words):
            raise ValueError(f"a template needs two or more words: {phrase!r}")
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            rows.append((k, k < len(base), label, len(words) - 1, i, *pair))
    return rows


def _pairs_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    keys: dict[int, list[int]] = {}
    for template, *_, place, t1, t2 in rows:
        keys.setdefault(template, []).extend([place] * (f"{t1} {t2}" in KEY_PAIRS))
    kind = "template int, is_base boolean, label string, pairs int, place int, t1 string, t2 string, keys array<int>"
    return spark.createDataFrame([(*r, keys[r[0]]) for r in rows], kind).withColumn("hash", F.xxhash64("t1", "t2"))


def scan_licenses(documents: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    n_base counts all places of base phrases, first_word and last_word are the smallest and
    largest word they start at (null without any). base_labels and labels are distinct, sorted
    and joined by commas, empty without any. A notice counts with COVERAGE of its pairs, or with one
    gap (see GAP). score is the largest share of a template's word
    pairs that neighbouring diagonals cover, each counted once, 1 at a base place, 0 without a hit. A null or empty
    text has no words. Repeated rows are reported each; a null doc_id stays null; other columns
    are not read; an empty table gives an empty result.

    One scan of the texts, without a shuffle, leaves the row's counts and the pairs that occur in
    templates; what is shuffled and joined is those hits, by row.
    """
    spark = documents.sparkSession
    rows = template_pairs(BASE_PHRASES if base is None else base, NOTICES if notices is None else notices)
    templates = _pairs_table(spark, rows)
    hashes = [r[0] for r in templates.select("hash").distinct().collect()]  # as many as the templates have

    split = documents.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    pair = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1))
    positions = F.when(F.size("words") > 1, F.sequence(F.lit(0), F.size("words") - 2))
    if len(hashes) <= LISTED_PAIRS:
        positions = F.filter(positions, lambda i: pair(i).isin(hashes))
    found = F.transform(
        positions, lambda i: F.struct(i.alias("at"), F.get("words", i).alias("w1"), F.get("words", i + 1).alias("w2"))
    )
    scanned = split.select("doc_id", F.size("words").cast("long").alias("n_words"), found.alias("found"))
    scanned = stored(scanned.withColumn("row_id", F.monotonically_increasing_id()), "licenses")

    hits = scanned.select("row_id", F.explode("found").alias("hit")).select("row_id", "hit.*")
    hits = hits.withColumn("hash", F.xxhash64("w1", "w2")).join(templates, "hash").where("w1 = t1 and w2 = t2")
    votes = (
        hits.withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy("row_id", "template", "is_base", "label", "pairs", "keys", "diagonal")
        .agg(F.collect_set("place").alias("places"))  # at most as many as the template has pairs
    )
    near = Window.partitionBy("row_id", "template").orderBy("diagonal").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    spots = F.transform("places", lambda p: p + F.col("diagonal"))
    united = lambda c: F.array_distinct(F.flatten(F.collect_list(c).over(near)))
    votes = votes.withColumn("spots", spots).withColumns({"near_places": united("places"), "near_spots": united("spots")})
    together = F.when(F.col("is_base"), F.size("places")).otherwise(F.least(F.size("near_places"), F.size("near_spots")))
    covered = votes.withColumn("share", together / F.col("pairs"))
    missed = F.array_except(F.sequence(F.lit(0), F.col("pairs") - 1), "near_places")
    one_gap = (F.size(missed) <= GAP) & (F.array_max(missed) - F.array_min(missed) < GAP) & ~F.arrays_overlap(missed, "keys")
    one_gap &= (F.col("pairs") >= GAP_FROM) & (F.size("near_spots") >= F.size("near_places"))
    place = F.col("is_base") & (F.col("share") == 1.0)
    label = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    by_row = covered.groupBy("row_id").agg(
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"),
        label(place).alias("base_labels"),
        label(place | (~F.col("is_base") & ((F.col("share") >= COVERAGE) | one_gap))).alias("labels"),
        F.max(F.when(place | ~F.col("is_base"), F.col("share"))).alias("score"),
    )
    none = lambda c, value: F.coalesce(F.col(c), F.lit(value)).alias(c)
    return (
        scanned.select("row_id", "doc_id", "n_words")
        .join(by_row, "row_id", "left")
        .select(
            "doc_id", "n_words", none("n_base", 0), "first_word", "last_word", none("base_labels", ""), none("labels", ""), none("score", 0.0)
        )
    )


def oracle() -> str:
    """The same scan as DuckDB SQL, by equality of the words themselves.

    Templates are split by SQL; places and spots are sets over the neighbouring diagonals, and a
    gap is judged by the places that are missing.
    """
    templates = [(k, str(k < len(BASE_PHRASES)).lower(), label, text) for k, (text, label) in enumerate([*BASE_PHRASES.items(), *NOTICES.items()])]
    values = ", ".join(f"({k}, {b}, '{label}', '{text}')" for k, b, label, text in templates)
    key_pairs = ", ".join(f"'{p}'" for p in sorted(KEY_PAIRS))
    return rf"""
WITH phrase(template, is_base, label, words) AS (
  SELECT template, is_base, label, string_split(text, ' ') FROM (VALUES {values}) AS v(template, is_base, label, text)
),
t AS (
  SELECT template, is_base, label, len(words) - 1 AS pairs, unnest(range(len(words) - 1)) AS place,
    unnest(words[:len(words) - 1]) AS t1, unnest(words[2:]) AS t2 FROM phrase
),
key_places AS (SELECT template, list(place) AS keys FROM t WHERE t1 || ' ' || t2 IN ({key_pairs}) GROUP BY template),
split AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
),
pair AS (
  SELECT row_id, unnest(w[:len(w) - 1]) AS w1, unnest(w[2:]) AS w2, unnest(range(len(w) - 1)) AS spot
  FROM split WHERE len(w) > 1
),
votes AS (
  SELECT row_id, template, is_base, label, pairs, spot - place AS diagonal, list(DISTINCT place) AS places
  FROM pair JOIN t ON w1 = t1 AND w2 = t2 GROUP BY ALL
),
united AS (
  SELECT *, list_distinct(flatten(list(places) OVER near)) AS near_places,
    list_distinct(flatten(list(list_transform(places, lambda p: p + diagonal)) OVER near)) AS near_spots
  FROM votes WINDOW near AS (
    PARTITION BY row_id, template ORDER BY diagonal RANGE BETWEEN {NEIGHBOURS} PRECEDING AND {NEIGHBOURS} FOLLOWING)
),
covered AS (
  SELECT united.*, coalesce(keys, []) AS keys,
    (CASE WHEN is_base THEN len(places) ELSE least(len(near_places), len(near_spots)) END)::DOUBLE / pairs AS share,
    list_filter(range(pairs), lambda p: NOT list_contains(near_places, p)) AS missed
  FROM united LEFT JOIN key_places USING (template)
),
marked AS (
  SELECT *, is_base AND share = 1 AS place, NOT is_base AND (share >= {COVERAGE} OR (
    pairs >= {GAP_FROM} AND len(near_spots) >= len(near_places) AND len(missed) <= {GAP}
    AND coalesce(list_max(missed) - list_min(missed), 0) < {GAP} AND NOT list_has_any(missed, keys))) AS notice
  FROM covered
),
by_row AS (
  SELECT row_id, count(*) FILTER (place) AS n_base, min(diagonal) FILTER (place) AS first_word,
    max(diagonal) FILTER (place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place OR notice) AS labels,
    max(share) FILTER (place OR NOT is_base) AS score
  FROM marked GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN by_row USING (row_id)
"""
