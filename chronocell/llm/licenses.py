"""License scans by diagonal voting.

Hashes of all rolling word k-grams of every text are joined to the positions of template k-grams (k is
a template's own: as long as the phrase, at most GRAM). Matches are counted by offset diagonal (text
position minus template position), neighbouring diagonals of one template merge to a span (words put in
or left out shift the diagonal), and a span counts when enough of the template's grams are verified,
word by word, inside it; each gram of the template counts once. A phrase template needs all its grams on one
diagonal: a place.

The template table is a fixed list of a few hundred rows, so it is broadcast. Each text yields one row for itself beside
its matches and leaves the scan once; texts are never shuffled. Rows are told apart by id and digest of the text, which a
recomputed partition gives again; rows alike in both are counted, and the result is repeated so often.

Defined results: a null or empty text has no words, no labels, null places and score 0; repeated rows
each give a row; an empty table an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Base phrases and labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Opening words of public licence texts, with our labels.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc", "this work is licensed under a creative commons attribution"),
)
GRAM = 4
NEIGHBOUR = 3  # diagonals this close are one alignment
ENOUGH = 0.5  # share of a template's grams that a span needs
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SELF = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def templates() -> list[tuple[int, str, bool, list[str], int]]:
    """(id, label, is_phrase, words, k)"""
    both = [(label, True, text.split()) for text, label in PHRASES.items()] + [(label, False, text.split()) for label, text in TEMPLATES]
    return [(i, label, base, words, min(GRAM, len(words))) for i, (label, base, words) in enumerate(both)]


def _grams() -> list[tuple[int, str, bool, int, int, int, str]]:
    """(template, label, is_phrase, k, grams of the template, position, gram)"""
    return [(i, label, base, k, len(words) - k + 1, p, " ".join(words[p : p + k])) for i, label, base, words, k in templates() for p in range(len(words) - k + 1)]


def _gram_table(spark: SparkSession) -> DataFrame:
    t = spark.createDataFrame(_grams(), "tid int, label string, base boolean, k int, grams int, tpos int, gram string")
    parts = F.split("gram", " ")
    t = t.withColumn("h", F.when(F.col("k") == 2, _gram_hash(parts, 2)).when(F.col("k") == 3, _gram_hash(parts, 3)).otherwise(_gram_hash(parts, GRAM)))
    own = spark.createDataFrame([(SELF, "", False, 0, 0, 0, "", 0)], t.schema)  # meets each text's own row
    return t.unionByName(own)


def _gram_hash(words: Column, k: int) -> Column:
    h = F.xxhash64(F.element_at(words, 1))
    for i in range(2, k + 1):
        h = F.xxhash64(h, F.xxhash64(F.element_at(words, i)))
    return h


def words_of(text: Column) -> Column:
    """Words of A-Z lower-cased text."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), lambda w: w != "")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    ks = sorted({t[4] for t in templates()})
    assert ks == [2, 3, 4]
    d = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("key"), words_of(F.col("text")).alias("words"))
    n = F.size("words")
    d = d.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    # rolling: the k-gram hash at a place comes from the (k-1)-gram hash there and the next word's hash
    roll = lambda short, k: F.zip_with(F.slice(short, 1, F.greatest(F.lit(0), n - (k - 1))), F.slice("h1", k, F.greatest(F.lit(0), n - (k - 1))), lambda a, b: F.xxhash64(a, b))
    d = d.withColumn("h2", roll("h1", 2)).withColumn("h3", roll("h2", 3)).withColumn("h4", roll("h3", 4))
    # one generated column: own row, then 2-, 3- and 4-grams
    d = d.select("doc_id", "key", "words", n.alias("n"), F.posexplode(F.concat(F.array(F.lit(0).cast("long")), "h2", "h3", "h4")).alias("at", "h"))
    m = d.join(F.broadcast(_gram_table(docs.sparkSession)), "h")
    n2, n3 = F.greatest(F.lit(0), F.col("n") - 1), F.greatest(F.lit(0), F.col("n") - 2)
    pos = F.col("at") - 1 - F.when(F.col("k") == 3, n2).when(F.col("k") == 4, n2 + n3).otherwise(F.lit(0))
    own = (F.col("tid") == SELF) & (F.col("at") == 0)
    gram = (F.col("tid") != SELF) & (F.col("at") > 0) & (pos >= 0) & (pos <= F.col("n") - F.col("k"))
    same = F.concat_ws(" ", F.slice("words", F.greatest(pos, F.lit(0)) + 1, F.greatest(F.col("k"), F.lit(1)))) == F.col("gram")
    m = m.withColumn("pos", pos).where(own | (gram & same))
    m = m.select("doc_id", "key", "n", "tid", "label", "base", "grams", "tpos", F.when(F.col("tid") == SELF, 0).otherwise(F.col("pos") - F.col("tpos")).alias("diag"))

    rows = ["doc_id", "key", "n", "tid", "label", "base", "grams"]
    lines = m.groupBy(*rows, "diag").agg(F.collect_set("tpos").alias("at"), F.count(F.lit(1)).alias("times"))
    by = Window.partitionBy("doc_id", "key", "tid").orderBy("diag")
    apart = F.col("base") | (F.col("diag") - F.lag("diag").over(by) > NEIGHBOUR)
    lines = lines.withColumn("span", F.sum(F.when(apart, 1).otherwise(0)).over(by))
    spans = lines.groupBy(*rows, "span").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"), F.min("diag").alias("start"), F.max("times").alias("times"))
    own = F.col("tid") == SELF
    place = F.col("base") & ~own & (F.col("votes") == F.col("grams"))
    share = F.when(own, 0.0).when(F.col("base"), F.when(place, 1.0).otherwise(0.0)).otherwise(F.col("votes") / F.col("grams"))
    spans = spans.withColumn("share", share).withColumn("place", place)
    found = F.col("place") | (~own & ~F.col("base") & (F.col("share") >= ENOUGH))
    out = spans.groupBy("doc_id", "key").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if("place").alias("n_base"),
        F.min(F.when(F.col("place"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("place"), F.col("start"))).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("place"), F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(found, F.col("label"))))).alias("labels"),
        F.max("share").alias("score"),
        F.max(F.when(own, F.col("times"))).alias("times"),
    )
    return out.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("key", "times", "i")


def _oracle() -> str:
    values = ", ".join(f"({i}, '{label}', {base}, {k}, {g}, {p}, '{gram}')" for i, label, base, k, g, p, gram in _grams())
    return rf"""
WITH t(tid, label, base, k, grams, tpos, gram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT rid, w, unnest(range(len(w))) AS pos FROM d WHERE len(w) >= 2),
g AS (SELECT rid, pos, k, array_to_string(w[pos + 1 : pos + k], ' ') AS gram FROM p, (VALUES (2), (3), (4)) ks(k) WHERE pos + k <= len(w)),
m AS (SELECT rid, tid, label, base, grams, tpos, pos - tpos AS diag FROM g JOIN t USING (k, gram)),
s AS (SELECT *, sum(CASE WHEN base OR gap > {NEIGHBOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY rid, tid ORDER BY diag) AS span
      FROM (SELECT *, diag - lag(diag) OVER (PARTITION BY rid, tid ORDER BY diag) AS gap FROM (SELECT DISTINCT rid, tid, base, diag FROM m))),
e AS (SELECT rid, tid, label, m.base, grams, span, count(DISTINCT tpos) AS votes, min(diag) AS start FROM m JOIN s USING (rid, tid, diag) GROUP BY ALL),
f AS (SELECT *, base AND votes = grams AS place, CASE WHEN base THEN (CASE WHEN votes = grams THEN 1.0 ELSE 0.0 END) ELSE votes::DOUBLE / grams END AS share FROM e)
SELECT any_value(doc_id) AS doc_id, any_value(len(w))::BIGINT AS n_words, (count(*) FILTER (place))::BIGINT AS n_base,
       (min(start) FILTER (place))::BIGINT AS first_word, (max(start) FILTER (place))::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place OR (NOT base AND share >= {ENOUGH})), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (rid) GROUP BY rid
"""


ORACLE = _oracle()
