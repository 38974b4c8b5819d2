"""License scan by diagonal voting.

Every run of `K` words of every text is hashed and joined with the places of the same run in the license templates. A
shared run at word p of a text and word t of a template votes for the diagonal p - t: a copy of the template, whole or
in part, puts all its votes on one diagonal, and each inserted or dropped word moves it by one. Votes are added up by
diagonal, neighbouring diagonals (at most `SLACK` apart) are merged, and the span is verified: the share of the
template's words that lie in a shared run must reach the template's coverage. The words of a run are compared
themselves when the hashes meet, so no hash can mislead.

Base phrases are templates without slack that must be covered whole. Templates of one family (versions of a license)
differ in a word or two; of spans of a family that share words of a text, only those with the best coverage count, and
spans at other places keep their labels.

Bounds: the templates are constants, hence their broadcast; a text is never shuffled, only its votes, which are added
up per task first. Edge cases: a null or empty text has no words and no labels (empty strings, score 0, null places).
Rows are told apart by id and text, so repeated rows get equal results, each its own; a null id is an id like any
other. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.operators.ordered import join_on

K = 3
SLACK = 8
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Fixed values: (label, family, least coverage, words) of public license texts and notices.
TEMPLATES = [
    ("gpl-2", "gpl", 0.9, "licensed under the gnu general public license version 2"),
    ("gpl-3", "gpl", 0.9, "licensed under the gnu general public license version 3"),
    (
        "gpl-2", "gpl", 0.8,
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation either version 2 of the license or at your option any later version",
    ),
    (
        "gpl-3", "gpl", 0.8,
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "mpl-2", "mpl", 0.8,
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can "
        "obtain one at https mozilla org mpl 2 0",
    ),
    ("cc-by", "cc", 0.9, "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "cc", 0.9, "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "cc", 0.9, "licensed under a creative commons attribution noncommercial 4 0 international license"),
    (
        "apache-2", "apache", 0.8,
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    (
        "mit", "mit", 0.8,
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in "
        "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
        "the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the software",
    ),
    (
        "isc", "isc", 0.8,
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
        "notice and this permission notice appear in all copies",
    ),
    (
        "bsd", "bsd", 0.8,
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary "
        "form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution",
    ),
    (
        "unlicense", "unlicense", 0.8,
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
    ),
    ("all-rights-reserved", "reserved", 1.0, "all rights reserved"),
]


def _templates() -> list[tuple[int, str, str, bool, float, list[str]]]:
    """(number, label, family, base, coverage, words); a base phrase is a family of its own."""
    base = [(label, f"base {label}", True, 1.0, words) for words, label in BASE]
    rest = [(label, family, False, least, words) for label, family, least, words in TEMPLATES]
    return [(i, label, family, fixed, least, words.split()) for i, (label, family, fixed, least, words) in enumerate(base + rest)]


def _runs(spark) -> DataFrame:
    """One row per run of words of a template."""
    rows = [
        (i, label, family, base, least, len(words), t, " ".join(words[t : t + K]))
        for i, label, family, base, least, words in _templates()
        for t in range(len(words) - K + 1)
    ]
    frame = spark.createDataFrame(rows, "template int, label string, family string, base boolean, least double, size int, place int, run string")
    parts = F.split("run", " ")
    return frame.withColumn("run_hash", F.xxhash64(*[parts[i] for i in range(K)]))


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, template.., at, place): every run of a text that occurs in a template."""
    words = F.filter(F.split("text", BREAKS), lambda w: w != "")
    split = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("words")).filter(F.size("words") >= K)
    split = split.withColumn("plain", F.transform("words", F.lower))
    starts = F.sequence(F.lit(0), F.size("plain") - K)
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("plain", i + k) for k in range(K)]))
    placed = split.select("doc_id", "text_hash", "words", F.posexplode(runs).alias("at", "run_hash"))
    met = placed.join(F.broadcast(_runs(docs.sparkSession)), "run_hash")
    # lower() above also folds letters beyond A-Z; the words themselves decide
    same = F.translate(F.concat_ws(" ", F.slice("words", F.col("at") + 1, K)), UPPER, LOWER) == F.col("run")
    return met.filter(same).select("doc_id", "text_hash", "template", "label", "family", "base", "least", "size", "at", "place")


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans: doc_id, text_hash, label, family, base, coverage, first and last word of each."""
    key = ["doc_id", "text_hash", "template", "label", "family", "base", "least", "size"]
    diagonals = votes(docs).groupBy(*key, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"))
    along = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("base"), 0).otherwise(SLACK)
    merged = (
        diagonals.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0)))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy(*key, "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
            F.max(F.col("diagonal") + F.array_max("places") + K - 1).alias("last_word"),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda t: F.sequence(t, t + K - 1)))))
    span = F.struct((-F.col("coverage")).alias("order"), "first_word", "last_word", "label", "coverage")
    verified = (
        merged.withColumn("coverage", covered / F.col("size"))
        .filter("coverage >= least")
        .groupBy("doc_id", "text_hash", "family", "base")
        .agg(F.array_sort(F.collect_list(span)).alias("all"), F.min("coverage").alias("low"), F.max("coverage").alias("high"))
    )

    def beaten(kept, s):
        return F.exists(kept, lambda x: (x["coverage"] > s["coverage"]) & (x["first_word"] <= s["last_word"]) & (s["first_word"] <= x["last_word"]))

    # best coverage first, so only spans that stay can beat others
    best = F.aggregate("all", F.slice("all", 1, 0), lambda kept, s: F.when(beaten(kept, s), kept).otherwise(F.concat(kept, F.array(s))))
    kept = verified.select("doc_id", "text_hash", "family", "base", F.explode(F.when(F.col("low") == F.col("high"), F.col("all")).otherwise(best)).alias("s"))
    return kept.select("doc_id", "text_hash", "s.label", "family", "base", "s.coverage", "s.first_word", "s.last_word")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its labels."""
    source = pick(docs, "doc_id", "text")
    base = F.col("base")
    found = spans(source).groupBy("doc_id", "text_hash").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    n_words = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    rows = source.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(n_words, F.lit(0)).cast("long").alias("n_words"))
    return join_on(rows, found, ["doc_id", "text_hash"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _check() -> str:
    rows = ", ".join(f"({i}, '{label}', '{family}', {base}, {least}::DOUBLE, '{' '.join(words)}')" for i, label, family, base, least, words in _templates())
    return rf"""
WITH template AS (
    SELECT *, string_split(words, ' ') AS list FROM (VALUES {rows}) AS v(template, label, family, base, least, words)
), run AS (
    SELECT template, label, family, base, least, len(list) AS size, place, array_to_string(list[place + 1:place + {K}], ' ') AS run
    FROM template, unnest(range(len(list) - {K - 1})) AS u(place)
), doc AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM documents
), gram AS (
    SELECT row_no, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] AS run FROM doc, unnest(range(len(w) - {K - 1})) AS u(pos)
), diagonal AS (
    SELECT row_no, template, label, family, base, least, size, pos - place AS diagonal, list(DISTINCT place) AS places
    FROM gram JOIN run USING (run) GROUP BY ALL
), cut AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER a > CASE WHEN base THEN 0 ELSE {SLACK} END THEN 1 ELSE 0 END AS apart
    FROM diagonal WINDOW a AS (PARTITION BY row_no, template ORDER BY diagonal)
), numbered AS (
    SELECT *, sum(apart) OVER (PARTITION BY row_no, template ORDER BY diagonal) AS span FROM cut
), covered AS (
    SELECT row_no, template, span, count(DISTINCT place + k) AS n
    FROM (SELECT row_no, template, span, unnest(places) AS place FROM numbered), (SELECT unnest(range({K})) AS k) GROUP BY ALL
), merged AS (
    SELECT row_no, template, label, family, base, least, size, span, min(diagonal + list_min(places)) AS first_word,
        max(diagonal + list_max(places)) + {K - 1} AS last_word
    FROM numbered GROUP BY ALL
), verified AS (
    SELECT m.*, c.n / m.size AS coverage FROM merged m JOIN covered c USING (row_no, template, span) WHERE c.n / m.size >= m.least
), ordered AS (
    SELECT row_no, family, list([{{'coverage': coverage, 'first_word': first_word, 'last_word': last_word, 'label': label, 'base': base}}] ORDER BY coverage DESC) AS spans
    FROM verified GROUP BY ALL
), best AS (
    -- best coverage first: a span goes if one that stays covers its template better and shares a word with it
    SELECT row_no, unnest(list_reduce(spans, lambda kept, s: CASE WHEN len(list_filter(kept, lambda x: x.coverage > s[1].coverage
        AND x.first_word <= s[1].last_word AND s[1].first_word <= x.last_word)) > 0 THEN kept ELSE list_concat(kept, s) END), max_depth := 2)
    FROM ordered
), found AS (
    SELECT row_no, count(*) FILTER (base) AS n_base, min(first_word) FILTER (base) AS first_word, max(first_word) FILTER (base) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
        max(coverage) AS score
    FROM best GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN found USING (row_no)
"""


CHECK = _check()
