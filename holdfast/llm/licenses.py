"""License scans by diagonal voting, in DataFrame functions alone.

Every rolling three-word gram of every text is joined by its hash to the places where license templates
have it. A hit votes for the diagonal (word position minus template position) it lies on; neighbouring
diagonals merge, which lets words be missing or added, and the merged spans are verified by the share of
the template they cover. The templates are a fixed list of a few hundred grams, so their side is broadcast;
texts are never shuffled, only hits and one row per document.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import ALNUM_WORD, LOWER, UPPER, lowered

GRAM = 3
# Words that diagonals of one span may be apart.
DRIFT = 3
# Longest span verified, as a multiple of the template.
STRETCH = 1.5

# Phrases and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Wording of common license notices; label, least share of the template's grams, text.
NOTICES = [
    ("mit", 0.7, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", 0.7, "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", 0.7, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3", 0.7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", 0.95, "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2", 0.7, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", 0.7, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", 0.8, "This is free and unencumbered software released into the public domain"),
    ("cc0", 0.8, "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", 1.0, "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", 1.0, "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", 1.0, "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("gpl-3", 1.0, "GNU General Public License, version 3"),
    ("mit", 1.0, "the MIT License"),
    ("apache-2", 1.0, "under the Apache License Version 2.0"),
    ("cc-by-nc", 1.0, "under CC BY-NC 4.0"),
]


def template_rows() -> list[tuple]:
    """(template, label, is_base, least, n_grams, place, gram) for every gram of every template."""
    fold = str.maketrans(UPPER, LOWER)
    rows = []
    for n, (label, least, base, text) in enumerate([(b, 1.0, True, a) for a, b in PHRASES] + [(a, b, False, c) for a, b, c in NOTICES]):
        words = re.findall(ALNUM_WORD, text.translate(fold))
        total = len(words) - GRAM + 1
        rows += [(n, label, base, least, total, i, " ".join(words[i : i + GRAM])) for i in range(total)]
    return rows


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_rows(), "template int, label string, is_base boolean, least double, n_grams int, place int, template_gram string")


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans: row, doc_id, n_words, label, is_base, first_word, end_word, cover, and one row without
    label for each document.

    `row` numbers the input rows, so repeated rows keep results of their own. Null texts are empty.
    """
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.regexp_extract_all(lowered(F.col("text")), F.lit(ALNUM_WORD), F.lit(0)).alias("w")
    )
    grams = F.expr(f"transform(sequence(1, size(w) - {GRAM - 1}), i -> concat_ws(' ', {', '.join(f'w[i + {j - 1}]' for j in range(GRAM))}))")
    rows = words.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.when(F.size("w") >= GRAM, grams).alias("grams"))
    rows = rows.select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("position", "gram"))
    known = F.broadcast(templates(docs.sparkSession))  # a fixed list of a few hundred rows
    same = (F.xxhash64("gram") == F.xxhash64("template_gram")) & (F.col("gram") == F.col("template_gram"))
    hits = rows.join(known, same, "left").where("template IS NOT NULL OR position IS NULL OR position = 0")
    by = ["row", "doc_id", "n_words", "template", "label", "is_base", "least", "n_grams"]
    votes = hits.groupBy(*by, F.expr("position - place").alias("diagonal"))
    votes = votes.agg(F.count("template").alias("votes"), F.min("position").alias("low"), F.max("position").alias("high"))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(near) > F.when(F.expr("is_base OR n_grams = 1"), 0).otherwise(DRIFT)
    merged = votes.withColumn("span", F.sum(F.when(apart, 1).otherwise(0)).over(near)).groupBy(*by, "span")
    merged = merged.agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"))
    cover = F.least(F.col("votes") / F.col("n_grams"), F.lit(1.0))
    found = merged.select("row", "doc_id", "n_words", "label", "is_base", "low", (F.col("high") + GRAM).alias("end"), cover.alias("cover"), "least", "n_grams")
    verified = F.expr(f"label IS NOT NULL AND cover >= least AND end - low <= {STRETCH} * (n_grams + {GRAM - 1})")
    shown = lambda name, alias: F.when(verified, F.col(name)).alias(alias)
    return found.select(
        "row", "doc_id", "n_words", shown("label", "label"), shown("is_base", "is_base"), shown("low", "first_word"), shown("end", "end_word"), shown("cover", "cover")
    )


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels and the best cover as score.

    Labels are distinct, sorted and joined by commas; a text without any has empty labels and score 0.
    """
    base = lambda e: f"CASE WHEN is_base THEN {e} END"
    joined = lambda e: f"array_join(array_sort(collect_set({e})), ',')"
    return spans(docs).groupBy("row", "doc_id", "n_words").agg(
        F.expr(f"count({base('1')})").alias("n_base"),
        F.expr(f"min({base('CAST(first_word AS long)')})").alias("first_word"),
        F.expr(f"max({base('CAST(first_word AS long)')})").alias("last_word"),
        F.expr(joined(base("label"))).alias("base_labels"),
        F.expr(joined("label")).alias("labels"),
        F.expr("round(coalesce(max(cover), 0.0D), 6)").alias("score"),
        F.expr("count(label)").alias("n_spans"),
    ).drop("row")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    """The same result as DuckDB SQL."""
    listed = ", ".join(f"({t}, {_sql_text(a)}, {b}, {c}::DOUBLE, {n}, {i}, {_sql_text(g)})" for t, a, b, c, n, i, g in template_rows())
    return f"""
WITH templates(template, label, is_base, least, n_grams, place, gram) AS (VALUES {listed}),
words AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM_WORD}') AS w FROM documents),
grams AS (SELECT row, i AS position, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram FROM words, unnest(range(len(w) - {GRAM - 1})) AS u(i) WHERE len(w) >= {GRAM}),
votes AS (
  SELECT row, template, label, is_base, least, n_grams, position - place AS diagonal, count(*) AS votes, min(position) AS low, max(position) AS high
  FROM grams JOIN templates USING (gram) GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER near > CASE WHEN is_base OR n_grams = 1 THEN 0 ELSE {DRIFT} END THEN 1 ELSE 0 END AS apart
  FROM votes WINDOW near AS (PARTITION BY row, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM marked),
merged AS (
  SELECT row, template, label, is_base, least, n_grams, span, least(sum(votes) / n_grams, 1.0) AS cover, min(low) AS low, max(high) + {GRAM} AS stop
  FROM numbered GROUP BY row, template, label, is_base, least, n_grams, span),
verified AS (SELECT * FROM merged WHERE cover >= least AND stop - low <= {STRETCH} * (n_grams + {GRAM - 1}))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(v.row) FILTER (is_base) AS n_base, min(low) FILTER (is_base) AS first_word, max(low) FILTER (is_base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
  round(coalesce(max(cover), 0.0), 6) AS score, count(label) AS n_spans
FROM words LEFT JOIN verified v USING (row) GROUP BY row, doc_id, len(w)
"""
