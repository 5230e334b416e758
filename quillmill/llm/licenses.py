"""Licence scans by diagonal voting, in DataFrame functions only.

Method: the rolling word 2-grams of every whole text are hashed and joined, all of them, to the 2-grams of the templates
and their positions. A hit votes for the diagonal ``position in the text - position in the template``. Votes are summed
by diagonal. For a base phrase all of its 2-grams must stand on one diagonal: that is a place where the phrase's words
are consecutive. For a licence text, a diagonal is merged with the neighbours that follow it within ``DRIFT`` times the
template's length, since words that were put in shift the rest. Such a span of diagonals bounds its words as well: they
lie within (1 + ``DRIFT``) times the template's length. It is verified if at least ``COVERAGE`` of the template's 2-grams
voted in it. Every diagonal begins a span, so votes from other parts of a text never spoil one.

Which 2-grams voted is kept as bits of a long, so merging spans is a sliding OR over diagonals.

Labels are those of base phrases found and of licence texts verified. The score is 1 with a base phrase, else the best
coverage of a licence text. The templates, some hundred 2-grams, are constants, so broadcasting them is bounded.

Words are runs of anything but ASCII characters other than digits and letters, in lower case. (Case is folded by
``lower``, which also folds letters beyond ASCII; that changes neither the words' number nor, as no base phrase has a k,
any base place.)

Cases: a null or empty text has no words, no places, null first and last word, empty labels and score 0. Texts are
scanned whole. Rows with one id but different texts are told apart by the text's hash; repeated rows get the same
result each. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import saved

DRIFT, COVERAGE = 0.5, 0.6
#: So many 2-grams of a template share a long.
BITS = 62
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices of public licences, as their publishers word them, and their labels.
NOTICES = (
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files the software to deal in the software without restriction including without limitation the rights to use copy modify"
        " merge publish distribute sublicense and or sell copies of the software",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0",
        "apache",
    ),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as"
        " is basis without warranties or conditions of any kind either express or implied",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
        " as published by the free software foundation",
        "gpl",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public"
        " license as published by the free software foundation",
        "lgpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
)


def template_rows(base=BASE, notices=NOTICES) -> list[tuple[int, str, bool, int, int, str, str]]:
    """(template, label, base, 2-grams in it, position, first word, second word) for each 2-gram of each template."""
    rows = []
    for nr, (text, label) in enumerate([*base, *notices]):
        words = text.split()
        rows += [(nr, label, nr < len(base), len(words) - 1, k, *words[k : k + 2]) for k in range(len(words) - 1)]
    return rows


def reach(grams: int) -> int:
    """How far the diagonals of a template with so many 2-grams may drift."""
    return math.floor((grams + 1) * DRIFT)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    rows_ = template_rows(base, notices)
    templates = spark.createDataFrame(rows_, "template int, label string, base boolean, grams int, place int, w1 string, w2 string")
    templates = templates.select("template", "label", "base", "grams", "place", F.xxhash64("w1", "w2").alias("gram"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_qm_id"),
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.octet_length(text).alias("n")).alias("key"),
        F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("words"),
    )
    # a first element without a 2-gram stands for the row itself, so that one pass over the texts gives rows and hits
    grams = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    rows = rows.select("_qm_id", "key", F.size("words").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(None).cast("long")), grams)).alias("at", "gram"))
    hits = rows.join(F.broadcast(templates), "gram", "left").filter("at = 0 or template is not null").drop("gram")
    hits = saved(hits, "license-hits")

    votes = hits.filter("at > 0").withColumn("diagonal", F.col("at") - 1 - F.col("place"))
    parts = [f"m{i}" for i in range(max(r[3] for r in rows_) // BITS + 1)]
    bit = lambda i: F.expr(f"bit_or(if(place div {BITS} = {i}, shiftleft(1L, place % {BITS}), 0L))")
    on = votes.groupBy("key", "template", "label", "base", "grams", "diagonal").agg(*[bit(i).alias(m) for i, m in enumerate(parts)])
    count = lambda columns: reduce(add, [F.bit_count(c) for c in columns])
    found = on.filter(F.col("base") & (count(map(F.col, parts)) == F.col("grams"))).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"), F.collect_set("label").alias("base_set")
    )
    # a template's reach is part of its rows, a window's frame is not: one sliding OR for each reach there is
    by_diagonal = W.partitionBy("key", "template").orderBy("diagonal")
    reaches = sorted({reach(r[3]) for r in rows_ if not r[2]})
    merged = lambda r: count([F.bit_or(m).over(by_diagonal.rangeBetween(0, r)) for m in parts])
    spans = on.filter("not base").withColumn("reach", F.floor((F.col("grams") + 1) * DRIFT)).withColumn(
        "coverage", F.coalesce(*[F.when(F.col("reach") == r, merged(r)) for r in reaches]) / F.col("grams") if reaches else F.lit(0.0)
    )
    good = F.col("coverage") >= COVERAGE
    spans = spans.groupBy("key").agg(F.max("coverage").alias("coverage"), F.collect_set(F.when(good, F.col("label"))).alias("own_set"))

    none = F.array().cast("array<string>")
    both = found.join(spans, "key", "full")
    out = hits.filter("at = 0").select("_qm_id", "key", "n_words").join(both, "key", "left")
    return out.select(
        F.col("_qm_id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.coalesce("base_set", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base_set", none), F.coalesce("own_set", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_templates() -> str:
    return ",\n".join(f"({t}, '{label}', {base}, {grams}, {place}, '{a} {b}')" for t, label, base, grams, place, a, b in template_rows())


OP7_SQL = rf"""
WITH t(template, label, base, grams, place, gram) AS (VALUES {_sql_templates()}),
d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents
), g AS (
  SELECT row, i - 1 AS word, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT row, w, unnest(range(1, len(w))) AS i FROM d)
), v AS (
  SELECT DISTINCT row, template, label, base, grams, place, word, word - place AS diagonal FROM g JOIN t USING (gram)
), b AS (
  SELECT row, label, diagonal FROM v WHERE base GROUP BY row, template, label, grams, diagonal HAVING count(DISTINCT place) = grams
), a AS (
  SELECT DISTINCT row, template, label, grams, diagonal FROM v WHERE NOT base
), c AS (
  SELECT a.row, a.label, count(DISTINCT v.place)::DOUBLE / a.grams AS coverage
  FROM a JOIN v ON v.row = a.row AND v.template = a.template AND v.diagonal BETWEEN a.diagonal AND a.diagonal + floor((a.grams + 1) * {DRIFT})
  GROUP BY a.row, a.template, a.label, a.grams, a.diagonal
), l AS (
  SELECT row, label FROM b UNION SELECT row, label FROM c WHERE coverage >= {COVERAGE}
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(x.n, 0)::BIGINT AS n_base, x.lo::BIGINT AS first_word, x.hi::BIGINT AS last_word,
  coalesce(x.labels, '') AS base_labels, coalesce(y.labels, '') AS labels, CASE WHEN x.n > 0 THEN 1.0 ELSE coalesce(z.coverage, 0.0) END::DOUBLE AS score
FROM d
LEFT JOIN (SELECT row, count(*) AS n, min(diagonal) AS lo, max(diagonal) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY row) x USING (row)
LEFT JOIN (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM l GROUP BY row) y USING (row)
LEFT JOIN (SELECT row, max(coverage) AS coverage FROM c GROUP BY row) z USING (row)
"""
