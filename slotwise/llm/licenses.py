"""Operator 3: licence scan and directory inheritance (DataFrame functions only).

1. The units are the lines that hold a template word, and every stretch of up to
   ``WINDOW`` lines from one such line to another, so a notice wrapped over lines is one
   vector. A unit is a sparse TF-IDF vector over the templates' words: a word's weight
   is ``1 - ln(share of the files that hold it)``, the share taken as ``RARE`` at least.
   Words outside the templates weigh as much as the rarest and lengthen the unit's vector, so
   a phrase buried in other words scores low. Weights depend on shares alone: a
   table a thousand times as large gives the same verdicts. Stop words are left out on both sides.
2. A unit's licence is the template of the highest cosine, if that reaches
   ``threshold``; an identifier line has to hold every part of the identifier. A file's own
   licence is that of its best unit.
3. A file is a licence file if its name says so, or if its licensed lines, or its longest
   licensed unit, hold at least ``file_share`` of its words. It licenses its directory.
4. A file without a licence of its own takes that of its nearest ancestor
   directory: directories are joined to licensed directories on every prefix of their path,
   once each, and files to their directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import quoted, stored

# Notice texts of common licences, as their publishers word them.
_GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: " + _GNU.format("Affero General Public License", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication"),
    ("GPL-2.0", "This program is free software; " + _GNU.format("General Public License", "2")),
    ("GPL-3.0", "This program is free software: " + _GNU.format("General Public License", "3")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "This library is free software; " + _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", "This library is free software: " + _GNU.format("Lesser General Public License", "3")),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
# Licences that an identifier line may name.
IDENTIFIED = (
    "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense"
).split()
IDENTIFIER = "SPDX-License-Identifier: {}"
# Words that carry no licence meaning.
STOP_WORDS = (
    "a", "and", "any", "are", "as", "at", "be", "by", "can", "for", "in", "is", "it", "its", "may", "of", "on", "or", "that", "the", "this", "to",
    "under", "with", "you", "your",
)
#: Lines that a wrapped notice spans at most, and the least share of files that a word is taken to be in.
WINDOW, RARE = 4, 0.001
SPLIT = "[^a-z0-9]+"
LICENSE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"


def template_terms() -> list[tuple[int, str, str, int, int]]:
    """``(template, licence, term, tf, key)`` of all templates; a unit must hold the terms with ``key`` 1."""
    import re

    def words_of(text: str) -> list[str]:
        return [w for w in re.split(SPLIT, text.lower()) if w and w not in STOP_WORDS]

    rows = []
    for i, (name, text) in enumerate([*TEMPLATES, *((name, IDENTIFIER.format(name)) for name in IDENTIFIED)]):
        words, keys = words_of(text), words_of(name) if i >= len(TEMPLATES) else []
        rows += [(i, name, w, words.count(w), int(w in keys)) for w in sorted(set(words))]
    return rows


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), SPLIT), lambda w: w != "")


def license_scan(
    files: DataFrame, path_col: str = "path", text_col: str = "text", threshold: float = 0.7, file_share: float = 0.3
) -> DataFrame:
    """One row per distinct path: ``path, own_license, own_score, license, license_dir``.

    ``license_dir`` is the directory whose licence was inherited (``''`` the root),
    null for a file with a licence of its own or with none to inherit. A null path
    is the path ``''``; rows that repeat a path are one file, their texts read
    together. Null and empty texts hold no licence. Equal scores take the licence
    first in alphabet. Other columns are ignored; an empty table gives an empty one.
    """
    spark = files.sparkSession
    terms = template_terms()
    vocabulary = sorted({t[2] for t in terms})
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    path = F.coalesce(quoted(path_col), F.lit(""))
    read = files.select(path.alias("path"), F.transform(F.split(quoted(text_col), "\n"), _words).alias("lines"))
    # a unit that does not begin and end with template words is no better than the shorter one that does
    hits = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.arrays_overlap(F.get("lines", i), vocab))
    units = F.flatten(
        F.transform(
            "hits",
            lambda i: F.transform(
                F.filter("hits", lambda j: (j >= i) & (j < i + WINDOW)),
                lambda j: F.struct(i.alias("pos"), (j - i + 1).alias("width"), F.flatten(F.slice("lines", i + 1, j - i + 1)).alias("words")),
            ),
        )
    )
    kept = (
        read.withColumn("hits", F.when(F.col("lines").isNotNull(), hits))
        .select("path", F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, x: n + F.size(x)).alias("n_words"), units.alias("units"))
    )
    kept = stored(kept, "license-units")
    n_files = kept.select("path").distinct().count()
    sizes = kept.groupBy("path").agg(F.sum("n_words").alias("n_words"))
    lines = kept.select("path", F.monotonically_increasing_id().alias("at"), F.inline("units"))
    lines = lines.select("path", "at", "pos", "width", "words", F.size("words").alias("unit_words"))
    words = lines.select("path", "at", "pos", "width", "unit_words", F.explode("words").alias("term"))
    words = words.where(~F.col("term").isin(*STOP_WORDS))
    known = F.when(F.col("term").isin(*vocabulary), F.col("term"))
    tf = words.groupBy("path", "at", "pos", "width", "unit_words", known.alias("term")).agg(F.count(F.lit(1)).alias("tf"))
    tf = stored(tf, "license-terms")

    found = tf.where("term is not null").select("term", "path").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    shown = spark.createDataFrame(terms, "template int, license string, term string, ttf bigint, key int")
    idf = F.lit(1.0) - F.log(F.greatest(F.coalesce(F.col("df"), F.lit(0)) / F.lit(float(max(n_files, 1))), F.lit(RARE)))
    weights = shown.join(found, "term", "left").withColumn("idf", idf)
    weights = stored(weights.select("template", "license", "term", "key", (F.col("ttf") * F.col("idf")).alias("tw"), "idf"), "license-weights")
    idfs = weights.select("term", "idf").distinct()  # at most the templates' words: safe to broadcast
    length = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tlen"), F.sum("key").alias("n_keys"))
    weights = weights.select("template", "license", "term", "key", "tw")

    unknown = F.lit(1.0) - F.log(F.lit(RARE))
    weighed = tf.join(F.broadcast(idfs), "term", "left").withColumn(
        "w2",
        F.when(F.col("idf").isNull(), F.col("tf") * unknown * unknown).otherwise(F.pow(F.col("tf") * F.col("idf"), F.lit(2))),
    )
    line = ["path", "at", "pos", "width"]
    norms = weighed.groupBy(*line, "unit_words").agg(F.sqrt(F.sum("w2")).alias("len"))
    dots = (
        weighed.where("idf is not null")
        .select(*line, "term", (F.col("tf") * F.col("idf")).alias("w"))
        .join(F.broadcast(weights), "term")
        .groupBy(*line, "template", "license")
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("key").alias("keys"))
    )
    scored = (
        dots.join(norms, line)
        .join(F.broadcast(length), "template")
        .withColumn("score", F.round(F.col("dot") / (F.col("len") * F.col("tlen")), 6))
        .where((F.col("score") >= threshold) & (F.col("keys") == F.col("n_keys")))
    )
    best = F.max(F.struct("score", F.translate("license", _UP, _DOWN).alias("order"), "license")).alias("best")
    licensed = scored.groupBy(*line, "unit_words").agg(best)
    in_lines = F.coalesce(F.sum(F.when(F.col("width") == 1, F.col("unit_words"))), F.lit(0))
    own = licensed.groupBy("path").agg(F.max("best").alias("best"), F.greatest(in_lines, F.max("unit_words")).alias("licensed_words"))
    own = own.join(sizes, "path").select(
        "path",
        F.col("best.license").alias("own_license"),
        F.col("best.score").alias("own_score"),
        F.col("best").alias("best"),
        (
            F.col("path").rlike(LICENSE_NAME) | (F.col("licensed_words") >= F.lit(file_share) * F.col("n_words"))
        ).alias("is_license_file"),
    )
    own = stored(own, "license-own")
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    dirs = own.where("is_license_file").groupBy(directory.alias("license_dir")).agg(F.max("best").alias("dir_best"))
    everyone = kept.select("path").distinct().join(own.select("path", "own_license", "own_score"), "path", "left")
    # every prefix of a directory, the root and itself included; the longest that is licensed wins
    parts = F.split("dir", "/")
    prefixes = F.array_distinct(
        F.concat(
            F.array(F.lit("")),
            F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")),
        )
    )
    # one row per directory seeks, whatever the number of its files
    seekers = everyone.where("own_license is null").select(directory.alias("dir")).distinct().select("dir", F.explode(prefixes).alias("license_dir"))
    inherited = (
        seekers.join(dirs, "license_dir")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("license_dir").alias("depth"), "license_dir", F.col("dir_best.license").alias("license"))).alias("up"))
    )
    seeking = F.when(F.col("own_license").isNull(), directory)  # files with a licence of their own join with nothing
    return everyone.withColumn("dir", seeking).join(inherited, "dir", "left").select(
        "path",
        "own_license",
        "own_score",
        F.coalesce("own_license", "up.license").alias("license"),
        F.col("up.license_dir").alias("license_dir"),
    )


# complements code points, so that a maximum prefers the name first in alphabet
_UP = "".join(map(chr, range(32, 127)))
_DOWN = _UP[::-1]


def oracle_sql(threshold: float = 0.7, file_share: float = 0.3) -> str:
    """The same rows in DuckDB SQL over ``documents`` with path ``source/lang/doc_id``."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(n)}, {quote(t)}, {c}, {k})" for i, n, t, c, k in template_terms())
    stops = ", ".join(quote(w) for w in STOP_WORDS)
    idf = f"1.0 - ln(greatest(coalesce(df, 0) / CAST(n AS DOUBLE), {RARE}))"
    return f"""
WITH tt(template, license, term, ttf, key) AS (VALUES {values}),
files AS (SELECT concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, doc_id, text FROM documents),
n AS (SELECT count(DISTINCT path) AS n FROM files),
raw AS (SELECT path, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM files),
toks AS (SELECT path, pos, unnest(list_filter(string_split_regex(lower(line), '{SPLIT}'), lambda x: x <> '')) AS term FROM raw),
sizes AS (SELECT path, count(*) AS n_words FROM toks GROUP BY 1),
vocab AS (SELECT DISTINCT term FROM tt),
near AS (SELECT DISTINCT path, pos FROM toks WHERE term IN (SELECT term FROM vocab)),
units AS (SELECT a.path, a.pos, b.pos - a.pos + 1 AS width FROM near a JOIN near b ON a.path = b.path AND b.pos >= a.pos AND b.pos < a.pos + {WINDOW}),
ut AS (SELECT u.path, u.pos, u.width, t.term FROM units u JOIN toks t ON t.path = u.path AND t.pos >= u.pos AND t.pos < u.pos + u.width),
lw AS (SELECT path, pos, width, count(*) AS unit_words FROM ut GROUP BY 1, 2, 3),
tf AS (SELECT path, pos, width, v.term, count(*) AS tf FROM ut LEFT JOIN vocab v ON ut.term = v.term
  WHERE ut.term NOT IN ({stops}) GROUP BY 1, 2, 3, 4),
found AS (SELECT term, count(DISTINCT path) AS df FROM tf WHERE term IS NOT NULL GROUP BY 1),
w AS (SELECT template, license, tt.term, key, {idf} AS idf, ttf * ({idf}) AS tw
  FROM n, tt LEFT JOIN found ON tt.term = found.term),
idfs AS (SELECT DISTINCT term, idf FROM w),
tlen AS (SELECT template, sqrt(sum(tw * tw)) AS tlen, sum(key) AS n_keys FROM w GROUP BY 1),
norms AS (SELECT path, pos, width, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (1.0 - ln({RARE})) ^ 2 ELSE (tf * idf) ^ 2 END)) AS len
  FROM tf LEFT JOIN idfs USING (term) GROUP BY 1, 2, 3),
dots AS (SELECT path, pos, width, template, license, sum(tf * idf * tw) AS dot, sum(key) AS keys FROM tf JOIN w USING (term) GROUP BY ALL),
scored AS (SELECT path, pos, width, license, round(dot / (len * tlen), 6) AS score
  FROM dots JOIN norms USING (path, pos, width) JOIN tlen USING (template) WHERE keys = n_keys),
hits AS (SELECT path, pos, width, score, license FROM scored WHERE score >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY path, pos, width ORDER BY score DESC, license) = 1),
own AS (SELECT path, license AS own_license, score AS own_score FROM hits
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
shares AS (SELECT path, greatest(coalesce(sum(unit_words) FILTER (WHERE width = 1), 0), max(unit_words)) AS licensed
  FROM hits JOIN lw USING (path, pos, width) GROUP BY 1),
lf AS (SELECT own.*, regexp_replace(path, '/?[^/]*$', '') AS d FROM own JOIN shares USING (path) JOIN sizes USING (path)
  WHERE licensed >= {file_share} * n_words),
dirs AS (SELECT d, own_license AS license FROM lf QUALIFY row_number() OVER (PARTITION BY d ORDER BY own_score DESC, own_license) = 1),
up AS (SELECT f.path, d, license FROM files f JOIN dirs ON d = '' OR starts_with(f.path, d || '/')
  WHERE f.path NOT IN (SELECT path FROM own) QUALIFY row_number() OVER (PARTITION BY f.path ORDER BY length(d) DESC) = 1)
SELECT f.doc_id, f.path, own_license, own_score, coalesce(own_license, license) AS license, d AS license_dir
FROM files f LEFT JOIN own USING (path) LEFT JOIN up USING (path)"""
