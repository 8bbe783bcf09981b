"""Operator 9 — license scan by MinHash bands over overlapping text windows.

Templates are grouped by length; a group has windows of ``size`` words, one every
``size / 8`` words, so an occurrence of a template lies whole in some window and
fills most of it. A window's MinHash values are cut into ``BANDS`` bands of
``ROWS`` values; windows and templates that agree on a band are candidates, and
candidates whose window holds at least ``CONTAINMENT`` of the template's 3-word
shingles are found. Only windows with a shingle of a template of their group
are hashed: any other window has containment 0, so nothing is lost.

Bands: a window that holds the share c of a template's n shingles has a
similarity of at least s = c n / (size + (1 - c) n) >= 0.44 for c = 0.8 and the
group sizes used; 1 - (1 - s^2)^40 > 0.9997, and for whole copies (s >= 0.6)
above 1 - 10^-7.

Texts that lack all of the marker words cannot hold a template: the shingles
with one of a template's marker words are more than (1 - ``CONTAINMENT``) of its
shingles. So most texts are never split into words.

All steps are DataFrame functions. The template tables are joined by broadcast:
they are a fixed list of this module, or the caller's, checked against
``MAX_TEMPLATES``.

Defined cases: null and empty texts hold no license; rows are kept one by one,
so repeated rows and null ids give a row each; other columns stay in ``row``.
An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 3
BANDS, ROWS = 40, 2
CONTAINMENT = 0.8
MAX_TEMPLATES = 1_000

# Notices and license texts that are searched for.
TEMPLATES = {
    "cc-by-nc-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "mit/notice": "Released under the MIT License.",
    "apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "mit/grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions"
    ),
    "isc/grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies"
    ),
    "bsd/conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "apache-2.0/header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'
    ),
    "gpl/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "mpl-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
}

_SPLIT = r"[^\\p{L}\\p{N}]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_shingles(text: str) -> list[str]:
    w = template_words(text)
    return list(dict.fromkeys(" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)))


def window_size(n_words: int) -> int:
    """Words in the windows of a template's group: 8 * g with the least g = 1, 2, 3, 4, 6, 8, 12, ... that fits it."""
    g = [1, 2, 3]
    while 7 * g[-1] + 1 < n_words:
        g.append(g[-2] * 2)
    return 8 * next(x for x in g if 7 * x + 1 >= n_words)


def markers(templates: dict[str, str]) -> list[str]:
    """Words such that every text that holds enough of a template has one of them."""
    chosen: list[str] = []
    for text in templates.values():
        shingles = template_shingles(text)
        words = sorted(set(template_words(text)), key=lambda w: (-len(w), w))
        spare = len(shingles) - -(-len(shingles) * CONTAINMENT // 1)
        hit = lambda some: sum(any(w in s.split() for w in some) for s in shingles)
        mine = [w for w in chosen if w in words]
        for w in words:
            if hit(mine) > spare:
                break
            mine.append(w)
        chosen += [w for w in mine if w not in chosen]
    return chosen


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _shingles(text: str) -> str:
    k = SHINGLE
    joined = f"transform(slice(w, 1, greatest(size(w) - {k - 1}, 0)), (x, i) -> concat_ws(' ', x, w[i + 1], w[i + 2]))"
    return _let(f"array_remove(split(lower({text}), '{_SPLIT}'), '')", "w", joined)


def _windows(groups: dict[int, list[str]]) -> str:
    """Array of (size, start, shingles) of the windows that share a shingle with a template of their group; binds ``sh``."""
    parts = []
    for size, shingles in sorted(groups.items()):
        hop, room = size // 8, size - SHINGLE + 1
        hits = f"filter(sequence(0, size(sh) - 1), i -> sh[i] IN ({_quoted(shingles)}))"
        starts = f"array_distinct(flatten(transform({hits}, p -> sequence(greatest(0, CAST(ceil((p - {room - 1}) / {hop}) AS INT)), CAST(floor(p / {hop}) AS INT)))))"
        parts.append(f"transform({starts}, s -> struct({size} AS size, s * {hop} AS start, array_distinct(slice(sh, s * {hop} + 1, {room})) AS shingles))")
    return f"IF(size(sh) = 0, NULL, concat({', '.join(parts)}))"


def _bands(shingles: str) -> str:
    """Band keys of an array of shingles."""
    value = "array_min(transform(hs, h -> xxhash64(h, {})))"
    keys = f"transform(sequence(1, {BANDS}), b -> xxhash64(b, {', '.join(value.format(f'b * {ROWS} + {r}') for r in range(ROWS))}))"
    return _let(f"transform({shingles}, x -> xxhash64(x))", "hs", keys)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: ``row`` (all its columns) and ``licenses`` (sorted template names found)."""
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MAX_TEMPLATES or any(len(template_words(t)) < SHINGLE for t in templates.values()):
        raise ValueError(f"at most {MAX_TEMPLATES} templates of at least {SHINGLE} words")
    spark = docs.sparkSession
    groups: dict[int, list[str]] = {}
    for text in templates.values():
        own = groups.setdefault(window_size(len(template_words(text))), [])
        own += [s for s in template_shingles(text) if s not in own]
    table = spark.createDataFrame([(n, window_size(len(template_words(t))), template_shingles(t)) for n, t in templates.items()], "name string, t_size int, t_shingles array<string>")
    of_templates = table.select("*", F.explode(F.expr(_bands("t_shingles"))).alias("t_band"))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("t")).withColumn("id", F.monotonically_increasing_id())
    marked = "lower(t) RLIKE '" + "|".join(markers(templates)) + "'"
    windows = rows.select("id", F.expr(f"IF({marked}, {_let(_shingles('t'), 'sh', _windows(groups))}, NULL)").alias("windows"), "row")
    each = windows.select("id", "row", F.posexplode_outer("windows").alias("no", "window"))
    # the row travels with its first window only
    each = each.select("id", F.when(F.coalesce("no", F.lit(0)) == 0, F.col("row")).alias("row"), "window")
    banded = each.select("id", "row", "window", F.posexplode_outer(F.expr(f"IF(window IS NULL, NULL, {_bands('window.shingles')})")).alias("band_no", "band"))
    banded = banded.withColumn("row", F.when(F.coalesce("band_no", F.lit(0)) == 0, F.col("row")))
    near = banded.join(F.broadcast(of_templates), (F.col("band") == F.col("t_band")) & (F.col("window.size") == F.col("t_size")), "left")
    held = F.size(F.array_intersect("window.shingles", "t_shingles")) >= F.ceil(F.size("t_shingles") * CONTAINMENT)
    found = near.select("id", "row", F.when(held, F.col("name")).alias("name"))
    return found.groupBy("id").agg(F.first("row", ignorenulls=True).alias("row"), F.sort_array(F.collect_set("name")).alias("licenses")).select("row", "licenses")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id and licenses (names joined by a comma) for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("row.doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"))


def _oracle() -> str:
    values = ", ".join(
        f"('{n}', {window_size(len(template_words(t)))}, {-(-len(template_shingles(t)) * CONTAINMENT // 1):.0f}, '{s}')" for n, t in TEMPLATES.items() for s in template_shingles(t)
    )
    return rf"""
WITH tp(name, size, need, g) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
s AS (SELECT rid, w, unnest(range(0, len(w) - {SHINGLE - 1})) AS p FROM d WHERE len(w) >= {SHINGLE}),
g AS (SELECT rid, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS g FROM s),
h AS (SELECT rid, p, name, size, need, g FROM g JOIN tp USING (g)),
a AS (SELECT *, unnest(range(greatest(0, CAST(ceil((p - size + {SHINGLE}) / (size / 8)) AS BIGINT)), CAST(floor(p / (size / 8)) AS BIGINT) + 1)) AS start FROM h),
f AS (SELECT DISTINCT rid, name FROM (SELECT rid, name, start, count(DISTINCT g) AS n, any_value(need) AS need FROM a GROUP BY ALL) WHERE n >= need),
l AS (SELECT rid, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM f GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses FROM d LEFT JOIN l USING (rid)
"""


#: DuckDB twin: exact containment over all windows, without MinHash.
ORACLE_SQL = _oracle()
