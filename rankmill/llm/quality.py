"""Operator 6 — quality rules: a threshold table compiled into one Spark projection.

Every measure is a Spark SQL expression over the row's own text, so the operator
is one ``select`` without a shuffle and without user functions. The words, the
lines and the hashes of the 3-word windows are bound once per row
(``transform(array(x), x -> ...)[0]``), so no later expression computes them
again.

Repeated windows: the window hashes are sorted, equal neighbours give the
repeated ones, and the windows that have a repeated hash cover the words that
count. Where many hashes repeat, (hash, place) pairs are sorted instead of
searching the list, which gives the same windows without a quadratic step.

Defined cases: a null or empty text has no words and fails the base rules; a
ratio over zero words or lines is 0; repeated rows are judged alike; other
columns of the input are kept beside ``quality`` by :func:`quality_rules`,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Fixed word list: frequent function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with in is it for on as at by an this from or are was "
    "der die das und ist von mit zu den dem ein eine im auf für nicht "
    "le la les de des et un une est en que qui du dans pour "
    "el los las y en un una es por con para del se"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes when ``measure`` is within [least, most]; None leaves a side open."""

    measure: str
    least: float | None
    most: float | None


#: Measures are those of ``MEASURES``; ratios are per word or per line with a word.
RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.25),
    Rule("stop_words", 2.0, None),
    Rule("alpha_word_ratio", 0.6, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.4),
)

_SPACE = r"[ \\t\\n\\x0B\\f\\r]+"
_STOP = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
_PER_WORD = "IF(n_words = 0, 0D, {} / n_words)"
_PER_LINE = "IF(n_lines = 0, 0D, {} / n_lines)"

MEASURES = {
    "mean_word_chars": _PER_WORD.format("word_chars"),
    "symbol_ratio": _PER_WORD.format("n_symbols"),
    "stop_words": "CAST(n_stop AS DOUBLE)",
    "alpha_word_ratio": _PER_WORD.format("n_alpha"),
    "dup_line_ratio": _PER_LINE.format("n_dup_lines"),
    "bullet_line_ratio": _PER_LINE.format("n_bullet"),
    "ellipsis_line_ratio": _PER_LINE.format("n_ellipsis"),
}


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words() -> str:
    """Words covered by windows found twice or more, from the bound array ``w``."""
    k = WINDOW
    hashes = f"transform(slice(w, 1, size(w) - {k - 1}), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))"
    twice = "filter(sorted, (x, i) -> i > 0 AND x = sorted[i - 1] AND (i = 1 OR x != sorted[i - 2]))"
    few = "filter(sequence(0, size(h) - 1), i -> array_contains(twice, h[i]))"
    pairs = "sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))"
    many = "sort_array(transform(filter(pairs, (p, j) -> (j > 0 AND p.x = pairs[j - 1].x) OR (j < size(pairs) - 1 AND p.x = pairs[j + 1].x)), p -> p.i))"
    covered = f"aggregate(transform(hit, (x, j) -> IF(j < size(hit) - 1, least({k}, hit[j + 1] - x), {k})), 0L, (a, x) -> a + x)"
    hit = f"IF(size(twice) <= 32, {few}, {_let(pairs, 'pairs', many)})"
    inner = _let("sort_array(h)", "sorted", _let(twice, "twice", f"IF(size(twice) = 0, 0L, {_let(hit, 'hit', covered)})"))
    return f"IF(size(w) < {k + 1}, 0L, {_let(hashes, 'h', inner)})"


def counts(text: str = "text") -> str:
    """One SQL struct of all counts over the column ``text``."""
    without = "t"
    for symbol in "#*$%&|<>":
        without = f"replace({without}, '{symbol}', '')"
    words = f"array_remove(split(t, '{_SPACE}'), '')"
    lines = r"filter(split(t, '\\n'), l -> l RLIKE '[^ \\t\\n\\x0B\\f\\r]')"
    on_lines = _let(
        lines,
        "ls",
        "struct(CAST(size(ls) AS BIGINT) AS n_lines, CAST(size(ls) - size(array_distinct(ls)) AS BIGINT) AS n_dup_lines, "
        r"CAST(size(filter(ls, l -> l RLIKE '^\\s*[-*\\u2022]')) AS BIGINT) AS n_bullet, "
        r"CAST(size(filter(ls, l -> l RLIKE '(\\.\\.\\.|\\u2026)\\s*$')) AS BIGINT) AS n_ellipsis)",
    )
    on_words = _let(
        words,
        "w",
        f"struct(CAST(size(w) AS BIGINT) AS n_words, CAST(length(array_join(w, '')) AS BIGINT) AS word_chars, {_repeat_words()} AS n_repeat_words, "
        f"CAST(size(filter(w, x -> lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop, CAST(size(filter(w, x -> x RLIKE '\\\\p{{L}}')) AS BIGINT) AS n_alpha)",
    )
    body = f"struct(CAST(length(t) - length({without}) AS BIGINT) AS n_symbols, {on_lines} AS l, {on_words} AS w)"
    return _let(f"coalesce({text}, '')", "t", body)


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` as the struct ``row`` and the struct ``quality``: counts, measures, base_failed, kept."""
    names = ("n_words", "word_chars", "n_repeat_words", "n_stop", "n_alpha")
    on_lines = ("n_lines", "n_dup_lines", "n_bullet", "n_ellipsis")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.expr(counts("CAST(text AS STRING)")).alias("c"))
    flat = out.select("row", *[F.col(f"c.w.{n}") for n in names], *[F.col(f"c.l.{n}") for n in on_lines], F.col("c.n_symbols"))
    flat = flat.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    tests = [f"({MEASURES[r.measure]}) {op} {bound}D" for r in rules for op, bound in ((">=", r.least), ("<=", r.most)) if bound is not None]
    flat = flat.withColumn("kept", F.expr(" AND ".join(["NOT base_failed", *tests])))
    measures = [F.expr(sql).alias(m) for m, sql in MEASURES.items()]
    return flat.select("row", F.struct(*names, *on_lines, "n_symbols", *measures, "base_failed", "kept").alias("quality"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts, base_failed and kept for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = [F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")]
    return quality_rules(docs).select("row.doc_id", *q)


_SQL_RULES = " AND ".join(f"({MEASURES[r.measure].replace('0D', 'CAST(0 AS DOUBLE)').replace('IF(', 'if(')}) {op} {b}" for r in RULES for op, b in ((">=", r.least), ("<=", r.most)) if b is not None)

#: DuckDB twin.
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
s AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= {WINDOW}),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM s),
r AS (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM r GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (regexp_matches(line, '^\s*[-*\x{{2022}}]')) AS n_bullet,
  count(*) FILTER (regexp_matches(line, '(\.\.\.|\x{{2026}})\s*$')) AS n_ellipsis FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_bullet, 0) AS n_bullet, coalesce(n_ellipsis, 0) AS n_ellipsis,
  len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_SQL_RULES} AS kept FROM b
"""
