"""Operator 12 — divergence audit of sources: pair tasks that merge sparse term counts.

Within a language, every source's term distribution (smoothed, in billionths) is
compared with that of every other source and with that of the whole language. All
arithmetic is on integers.

1. Count: every task counts its texts' terms per (language, source), so a source with
   a third of all rows sends one row per term and task; the rows are dealt by
   (language, term), and one window there gives a term's totals over the language.
2. Terms that enough documents hold are kept and numbered inside slices of about
   ``SLICE_TERMS`` terms dealt by hash; a source has one sorted (term number, count)
   array per slice, which bounds what any task holds.
3. Sources are put into blocks of ``BLOCK_SOURCES``; a pair task holds two blocks of
   one slice and merges every unordered pair of their sources once: the shorter array
   gallops through the longer one, the overlap is priced term by term, terms of one
   side against the other side's smoothing mass, and terms of neither by their number.
   Partial sums of a pair's slices are added.

Defined cases: null text, lang and source are ''. A language without kept terms gives
every pair 0 and no term rows; a language with one source has no pairs. Repeated rows
and ids count each as a document. Terms are runs of ASCII letters and characters beyond
ASCII. Equal values are ranked by the item's UTF-8 bytes. Columns other than these
three are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankmill.session import checkpoint_dir

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
SLICE_TERMS = 1 << 16
MIN_SLICES = 16
BLOCK_SOURCES = 8
HELD_TERMS = 200_000

# every byte that is no ASCII letter and below 0x80 becomes a space, A-Z become a-z
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def text_terms(text: str) -> list[bytes]:
    """Lower-cased terms of a text as UTF-8."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split(b" ") if text else []


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", held_terms: int = HELD_TERMS) -> DataFrame:
    """(lang, source, term, n, docs) counted inside tasks; a group of texts without terms has one row with a null term."""

    def run(batches):
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            langs, sources, terms, ns, ds = [], [], [], [], []
            for (l, s), (n, d) in counts.items():
                langs += [l] * (len(n) + 1)
                sources += [s] * (len(n) + 1)
                terms += [None, *(t.decode("utf-8") for t in n)]
                ns += [0, *n.values()]
                ds += [0, *(d[t] for t in n)]
            counts.clear()
            for lo in range(0, len(terms), 50_000):
                cut = slice(lo, lo + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[cut], t) for c, t in ((langs, pa.string()), (sources, pa.string()), (terms, pa.string()), (ns, pa.int64()), (ds, pa.int64()))],
                    ["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            for l, s, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n, d = counts.setdefault((l, s), (Counter(), Counter()))
                own = Counter(text_terms(t))
                own.pop(b"", None)
                n.update(own)
                d.update(own.keys())
            if sum(len(n) + 1 for n, _ in counts.values()) > held_terms:
                yield from flush()
        yield from flush()

    texts = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), by long division so that no step leaves a long."""
    over = total + F.lit(SMOOTH) * terms
    rest = count + F.lit(SMOOTH)
    whole = F.lit(1).cast("long")
    for unit in (10**9, 10**6, 10**3, 1):
        whole = whole + F.call_function("div", rest, over) * F.lit(unit)
        rest = (rest % over) * F.lit(1000)
    return whole


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """:func:`share` on an array."""
    over = total + SMOOTH * terms
    rest = count + SMOOTH
    whole = np.ones(len(count), np.int64)
    for unit in (10**9, 10**6, 10**3, 1):
        whole += rest // over * unit
        rest = rest % over * 1000
    return whole


def merge(ids_a, p_a, zero_a: int, ids_b, p_b, zero_b: int) -> tuple[int, int]:
    """(sum of |p_a - p_b| over the terms of either side, number of those terms).

    Both id arrays ascend; a side without a term has its ``zero`` there. The places of
    the shorter array in the longer one come from one galloping search.
    """
    if len(ids_a) > len(ids_b):
        ids_a, p_a, zero_a, ids_b, p_b, zero_b = ids_b, p_b, zero_b, ids_a, p_a, zero_a
    if not len(ids_b):
        return 0, 0
    at = np.minimum(np.searchsorted(ids_b, ids_a), len(ids_b) - 1)
    both = ids_b[at] == ids_a
    shared = at[both]
    total = int(np.abs(p_a[both] - p_b[shared]).sum()) + int(np.abs(p_a[~both] - zero_b).sum())
    total += int(np.abs(p_b - zero_a).sum()) - int(np.abs(p_b[shared] - zero_a).sum())
    return total, len(ids_a) + len(ids_b) - len(shared)


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the kept terms; ``first`` is 1 in one row
    of each (lang, term). Every (lang, source) also has a row with a null term."""
    dealt = counts.withColumn("deal", F.coalesce("term", F.concat(F.lit(" "), "source"))).repartition("lang", "deal")
    rows = dealt.groupBy("lang", "deal", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "deal")
    rows = rows.select("*", F.sum("docs").over(term).alias("lang_docs"), F.sum("n").over(term).alias("lang_n"), F.row_number().over(term.orderBy("source")).alias("at"))
    rows = rows.filter(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
    first = F.when(F.col("term").isNotNull() & (F.col("at") == 1), 1).otherwise(0)
    return rows.select("lang", "source", "term", "n", "lang_n", first.alias("first"))


def group_table(kept: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, idx): one row per group; idx numbers a language's sources."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return own.join(langs, "lang").select("lang", "source", "total", "terms", "lang_total", number.alias("idx"))


def pair_divergence(kept: DataFrame, groups: DataFrame, n_slices: int, block: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, a, b, value) for every unordered pair of a language's sources."""
    terms = kept.filter("term IS NOT NULL").withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(n_slices)).cast("int"))
    terms = terms.withColumn("id", F.dense_rank().over(Window.partitionBy("lang", "slice").orderBy("term")))
    arrays = terms.groupBy("lang", "slice", "source").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("held"))
    arrays = arrays.select("lang", "slice", "source", F.col("held.id").alias("ids"), F.col("held.n").alias("ns"))
    sides = groups.select("lang", "source", "total", "terms", "idx", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice"))
    sides = sides.join(arrays, ["lang", "slice", "source"], "left")
    last = groups.groupBy("lang").agg(F.floor(F.max("idx") / block).cast("int").alias("last"))
    own = F.floor(F.col("idx") / block).cast("int")
    sides = sides.join(last, "lang").select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    sides = sides.select("lang", "slice", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "source", "total", "terms", "idx", "ids", "ns")

    def run(task: pa.Table) -> pa.Table:
        x, y = task.column("x")[0].as_py(), task.column("y")[0].as_py()
        lang, terms = task.column("lang")[0].as_py(), task.column("terms")[0].as_py()
        held = []
        for i in range(task.num_rows):
            row = {c: task.column(c)[i] for c in ("source", "total", "idx", "own", "ids", "ns")}
            some = row["ids"].is_valid
            ids, ns = (row[c].values.to_numpy(zero_copy_only=False).astype(np.int64) if some else np.zeros(0, np.int64) for c in ("ids", "ns"))
            total = row["total"].as_py()
            zero = int(shares(np.zeros(1, np.int64), total, terms)[0]) if terms else 0
            held.append((row["idx"].as_py(), row["own"].as_py(), row["source"].as_py(), ids, shares(ns, total, terms) if some else ns, zero))
        held.sort(key=lambda h: h[0])
        out = []
        for k, (_, own_a, a, ids_a, p_a, zero_a) in enumerate(held):
            for _, own_b, b, ids_b, p_b, zero_b in held[k + 1 :]:
                if (own_a, own_b) == (x, y):
                    out.append((lang, a, b, terms, abs(zero_a - zero_b), *merge(ids_a, p_a, zero_a, ids_b, p_b, zero_b)))
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "a", "b", "terms", "gap", "part", "seen"])

    parts = sides.groupBy("lang", "slice", "x", "y").applyInArrow(run, "lang string, a string, b string, terms long, gap long, part long, seen long")
    value = F.sum("part") + (F.max("terms") - F.sum("seen")) * F.max("gap")
    return parts.groupBy("lang", "a", "b").agg(value.alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group holds most above its language."""
    rows = kept.filter("term IS NOT NULL AND n > 0").join(groups, ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), (share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, slice_terms: int = SLICE_TERMS, block: int = BLOCK_SOURCES, top: int = TOP_TERMS, held_terms: int = HELD_TERMS, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank); ``columns`` may name text, lang and source."""
    spark = docs.sparkSession
    table = f"{checkpoint_dir(spark)}/divergence-{uuid.uuid4().hex}"
    kept_counts(term_counts(docs, held_terms=held_terms, **columns), min_docs).write.parquet(table)
    kept = spark.read.parquet(table)
    groups = group_table(kept)
    most = groups.agg(F.max("terms")).first()[0] or 0
    pairs = pair_divergence(kept, groups, max(MIN_SLICES, -(-most // slice_terms)), block)
    each = pairs.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("of"))
    each = each.select("lang", "of.source", "of.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    each = each.withColumn("rank", F.row_number().over(order))
    both = [(each, "pair"), (term_divergence(kept, groups, top), "term")]
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for df, part in both]
    return out[0].union(out[1])


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB twin: the dense tables of all groups and kept terms.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT o.lang, o.source, coalesce(sum(c.n), 0) AS total, coalesce(any_value(v.terms), 0) AS terms, any_value(v.lang_total) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN c ON o.lang = c.lang AND o.source = c.source LEFT JOIN v ON o.lang = v.lang GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  CAST(1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH}) // (g.total + {SMOOTH} * g.terms) AS BIGINT) AS p,
  CAST(1 + {SCALE}::HUGEINT * (k.lang_n + {SMOOTH}) // (g.lang_total + {SMOOTH} * g.terms) AS BIGINT) AS q
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
