"""Operator 11 — URL filter: host and path rules before an exact Bloom filter cascade.

A url has keys: its host and every domain above it, and its page (host and path).
The keys of all urls are the cascade's universe. Level 0 is a Bloom filter of the
listed keys, level 1 one of the unlisted keys that pass level 0, level 2 one of the
listed keys that pass level 1, and so on until no key of the universe is misjudged,
so that a lookup is exact for every key of the corpus and no url is joined with the
list.

Scale: the universe is one row per distinct key (two 64-bit hashes and a flag,
reduced before the shuffle, so a host that all urls share costs one row per task).
Keys are dealt to shards by hash, about ``KEYS_PER_SHARD`` a shard, and a shard's
cascade is built in one task. Tasks write their shards' filters below the shared
checkpoint folder and return where they lie; only this index, one row per shard,
reaches the driver. Judging tasks sort a block of keys by shard and load the filters
that they need, holding ``CACHE_BYTES`` of them, so neither the list nor the filters
need to fit anywhere.

Defined cases: host and path of a null url, or one without ``://``, are empty; it has
no keys, no rule fits and it is allowed. A host of more than 253 characters (no DNS
name) has only itself as a domain key. Rules that are equally long win in the order of
their text. Repeated urls and ids are judged alike, listed keys may repeat, be null or
not occur in the corpus. Without listed keys nothing is blocked but by rules. Two keys
with equal 128-bit hashes, one of them listed, would raise an error. Other columns of
the input are kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rankmill.llm import wordhash as wh
from rankmill.llm.warc import open_folder
from rankmill.session import checkpoint_dir

KEYS_PER_SHARD = 1 << 20
MIN_SHARDS = 16
MAX_LEVELS = 64
CACHE_BYTES = 64 << 20
BLOCK_KEYS = 1 << 20
MAX_HOST = 253
# The rules and the listed names of the registered query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
TRACKING = "(^|&)utm_[a-z]+="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, a slash and the rest of a path; it fits the host and its subdomains."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query): empty strings for a url without them."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(text, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)


def domain_key(name: Column) -> Column:
    return F.concat(F.lit("d:"), name)


def page_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("p:"), host, path)


def domains(host: Column) -> Column:
    """The host and the domains above it."""
    labels = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).when(F.length(host) > MAX_HOST, F.array(host)).otherwise(above)


def url_keys(host: Column, path: Column) -> Column:
    """All keys by which a url can be listed."""
    page = F.when((host == "") & (path == ""), F.array().cast("array<string>")).otherwise(F.array(page_key(host, path)))
    return F.concat(F.transform(domains(host), domain_key), page)


def _hash_a(key: Column) -> Column:
    return F.xxhash64(key)


def _hash_b(key: Column) -> Column:
    return F.xxhash64(F.lit("second"), key)


# ------------------------------------------------------------------ cascade
def _places(level: int, m: int, k: int, a: np.ndarray, b: np.ndarray):
    """The k bit places of every key in a level of m bits."""
    first = wh.mix(a ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    step = wh.mix(b + np.uint64((level + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)) | np.uint64(1)
    for _ in range(k):
        yield first % np.uint64(m)
        first = first + step


def _passes(level: int, m: int, k: int, bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    ok = np.ones(len(a), bool)
    for at in _places(level, m, k, a, b):
        ok &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def build_levels(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Levels (bits, hash functions, bit array) that tell listed from unlisted keys without error."""
    held, other = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[tuple[int, int, np.ndarray]] = []
    # a first level this strict, and half-strict ones after it, take the fewest bits in all
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * len(held) / max(1, len(other))))
    while len(held):
        level = len(levels)
        if level == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have the same hashes")
        k = max(1, round(math.log2(1 / rate)))
        m = max(8, math.ceil(len(held) * math.log2(1 / rate) / math.log(2)))
        bits = np.zeros((m + 7) // 8, np.uint8)
        for at in _places(level, m, k, a[held], b[held]):
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        levels.append((m, k, bits))
        wrong = other[_passes(level, m, k, bits, a[other], b[other])]
        held, other, rate = wrong, held, 0.5
    return levels


def contains(levels: list[tuple[int, int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the deepest level that it passes in a row decides."""
    listed = np.zeros(len(a), bool)
    alive = np.arange(len(a))
    for level, (m, k, bits) in enumerate(levels):
        alive = alive[_passes(level, m, k, bits, a[alive], b[alive])]
        listed[alive] = level % 2 == 0
    return listed


def pack(levels: list[tuple[int, int, np.ndarray]]) -> bytes:
    head = np.array([len(levels), *(x for m, k, _ in levels for x in (m, k))], "<u8")
    return head.tobytes() + b"".join(bits.tobytes() for _, _, bits in levels)


def unpack(raw: bytes) -> list[tuple[int, int, np.ndarray]]:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    head = np.frombuffer(raw, "<u8", 2 * n, 8).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for m, k in head.tolist():
        size = (m + 7) // 8
        out.append((m, k, np.frombuffer(raw, np.uint8, size, at)))
        at += size
    return out


@dataclass(frozen=True)
class Cascade:
    """Where the filters of the shards lie: shard -> (path, first byte, bytes)."""

    n_shards: int
    index: dict[int, tuple[str, int, int]]

    @property
    def n_bytes(self) -> int:
        return sum(size for _, _, size in self.index.values())

    def reader(self):
        """Function (a, b) -> listed, for use inside one task."""
        cache: OrderedDict[int, list] = OrderedDict()
        weight = 0

        def load(shard: int) -> list:
            nonlocal weight
            if shard not in cache:
                path, at, size = self.index[shard]
                store, where = open_folder(path)
                with store.open_input_file(where) as f:
                    cache[shard] = unpack(f.read_at(size, at))
                weight += size
                while weight > CACHE_BYTES and len(cache) > 1:
                    old, _ = cache.popitem(last=False)
                    weight -= self.index[old][2]
            return cache[shard]

        def look(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            shard = a % self.n_shards
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(wh.group_starts(shard[order])) if len(order) else np.zeros(0, np.int64)
            listed = np.zeros(len(a), bool)
            for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
                rows = order[lo:hi]
                s = int(shard[rows[0]])
                if s in self.index:
                    listed[rows] = contains(load(s), a[rows].view(np.uint64), b[rows].view(np.uint64))
            return listed

        return look


def build_cascade(keys: DataFrame, listed: DataFrame, folder: str, keys_per_shard: int = KEYS_PER_SHARD) -> Cascade:
    """Cascade over the keys ``key`` of the corpus, which may repeat, and the listed keys ``key``."""
    spark = keys.sparkSession

    def side(df: DataFrame, seen: bool) -> DataFrame:
        key = F.col("key")
        return df.filter("key IS NOT NULL").select(_hash_a(key).alias("a"), _hash_b(key).alias("b"), F.lit(not seen).alias("listed"), F.lit(seen).alias("seen"))

    both = side(keys, True).union(side(listed, False)).groupBy("a", "b").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen"))
    table = f"{folder}/keys"
    both.filter("seen").select("a", "b", "listed").write.parquet(table)
    universe = spark.read.parquet(table)
    n_shards = max(MIN_SHARDS, -(-universe.count() // keys_per_shard))

    def run(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        shard, a, b, flag = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(4))
        path = f"{folder}/filters-{uuid.uuid4().hex}"
        store, where = open_folder(path)
        out, at = [], 0
        with store.open_output_stream(where) as f:
            for s in np.unique(shard):
                mine = np.flatnonzero(shard == s)
                levels = build_levels(a[mine].view(np.uint64), b[mine].view(np.uint64), flag[mine].astype(bool))
                if levels:  # a shard without listed keys needs no filter
                    raw = pack(levels)
                    f.write(raw)
                    out.append((int(s), path, at, len(raw)))
                    at += len(raw)
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["shard", "path", "at", "size"])

    dealt = universe.select(F.pmod("a", F.lit(n_shards)).alias("shard"), "a", "b", "listed").repartition(n_shards, "shard")
    index = dealt.mapInArrow(run, "shard long, path string, at long, size long").collect()  # one row per shard
    return Cascade(n_shards, {r["shard"]: (r["path"], r["at"], r["size"]) for r in index})


# ----------------------------------------------------------------- operator
def judge_urls(df: DataFrame, listed: DataFrame, url: str = "url", rules=RULES, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(row, host, path, rule, verdict, listed): ``row`` holds the columns of ``df``.

    ``listed`` has a column ``key`` of :func:`domain_key` and :func:`page_key` values.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/url-filter-{uuid.uuid4().hex}"
    host, path, _ = url_parts(F.col(f"`{url}`"))
    parts = df.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    corpus = df.select(host.alias("host"), path.alias("path")).select(F.explode(url_keys(F.col("host"), F.col("path"))).alias("key"))
    cascade = build_cascade(corpus, listed, folder, keys_per_shard)
    keyed = parts.withColumn("keys", url_keys(F.col("host"), F.col("path")))
    keyed = keyed.select("row", "host", "path", F.transform("keys", _hash_a).alias("a"), F.transform("keys", _hash_b).alias("b"))

    def run(batches):
        look = cascade.reader()
        for batch in batches:
            n = batch.num_rows
            a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b"))
            sizes = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            hits = np.zeros(n, bool)
            owner = np.repeat(np.arange(n), sizes)
            av, bv = (x.flatten().to_numpy(zero_copy_only=False) for x in (a, b))
            for lo in range(0, len(owner), BLOCK_KEYS):
                cut = slice(lo, lo + BLOCK_KEYS)
                hits[owner[cut][look(av[cut], bv[cut])]] = True
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(hits)], ["row", "host", "path", "listed"])

    schema = StructType([StructField("row", parts.schema["row"].dataType), *StructType.fromDDL("host string, path string, listed boolean").fields])
    out = keyed.mapInArrow(run, schema)
    ordered = sorted((Rule(*r) for r in rules), key=lambda r: (-len(r.text), r.text))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for r in reversed(ordered):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return out.select("row", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def listed_keys(df: DataFrame, url: str = "url", names=LISTED_NAMES, tracking: str = TRACKING) -> DataFrame:
    """The list of the registered query: domains that begin with a listed name, and
    pages that some url of the corpus reaches with a tracking parameter."""
    host, path, query = url_parts(F.col(f"`{url}`"))
    parts = df.select(host.alias("host"), path.alias("path"), query.alias("query"))
    bad = F.filter(domains(F.col("host")), lambda d: F.split(d, r"\.")[0].isin(*names))
    pages = parts.filter(F.col("query").rlike(tracking)).select(page_key(F.col("host"), F.col("path")).alias("key"))
    return parts.select(F.explode(F.transform(bad, domain_key)).alias("key")).union(pages).distinct()


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the verdict on the url of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, listed_keys(pages)).select("row.page_id", "host", "path", "rule", "verdict", "listed")


def oracle_sql(rules=RULES, names=LISTED_NAMES, tracking: str = TRACKING) -> str:
    """DuckDB twin: the rules in turn, and the list by plain membership."""
    ordered = sorted((Rule(*r) for r in rules), key=lambda r: (-len(r.text), r.text))
    fits = {}
    for r in ordered:
        name, slash, rest = r.text.partition("/")
        fits[r] = f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}'))"
    rule = " ".join(f"WHEN {fits[r]} THEN '{r.text}'" for r in ordered)
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in ordered)
    bad = ", ".join(f"'{n}'" for n in names)
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1) AS query FROM u),
tracked AS (SELECT DISTINCT host, path FROM p WHERE regexp_matches(query, '{tracking}') AND NOT (host = '' AND path = '')),
j AS (SELECT page_id, p.host, p.path, (tracked.host IS NOT NULL
  OR list_has_any(CASE WHEN length(p.host) > {MAX_HOST} THEN string_split(p.host, '.')[1:1] ELSE string_split(p.host, '.') END, [{bad}])) AS listed
  FROM p LEFT JOIN tracked ON p.host = tracked.host AND p.path = tracked.path)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM j
"""


ORACLE_SQL = oracle_sql()
