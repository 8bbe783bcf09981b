"""CSV impression logs, submission and small JSON artifacts.

Small artifacts (run logs, best parameters) are written through the Hadoop
FileSystem of the session, so the same call works on local disk, HDFS or an
object store.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.schema import GROUP_COL, impression_schema


class EmptyInputError(ValueError):
    pass


def _scan(spark: SparkSession, paths, train: bool) -> DataFrame:
    return (
        spark.read.schema(impression_schema(train))
        .option("header", True)
        .option("nullValue", "NULL")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("mode", "FAILFAST")
        .csv(paths)
    )


def _plain(uri: str) -> str:
    """A file's address in one spelling: decoded, single slashes."""
    return re.sub("/+", "/", unquote(uri))


def _first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of one file: rows per block are counted, and a row is kept
    by its block's offset and its own place in the block, without a sort or a limit."""
    start, place = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    placed = rows.select("*", start.alias("__block"), place.alias("__line"))
    # one row per block of one file
    blocks = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("n"), F.min("__line").alias("line")).orderBy("__block").collect()
    left, keep = limit, F.lit(False)
    for b in blocks:
        if b["n"] > left:  # the block in which the limit lies; all before it are whole
            keep = (F.col("__block") < b["__block"]) | ((F.col("__block") == b["__block"]) & (F.col("__line") < b["line"] + left))
            break
        left -= b["n"]
    else:
        keep = F.lit(True)
    return placed.where(keep).drop("__block", "__line")


def first_rows(spark: SparkSession, path, train: bool, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of file, block and line.

    Files are counted in path order, twice as many at a time, until the limit is
    reached; later files are never read. Whole files are read as they are, and of the
    file in which the limit lies the rows before it.
    """
    paths = {_plain(f): unquote(f) for f in _scan(spark, path, train).inputFiles()}
    files = sorted(paths)
    whole, left, at, some = [], limit, 0, 1
    cut = None
    while at < len(files) and left > 0 and cut is None:
        batch = files[at : at + some]
        counted = _scan(spark, [paths[f] for f in batch], train).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
        count = {_plain(r["f"]): r["count"] for r in counted}
        if not set(count) <= set(batch):
            raise ValueError(f"files {sorted(set(count) - set(batch))} are read but not listed")
        for f in batch:
            n = count.get(f, 0)  # a file with a header only has no row to count
            if n > left:
                cut = f
                break
            whole.append(f)
            left -= n
        at, some = at + some, some * 2
    parts = [_scan(spark, [paths[f] for f in whole], train)] if whole else []
    if cut is not None and left > 0:
        parts.append(_first_rows(_scan(spark, [paths[cut]], train), left))
    if not parts:
        return _scan(spark, path, train).where(F.lit(False))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def load_impressions(
    spark: SparkSession,
    path: str,
    train: bool = True,
    limit_rows: int | None = None,
    limit_groups: int | None = None,
    group: str = GROUP_COL,
) -> DataFrame:
    """CSV with header and the explicit log schema (S1); ``NULL``, ``NaN`` and an
    empty cell load as null. ``limit_rows`` keeps the first rows in the order of
    file, block and line (S2, may cut a search); ``limit_groups`` keeps whole
    searches with the smallest ids. A missing path raises (S3)."""
    df = _scan(spark, path, train) if limit_rows is None else first_rows(spark, path, train, int(limit_rows))
    real = {c for c, t in df.dtypes if t in ("double", "float")}
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in real else F.col(c) for c in df.columns])
    if limit_groups is not None:
        keys = df.select(group).distinct().orderBy(group).limit(int(limit_groups))
        df = df.join(keys, group, "left_semi")
    return df


def ensure_not_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """End the run on an empty input (S3)."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df


def write_submission(df: DataFrame, path: str) -> None:
    """CSV with header, no index (S4); part files follow the global order."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> str:
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


def write_json(spark: SparkSession, path: str, obj) -> str:
    """One indented JSON document per file."""
    return write_text(spark, path, json.dumps(obj, indent=4, default=str))
