"""Plans of the bridge and of the operators that read it: no repeated runs of the input, no sorts of the log for a join."""

import re

from pyspark.sql import functions as F

from rankmill.operators import profile as P
from rankmill.operators import stats as ST
from rankmill.operators.features import price_rank
from rankmill.operators.split import keep_groups
from rankmill.sources import bridge


def _tables(spark, path):
    """Two searches, one of them with a repeated line; keys without a partner and null keys."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity long, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    rows = [(1, 7, 3, 1, 2, 10.0, 0.01, 0.02, "R", "O"), (1, 7, 3, 1, 2, 10.0, 0.01, 0.02, "R", "O"), (2, 8, 3, 1, 1, 5.0, 0.06, 0.0, "N", "O"), (9, 7, 3, 1, 2, 1.0, 0.0, 0.0, "N", "O"), (2, None, 3, 2, 2, 1.0, 0.0, 0.0, "N", "O")]
    spark.createDataFrame(rows, line).write.parquet(f"{path}/lineitem.parquet")
    spark.sql("SELECT id o_orderkey, id % 2 o_custkey, timestamp_ntz'1995-01-01' o_orderdate, '5-LOW' o_orderpriority FROM range(1, 4)").write.parquet(f"{path}/orders.parquet")
    spark.sql("SELECT id p_partkey, CAST(id AS INT) p_size, 2.0D * id p_retailprice FROM range(7, 9)").write.parquet(f"{path}/part.parquet")
    spark.sql("SELECT id s_suppkey, CAST(id AS INT) s_nationkey, 1.0D * id s_acctbal FROM range(3, 5)").write.parquet(f"{path}/supplier.parquet")
    spark.sql("SELECT id c_custkey, CAST(id AS INT) c_nationkey, 1.0D * id c_acctbal FROM range(0, 2)").write.parquet(f"{path}/customer.parquet")
    return str(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bridge_rows_whatever_the_deal(spark, tmp_path, monkeypatch):
    path = _tables(spark, tmp_path)
    tables = {t: bridge.read_table(spark, path, t) for t in bridge.BASE_TABLES}
    want = sorted(map(str, spark.sql(bridge.bridge_sql(lambda n: "{" + n + "}"), **tables).collect()))
    assert len(want) == 3
    for least in (bridge.COUNTED_ROWS, 0):
        monkeypatch.setattr(bridge, "COUNTED_ROWS", least)
        for deal in ("srch_id", "prop_id"):
            assert sorted(map(str, bridge.impressions(spark, path, deal).collect())) == want


def test_bridge_join_by_search_sorts_nothing_and_feeds_a_group_by(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bridge, "COUNTED_ROWS", 0)
    view = bridge.impressions(spark, _tables(spark, tmp_path))
    keys = view.filter("booking_bool = 1").select("srch_id").distinct()
    plan = _plan(keep_groups(view.select("srch_id", "prop_id"), keys))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    grouped = _plan(view.groupBy("srch_id").count())
    assert len(re.findall(r"Exchange hashpartitioning", grouped)) == 2  # lines and orders, none for the groups


def _runs(spark):
    """A frame, and the accumulator of how often a row of it was made."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return spark.range(0, 100, 1, 2).selectExpr("id % 2 a", "id % 3 b", "CAST(id AS DOUBLE) x", "CAST(id * id % 17 AS DOUBLE) y").mapInArrow(count, "a long, b long, x double, y double"), made


def test_describe_and_chi2_run_their_input_once(spark):
    df, made = _runs(spark)
    got = {r["column_name"]: r for r in P.describe(df, ["x", "y"]).collect()}
    assert (got["x"]["count"], got["x"]["p50"], got["y"]["max"]) == (100, 49.5, 16.0)
    assert made.value == 100
    df, made = _runs(spark)
    assert ST.chi2_2x2(df, "a", "b").first()["dof"] == 2
    assert made.value == 100


def test_correlations_run_their_input_twice(spark):
    df, made = _runs(spark)
    assert abs(ST.pair_correlations(df, {"x": F.col("x"), "z": -F.col("x")}, [("x", "z")])[0] + 1) < 1e-12
    assert made.value == 200
    assert ST.pair_correlations(df.filter("x < 0"), {"x": F.col("x"), "y": F.col("y")}, [("x", "y")]) == [None]


def test_price_rank_is_the_same_for_large_searches(spark):
    rows = [(1, 5.0), (1, 5.0), (1, 3.0), (1, None), (2, 1.0), (None, 4.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "srch_id long, price_usd double")
    want = [(1, 3.0, 1.0), (1, 5.0, 2.5), (1, 5.0, 2.5), (1, None, None), (2, 1.0, 1.0), (None, 4.0, None), (None, 4.0, None)]
    for most in (100, 2):
        found = price_rank(df, max_rows=most).collect()
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, want)), most
    assert "SortMergeJoin" not in _plan(price_rank(df))


def test_ordered_log_is_written_in_slices(spark, tmp_path, monkeypatch):
    """A long log: packed files, slices in key order, every row, one search larger than a slice; shuffle files go with each slice."""
    from rankmill.plans import registry_io

    path = _tables(spark, tmp_path / "in")
    spark.sql("SELECT id o_orderkey, id % 2 o_custkey, timestamp_ntz'1995-01-01' o_orderdate, '5-LOW' o_orderpriority FROM range(1, 60)").write.mode("overwrite").parquet(f"{path}/orders.parquet")
    line = spark.sql(
        "SELECT IF(id % 2 = 0, 30, 1 + id % 59) l_orderkey, 7 + id % 2 l_partkey, 3 + id % 2 l_suppkey, CAST(id % 7 AS INT) l_linenumber, 2 l_quantity, 1.0D * (id % 11) l_extendedprice, 0.01D l_discount, 0.02D l_tax, 'R' l_returnflag, 'O' l_linestatus FROM range(6000)"
    )
    line.write.mode("overwrite").parquet(f"{path}/lineitem.parquet")
    monkeypatch.setattr(bridge, "COUNTED_ROWS", 0)
    monkeypatch.setattr(registry_io, "_folder", lambda spark, name: str(tmp_path / name))
    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(freed)
    got = [tuple(r) for r in registry_io.q_s02(spark, path).collect()]
    assert spark.conf.get(freed) == was
    want = sorted((r.l_orderkey, r.l_partkey, r.l_linenumber, r.l_extendedprice) for r in line.collect())
    assert sorted(got) == want[:5000]
    slices = sorted((tmp_path / "ordered-log").iterdir())
    assert 1 < len(slices) <= registry_io.LOG_SLICES
    files = [sorted(f for f in s.iterdir() if f.name.startswith("part-")) for s in slices]
    assert all(f.name.endswith(".csv.gz") for fs in files for f in fs)
    rows = []
    for s in slices:
        part = spark.read.option("header", True).option("inferSchema", True).csv(str(s)).select("srch_id", "prop_id", "position", "price_usd")
        rows.append(sorted(map(tuple, part.collect())))
    assert all(a[-1] < b[0] for a, b in zip(rows, rows[1:])) and sum(rows, []) == want


def test_shuffle_files_of_freed_jobs_go(spark):
    import time

    def files():
        tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(tracker.apply(i).getName().startswith("shuffle_") for i in range(tracker.size()))

    from rankmill.session import shuffles_freed

    before = files()
    with shuffles_freed(spark):
        df = spark.range(0, 1000, 1, 4).repartition(3, "id")
        assert df.groupBy("id").count().count() == 1000
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before


def test_features_of_a_long_log_are_staged(spark, monkeypatch):
    """Slices and buckets change no row: null searches, hotels and values, repeated rows, one search and one hotel above the limit."""
    from rankmill.operators import features
    from rankmill.schema import impression_schema

    types = {f.name: f.dataType.simpleString() for f in impression_schema(True).fields}
    made = {"srch_id": "IF(id % 11 = 0, NULL, IF(id % 4 = 0, 5, id % 23))", "prop_id": "IF(id % 13 = 0, NULL, IF(id % 3 = 0, 2, id % 9))", "date_time": "timestamp'2013-04-04 08:32:15'"}
    cols = [f"CAST({made.get(c, f'IF(id % {7 + i} = 0, NULL, id * {i + 3} % {5 + i})')} AS {t}) {c}" for i, (c, t) in enumerate(types.items())]
    df = spark.range(0, 400, 1, 4).selectExpr(*cols)
    df = df.union(df.where("prop_id = 2"))
    monkeypatch.setattr(features, "BUCKET_ROWS", 40)
    monkeypatch.setattr(features, "SLICES", 2)
    monkeypatch.setattr(features, "HOTEL_SLICES", 2)
    number = lambda r: tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r)
    for most, profile in ((10_000, "default"), (60, "full")):
        want = features.engineer_features(df, profile, max_rows=most)
        got = features.engineer_features(df, profile, max_rows=most, long_rows=800)
        assert got.columns == want.columns
        assert sorted(map(number, got.collect())) == sorted(map(number, want.collect())), (most, profile)
        if most == 10_000:  # no large search: the windows move no row
            assert "Bucketed: true" in _plan(got) and "Exchange" not in got._jdf.queryExecution().sparkPlan().toString() + _plan(got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rankmill_rows")]
