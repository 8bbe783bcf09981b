"""Impression view over the TPC-H-style test tables.

The test data has no hotel log, so a 54-column impression log is derived from
``lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ customer`` (one line = one hotel shown
in one search, the order key = the search). The same SQL text runs in Spark and
in DuckDB, so every operator can be checked against an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# lines of one task of the join
TASK_ROWS = 400_000
# lines of a log that is left to the planner and AQE as a whole
COUNTED_ROWS = 20 * TASK_ROWS
BASE_TABLES = ("lineitem", "orders", "part", "supplier", "customer")


def _comp_cols() -> str:
    parts = []
    for i in range(1, 9):
        parts.append(
            f"CASE WHEN (l_partkey+{i})%4=0 THEN l_linenumber%3-1 END AS comp{i}_rate,\n"
            f"CASE WHEN (l_partkey+{i})%4=0 THEN l_suppkey%2 END AS comp{i}_inv,\n"
            f"CASE WHEN (l_partkey+{i})%8=0 THEN CAST(5+l_quantity AS DOUBLE) END AS comp{i}_rate_percent_diff,"
        )
    return "\n".join(parts)


def bridge_sql(ref=lambda name: name) -> str:
    """SQL text of the impression view; ``ref`` renders a base-table reference."""
    return f"""SELECT l_orderkey AS srch_id, o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey%24 AS INT) AS date_time,
c_nationkey%5 AS site_id, c_nationkey AS visitor_location_country_id,
CASE WHEN c_custkey%20=0 THEN CAST(1+c_custkey%5 AS DOUBLE) END AS visitor_hist_starrating,
CASE WHEN c_custkey%25=0 THEN c_acctbal END AS visitor_hist_adr_usd,
s_nationkey AS prop_country_id, l_partkey AS prop_id, p_size%6 AS prop_starrating,
CASE WHEN l_partkey%50<>0 THEN (l_partkey%11)/CAST(2 AS DOUBLE) END AS prop_review_score,
CASE WHEN p_size%3>0 THEN 1 ELSE 0 END AS prop_brand_bool,
p_retailprice/CAST(250 AS DOUBLE) AS prop_location_score1,
CASE WHEN l_suppkey%5<>0 THEN s_acctbal/CAST(10000 AS DOUBLE) END AS prop_location_score2,
p_retailprice/CAST(200 AS DOUBLE) AS prop_log_historical_price,
CASE WHEN l_quantity=1 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS price_usd,
CASE WHEN l_discount>CAST(0.055 AS DOUBLE) THEN 1 ELSE 0 END AS promotion_flag,
o_orderkey%300 AS srch_destination_id, 1+o_orderkey%14 AS srch_length_of_stay, o_custkey%366 AS srch_booking_window,
1+o_orderkey%4 AS srch_adults_count, CASE WHEN o_orderkey%3=0 THEN 1+o_orderkey%2 ELSE 0 END AS srch_children_count,
1+o_orderkey%2 AS srch_room_count, o_orderkey%2 AS srch_saturday_night_bool,
CASE WHEN l_partkey%16=0 THEN -1000*l_tax END AS srch_query_affinity_score,
CASE WHEN l_suppkey%3<>0 THEN 100*l_quantity END AS orig_destination_distance,
CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END AS random_bool,
{_comp_cols()}
l_linenumber AS position,
CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN 1 ELSE 0 END AS click_bool,
CASE WHEN l_returnflag='R' AND l_linestatus='O' AND l_discount<CAST(0.045 AS DOUBLE) THEN 1 ELSE 0 END AS booking_bool,
CASE WHEN l_returnflag='R' AND l_linestatus='O' AND l_discount<CAST(0.045 AS DOUBLE) THEN l_extendedprice*(1+l_tax) END AS gross_bookings_usd
FROM {ref('lineitem')} JOIN {ref('orders')} ON l_orderkey=o_orderkey JOIN {ref('part')} ON l_partkey=p_partkey
JOIN {ref('supplier')} ON l_suppkey=s_suppkey JOIN {ref('customer')} ON o_custkey=c_custkey"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def task_count(spark: SparkSession, rows: int, rows_per_task: int = TASK_ROWS, at_least: int | None = None) -> int:
    """Tasks for a shuffle of ``rows`` rows: one per ``rows_per_task``, and at least ``at_least`` (the cluster's parallelism)."""
    return max(spark.sparkContext.defaultParallelism if at_least is None else at_least, -(-rows // rows_per_task))


def impressions(spark: SparkSession, sf_dir: str, deal: str = "srch_id") -> DataFrame:
    """The 54-column impression log derived from the tables in ``sf_dir``.

    Tables are bound as DataFrame parameters (no global temp views), so several
    scale factors can be used in one session. Catalyst prunes each scan to the
    columns the caller finally uses.

    Up to ``COUNTED_ROWS`` lines (counted in the file footers) the joins are planned as
    the SQL text has them. The rows of a longer log come dealt by ``deal`` (``srch_id`` or
    ``prop_id``): the join by that key goes last, so that what groups by it needs no
    shuffle of its own. Orders meet customers while they are narrow, lines meet orders in
    a hash join that sorts nothing, and the number of tasks follows the lines.
    """
    if deal not in ("srch_id", "prop_id"):
        raise ValueError("deal must be 'srch_id' or 'prop_id'")
    line, orders, part, supplier, customer = (read_table(spark, sf_dir, t) for t in BASE_TABLES)
    lines = line.count()
    if lines <= COUNTED_ROWS:
        return spark.sql(bridge_sql(lambda name: "{" + name + "}"), **dict(zip(BASE_TABLES, (line, orders, part, supplier, customer), strict=True)))
    # a given number: AQE does not join the parts to large ones
    n = max(task_count(spark, lines), int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))

    def with_orders(rows: DataFrame) -> DataFrame:
        return rows.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))

    if deal == "srch_id":
        rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        rows = with_orders(rows)
    else:
        rows = with_orders(line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))
        rows = rows.repartition(n, "l_partkey").join(part.repartition(n, "p_partkey").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
    return spark.sql(bridge_sql().split("\nFROM ")[0] + "\nFROM {rows}", rows=rows)


def oracle_cte() -> str:
    """``WITH impressions AS (...)`` prefix for DuckDB oracle queries."""
    return f"WITH impressions AS (\n{bridge_sql()}\n)\n"
