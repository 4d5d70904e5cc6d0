"""Joins, aggregates and windows that the reference has no counterpart of, over the star schema: an extension."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.operators.ordered import last_known, running_sum
from leksika.plans.registry import Registry
from leksika.sources.tables import read

query = Registry()


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def q_pricing_summary(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )


@query("SELECT n_name, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def q_join_inner(spark, sf_dir):
    orders, customer, nation = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    met = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    return met.groupBy("n_name").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def q_join_left(spark, sf_dir):
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return customer.join(orders, customer.c_custkey == orders.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def q_join_semi(spark, sf_dir):
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return customer.join(orders, customer.c_custkey == orders.o_custkey, "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def q_join_anti(spark, sf_dir):
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return customer.join(orders, customer.c_custkey == orders.o_custkey, "left_anti").select("c_custkey")


@query("SELECT s_suppkey, c_custkey FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def q_join_full(spark, sf_dir):
    supplier, customer = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    return supplier.join(customer, supplier.s_suppkey == customer.c_custkey, "full_outer").select("s_suppkey", "c_custkey")


@query("""WITH s AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'signup'), p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id AS event_id, s.event_id AS signup_id FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts >= s.ts""")
def q_join_asof(spark, sf_dir):
    """Each purchase with the user's last signup before it: one pass over the union of both in stretches, so that a hot user is many tasks; no pairs."""
    events = read(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase")).withColumn("last", (F.col("event_type") != "signup").cast("int"))
    signup = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return last_known(events.select("event_id", "user_id", "ts", "event_type", "last"), "user_id", "ts", "last", "event_id", value=signup, name="signup_id").where("event_type = 'purchase'").select("event_id", "signup_id")


@query("""WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), p AS (SELECT event_id AS purchase_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.purchase_id AS purchase_id, count(*) AS errors FROM p JOIN e ON p.user_id = e.user_id AND e.ts BETWEEN p.ts - INTERVAL 6 HOURS AND p.ts GROUP BY 1""")
def q_join_range(spark, sf_dir):
    """Errors in the six hours before each purchase: the running count at its time less that before its span, in stretches; no pairs."""
    events = read(spark, sf_dir, "events").where(F.col("event_type").isin("error", "purchase")).select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    # place 0: the beginning of a purchase's span, before the errors of its moment; 1: an error; 2: its end, behind them
    purchases = events.where("event_type = 'purchase'")
    marks = events.where("event_type = 'error'").withColumn("place", F.lit(1)).unionByName(purchases.withColumn("us", F.col("us") - 6 * 3600 * 1_000_000).withColumn("place", F.lit(0))).unionByName(purchases.withColumn("place", F.lit(2)))
    counted = running_sum(marks, "user_id", "us", "place", "event_id", value=(F.col("place") == 1).cast("long"), name="seen").where("place <> 1")
    spans = counted.groupBy(F.col("event_id").alias("purchase_id")).agg(F.sum(F.when(F.col("place") == 2, F.col("seen")).otherwise(-F.col("seen"))).alias("errors"))
    return spans.where("errors > 0")


def _sets(kind: str):
    def run(spark, sf_dir):
        rows = read(spark, sf_dir, "orders")
        grouped = rows.groupingSets([["o_orderstatus"], ["o_orderpriority"], []], "o_orderstatus", "o_orderpriority") if kind == "sets" else getattr(rows, kind)("o_orderstatus", "o_orderpriority")
        return grouped.agg(F.count("*").alias("n"), F.round(F.max("o_totalprice"), 2).alias("most"))

    return run


for _name, _kind, _clause in (("q_rollup", "rollup", "ROLLUP (o_orderstatus, o_orderpriority)"), ("q_cube", "cube", "CUBE (o_orderstatus, o_orderpriority)"), ("q_grouping_sets", "sets", "GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")):
    _f = _sets(_kind)
    _f.__name__ = _name
    query(f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS most FROM orders GROUP BY {_clause}")(_f)


@query("""SELECT o_custkey, o_orderkey, CAST(row_number() OVER w AS INTEGER) AS rn, CAST(rank() OVER w AS INTEGER) AS rk, CAST(ntile(4) OVER w AS INTEGER) AS quarter, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS 2 PRECEDING), 2) AS last3
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def q_rank_frames(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.row_number().over(w).alias("rn"), F.rank().over(w).alias("rk"), F.ntile(4).over(w).alias("quarter"), F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("last3")
    )


@query()
def q_approx_distinct(spark, sf_dir):
    """Sketches: estimates, so only rows are checked."""
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.percentile_approx("l_quantity", 0.5).alias("median"))
