"""The flagship check: orders by status behind a quality gate."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import Measure, group_summary, with_pct_of_total
from strata.plans import inputs
from strata.queries import register
from strata.queries.sqlhelp import avg_rounded, pct, sum_rounded


def order_gate(orders: DataFrame):
    """Orders failing the gate: missing key/status, non-positive price, unknown status."""
    return [F.col("o_orderkey").isNull(), F.col("o_orderstatus").isNull(), F.col("o_totalprice") <= 0,
            ~F.col("o_orderstatus").isin("F", "O", "P")]


def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-gated orders per status: orders, revenue, average order, share of all orders."""
    orders = inputs.table(spark, sf_dir, "orders")
    failed = F.coalesce(functools.reduce(lambda a, b: a | b, order_gate(orders)), F.lit(False))
    g = group_summary(orders.withColumn("_failed", failed), ["_failed", "o_orderstatus"], [
        Measure("order_count", "count"),
        Measure("revenue", "sum", "o_totalprice", round=2),
        Measure("avg_order_value", "avg", "o_totalprice", round=2),
        Measure("customers", "count_distinct", "o_custkey"),
    ])
    return with_pct_of_total(g, "order_count").filter(~F.col("_failed")).drop("_failed").orderBy(F.col("revenue").desc())


register("orders_by_status", f"""
SELECT o_orderstatus, count(*) AS order_count, {sum_rounded('o_totalprice')} AS revenue,
  {avg_rounded('o_totalprice', 2)} AS avg_order_value, count(DISTINCT o_custkey) AS customers,
  {pct('count(*)', '(SELECT count(*) FROM orders)')} AS pct_of_total
FROM orders WHERE NOT coalesce(o_orderkey IS NULL OR o_orderstatus IS NULL OR o_totalprice <= 0
  OR o_orderstatus NOT IN ('F', 'O', 'P'), false)
GROUP BY o_orderstatus""")(orders_by_status)
