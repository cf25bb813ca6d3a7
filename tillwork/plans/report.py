"""Monthly report rows.

Sales are reduced to the grain a report needs (order, customer or product)
before they are counted or joined: distinct counts then work on that grain,
and a dimension meets one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.scalars import money, or_zero, safe_divide
from tillwork.operators.aggregates import top_n
from tillwork.operators.bayes import conclusion, report_rates
from tillwork.operators.joins import attach_one_row
from tillwork.operators.relational import where_month_key, where_month_key_half_open

DATE_KEY = "order_date_key"


def month_of(sales: DataFrame, year: int, month: int) -> DataFrame:
    return where_month_key_half_open(sales, DATE_KEY, year, month)


def _per_order(sales: DataFrame, *by: str) -> DataFrame:
    return sales.groupBy(*by, "customer_key", "order_id").agg(
        F.sum("total_value").alias("value"),
        F.count("total_value").alias("valued"),
        F.count(F.lit(1)).alias("lines"),
    )


def _money(x: Column) -> Column:
    return x.cast("decimal(20,2)")


def exec_summary(sales: DataFrame, year: int, month: int) -> DataFrame:
    """Orders, customers, revenue and mean line value of a month without its 31st.

    The mean is per line although it is called an order value; see
    ``exec_summary_full`` for revenue per order.
    """
    orders = _per_order(where_month_key(sales, DATE_KEY, year, month))
    mean = F.sum("value").cast("double") / F.nullif(F.sum("valued"), F.lit(0))
    return orders.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_key").alias("unique_customers"),
        _money(or_zero(F.sum("value"))).alias("total_revenue"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_order_value"),
    )


def _full(orders: DataFrame, *by: str) -> DataFrame:
    counted = orders.groupBy(*by).agg(
        _money(or_zero(F.sum("value"))).alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        or_zero(F.sum("lines")).alias("total_line_items"),
        F.count_distinct("customer_key").alias("unique_customers"),
    )
    return with_ratios(counted)


def with_ratios(counted: DataFrame) -> DataFrame:
    """Add the ratios of revenue, orders, lines and customers."""
    revenue = F.col("total_revenue")
    n_orders, n_customers = F.col("total_orders"), F.col("unique_customers")
    lines = F.col("total_line_items").cast("decimal(20,0)")
    return counted.withColumns(
        {
            "avg_order_value": _money(or_zero(F.round(safe_divide(revenue, n_orders), 2))),
            "items_per_order": or_zero(F.round(safe_divide(lines, n_orders), 2)).cast("decimal(20,2)"),
            "revenue_per_customer": _money(or_zero(F.round(safe_divide(revenue, n_customers), 2))),
        }
    )


def exec_summary_full(sales: DataFrame, year: int, month: int) -> DataFrame:
    """The month's totals and ratios, one row."""
    return _full(_per_order(month_of(sales, year, month)))


def exec_summary_all(sales: DataFrame) -> DataFrame:
    """The same for every month with sales, in one job."""
    key = F.col(DATE_KEY)
    year = (key / 10000).cast("int").alias("year")
    month = ((key % 10000) / 100).cast("int").alias("month")
    dated = sales.select("*", year, month)
    return _full(_per_order(dated, "year", "month"), "year", "month")


def segments(sales: DataFrame, dim_customer: DataFrame, year: int, month: int) -> DataFrame:
    """Customers, revenue and revenue per customer of each segment."""
    per_customer = (
        month_of(sales, year, month).groupBy("customer_key").agg(F.sum("total_value").alias("value"))
    )
    grouped = (
        per_customer.join(dim_customer.select("customer_key", "customer_segment"), "customer_key")
        .groupBy("customer_segment")
        .agg(F.count("customer_key").alias("customers"), _money(F.sum("value")).alias("revenue"))
    )
    each = F.round(safe_divide(F.col("revenue"), F.col("customers")), 2)
    return grouped.withColumn("revenue_per_customer", _money(each))


def top_categories(sales: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    """The n categories with most revenue, with rank and items."""
    per_product = sales.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("k"), F.sum("total_value").alias("v")
    )
    grouped = (
        per_product.join(dim_product.select("product_key", "product_category_name"), "product_key")
        .groupBy("product_category_name")
        .agg(F.sum("k").alias("items"), _money(F.sum("v")).alias("revenue"))
    )
    return top_n(grouped, n, "revenue", "product_category_name")


def top_states(sales: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    """The n states with most revenue, with rank, customers and orders."""
    grouped = (
        _per_order(sales)
        .join(dim_customer.select("customer_key", "customer_state"), "customer_key")
        .groupBy("customer_state")
        .agg(
            F.count_distinct("customer_key").alias("customers"),
            F.count_distinct("order_id").alias("orders"),
            _money(F.sum("value")).alias("revenue"),
        )
    )
    return top_n(grouped, n, "revenue", "customer_state")


def ab_performance(store: DataFrame, variants: DataFrame, tests: DataFrame, test_id: str) -> DataFrame:
    """Rates per variant with the winner and its lead on every row."""
    rates = report_rates(store, variants, tests, test_id)
    return rates.join(conclusion(rates), "test_id")


# Limits are a choice of this library; the reports only show outcomes.
INSIGHT_THRESHOLDS: Mapping[str, float] = {
    "high_order_value": 200.0,
    "cross_selling": 2.0,
    "ab_impact_points": 1.0,
    "new_customers": 0.5,
}


def insights(
    summary: DataFrame,
    ab: DataFrame,
    categories: DataFrame,
    segments: DataFrame,
    decisions: DataFrame,
    thresholds: Mapping[str, float] = INSIGHT_THRESHOLDS,
) -> DataFrame:
    """(rule, fired, text): insights and recommendations of a month.

    From its summary, the A/B conclusion, the top categories, the customers by
    segment, and the decision on each treatment (``decision``).
    """
    share = F.sum(F.when(F.col("customer_segment") == "new", F.col("customers"))) / F.nullif(F.sum("customers"), F.lit(0))
    facts = summary.select("avg_order_value", "items_per_order")
    for more in (
        ab.agg(F.max("lift_points").alias("lift_points")),
        categories.agg(F.max(F.when(F.col("rank") == 1, F.col("product_category_name"))).alias("best")),
        segments.agg(share.alias("new_share")),
        decisions.agg(F.count_if(F.col("decision") == "not significant").alias("undecided")),
    ):
        facts = attach_one_row(facts, more)
    aov, items, lift = F.col("avg_order_value"), F.col("items_per_order"), F.col("lift_points")
    # The sentences of the report.
    rules = [
        (
            "high_order_value",
            aov >= thresholds["high_order_value"],
            F.concat(F.lit("High AOV of $"), money(aov), F.lit(" indicates premium customer base")),
        ),
        (
            "cross_selling",
            items >= thresholds["cross_selling"],
            F.concat(
                F.lit("Good cross-selling: "),
                F.format_number(items.cast("decimal(20,1)"), 1),
                F.lit(" items per order"),
            ),
        ),
        (
            "ab_impact",
            lift >= thresholds["ab_impact_points"],
            F.lit("A/B test shows measurable impact on conversion rates"),
        ),
        (
            "retention",
            F.col("new_share") >= thresholds["new_customers"],
            F.lit("Implement retention campaigns for new customers"),
        ),
        (
            "continue_testing",
            F.col("undecided") > 0,
            F.lit("Continue A/B testing to reach statistical significance"),
        ),
        (
            "inventory",
            F.col("best").isNotNull(),
            F.concat(F.lit("Optimize inventory for top category: "), F.coalesce("best", F.lit("none"))),
        ),
    ]
    rows = [
        F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("fired"), t.alias("text"))
        for n, c, t in rules
    ]
    return facts.select(F.inline(F.array(*rows)))


def month_status(summary: DataFrame, year: int, month: int) -> DataFrame:
    """The closing line of a month's report."""
    return summary.select(
        F.lit(f"{year}-{month:02d}").alias("report_period"),
        "total_revenue",
        "total_orders",
        "unique_customers",
        F.lit("completed").alias("report_status"),
    )
