"""Monthly report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import bayes
from tillwork.plans import report
from tillwork.suite.basics import TEST_ID, stored_chain
from tillwork.suite.experiments import CONCLUSION, PROB, RATES, posteriors
from tillwork.suite.joins_aggs import two_tests
from tillwork.suite.parts import half_up, oracle, per
from tillwork.suite.registry import query
from tillwork.suite.star import stored_star

YEAR, MONTH = 1997, 3


def month_sales(r):
    """The stored sales of the month; the other months' files are not opened."""
    return stored_star(r).month("fact_sales", YEAR, MONTH)


@query(
    "report_exec_summary",
    oracle("""
    SELECT count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_key) AS unique_customers,
           CAST(coalesce(sum(total_value), 0) AS DOUBLE) AS total_revenue,
           coalesce(CAST(sum(total_value) AS DOUBLE) / count(total_value), 0) AS avg_order_value
    FROM f_sales WHERE order_date_key >= 19970301 AND order_date_key < 19970331"""),
)
def report_exec_summary(r):
    return report.exec_summary(month_sales(r), YEAR, MONTH)


def full_sql(keys: str = "", where: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    cols = f"{keys}, " if keys else ""
    return f"""
    SELECT {cols}CAST(v AS DOUBLE) AS total_revenue, o AS total_orders, n AS total_line_items, c AS unique_customers,
           {per('v', 'o')} AS avg_order_value, {half_up('n', 'o', 2)} AS items_per_order,
           {per('v', 'c')} AS revenue_per_customer
    FROM (SELECT {cols}sum(total_value) AS v, count(DISTINCT order_id) AS o, count(*) AS n,
                 count(DISTINCT customer_key) AS c
          FROM (SELECT *, order_date_key // 10000 AS year, order_date_key // 100 % 100 AS month FROM f_sales)
          {where} {group})"""


MARCH = "WHERE year = 1997 AND month = 3"


@query("report_exec_summary_full", oracle(full_sql(where=MARCH)))
def report_exec_summary_full(r):
    return report.exec_summary_full(month_sales(r), YEAR, MONTH)


@query("report_all_months", oracle(full_sql("year, month")))
def report_all_months(r):
    return report.exec_summary_all(stored_star(r).read("fact_sales"))


SEGMENTS = f"""
    SELECT customer_segment, n AS customers, CAST(v AS DOUBLE) AS revenue, {per('v', 'n')} AS revenue_per_customer
    FROM (SELECT customer_segment, count(DISTINCT s.customer_key) AS n, sum(total_value) AS v
          FROM f_sales s JOIN d_customer c ON s.customer_key = c.customer_key
          WHERE order_date_key // 100 = 199703 GROUP BY customer_segment)"""


@query("report_segments", oracle(SEGMENTS))
def report_segments(r):
    return report.segments(month_sales(r), stored_star(r).read("dim_customer"), YEAR, MONTH)


@query("report_ab_performance", oracle(f"SELECT r.*, c.winner, c.lift_points FROM ({RATES}) r JOIN ({CONCLUSION}) c USING (test_id)"))
def report_ab_performance(r):
    tests, variants = two_tests(r)
    return report.ab_performance(stored_chain(r), variants, tests, TEST_ID)


@query(
    "report_insights",
    oracle(f"""
    WITH m AS (SELECT * FROM ({full_sql(where=MARCH)}), ({CONCLUSION}),
               (SELECT product_category_name AS best FROM f_sales s JOIN d_product p ON s.product_key = p.product_key
                WHERE order_date_key // 100 = 199703 GROUP BY 1 ORDER BY sum(total_value) DESC, 1 LIMIT 1))
    SELECT 'high_order_value' AS rule, avg_order_value >= 200 AS fired,
           'High AOV of $' || format('{{:,.2f}}', avg_order_value) || ' indicates premium customer base' AS text FROM m
    UNION ALL
    SELECT 'cross_selling', items_per_order >= 2,
           'Good cross-selling: ' || format('{{:,.1f}}', CAST(round(CAST(items_per_order AS DECIMAL(20,2)), 1) AS DOUBLE)) || ' items per order' FROM m
    UNION ALL
    SELECT 'ab_impact', lift_points >= 1, 'A/B test shows measurable impact on conversion rates' FROM m
    UNION ALL
    SELECT 'retention', (SELECT sum(customers) FILTER (WHERE customer_segment = 'new') * 2 >= sum(customers) FROM ({SEGMENTS})) IS TRUE,
           'Implement retention campaigns for new customers' FROM m
    UNION ALL
    SELECT 'continue_testing', (SELECT count(*) FROM ({PROB}) WHERE p <= 0.95) > 0,
           'Continue A/B testing to reach statistical significance' FROM m
    UNION ALL
    SELECT 'inventory', TRUE, 'Optimize inventory for top category: ' || best FROM m"""),
)
def report_insights(r):
    tests, variants = two_tests(r)
    month = month_sales(r)
    decisions = bayes.prob_b_beats_a(posteriors(r))
    return report.insights(
        report.exec_summary_full(month, YEAR, MONTH),
        report.ab_performance(stored_chain(r), variants, tests, TEST_ID),
        report.top_categories(month, stored_star(r).read("dim_product")),
        report.segments(month, stored_star(r).read("dim_customer"), YEAR, MONTH),
        decisions.withColumn("decision", bayes.decide(F.col("prob_treatment_better"))),
    )


@query(
    "report_month_status",
    oracle(f"""
    SELECT '1997-03' AS report_period, total_revenue, total_orders, unique_customers, 'completed' AS report_status
    FROM ({full_sql(where=MARCH)})"""),
)
def report_month_status(r):
    return report.month_status(report.exec_summary_full(month_sales(r), YEAR, MONTH), YEAR, MONTH)
