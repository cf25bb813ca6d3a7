"""Lines that met their orders once say what the separate joins and sums said, with odd rows too."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.plans import dims, facts, orderbook, warehouse
from tillwork.plans.warehouse import bulk_load, load_batch
from tillwork.session import work_path
from tillwork.sources import months
from tillwork.sources.files import keep
from tillwork.sources.months import MonthlyTable

RUN = dt.datetime(2020, 1, 1)
DAY, LATER = dt.datetime(2020, 1, 5, 13), dt.datetime(2020, 2, 5)
MONEY = "decimal(10,2)"


def gathered(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def odd(spark):
    """Strangers, missing ids, a line without price, orders of one time, one without a date, one without items."""
    customers = spark.createDataFrame([(c, f"u{c}", "1", "x", "SP") for c in (7, 8)], "customer_id long, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string")
    orders = spark.createDataFrame(
        [(9, 7, "created", DAY), (10, 7, "created", DAY), (2, 7, "created", LATER), (3, 8, "created", LATER), (4, 99, "created", DAY), (5, None, "created", DAY),
         (6, 8, "created", None), (None, 8, "created", DAY), (None, 8, "created", DAY)],
        f"order_id long, customer_id long, order_status string, {facts.BOUGHT} timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(9, 1, 1, 5, 1, 1), (9, 2, 1, 5, 2, 1), (9, 3, 1, 6, 3, 0), (10, 1, 2, None, 3, 1), (10, 2, 77, 5, 4, 1), (2, 1, 2, 66, 5, 1), (2, 2, 1, 6, None, 1),
         (4, 1, 1, 6, 7, 1), (5, 1, 1, 6, 8, 1), (6, 1, 1, 5, 9, 1), (None, 1, 1, 5, 9, 1), (44, 1, 1, 5, 9, 1), (2, 3, None, 6, 2, 2)],
        "order_id long, order_item_id int, product_id long, seller_id long, price long, freight_value long",
    ).withColumns({c: F.col(c).cast(MONEY) for c in ("price", "freight_value")})
    payments = spark.createDataFrame(
        [(9, 1, "voucher", 1, 5), (9, 2, "voucher", 3, 5), (10, 1, "credit_card", 2, 6), (2, 1, "boleto", 1, None), (4, 1, "boleto", 1, 3), (6, 1, "boleto", 1, 3), (None, 1, "boleto", 1, 3), (5, 1, "boleto", 1, 3)],
        "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value long",
    ).withColumn("payment_value", F.col("payment_value").cast(MONEY))
    products = spark.createDataFrame([(p, "c", 1, 1, 1, 1, 1, 1, 1) for p in (1, 2)], "product_id long, product_category_name string, product_name_length int, product_description_length int, product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int")
    sellers = spark.createDataFrame([(s, "1", "x", "SP") for s in (5, 6)], "seller_id long, seller_zip_code_prefix string, seller_city string, seller_state string")
    reviews = spark.createDataFrame([(1, 9, 5, None, "t", DAY)], "review_id long, order_id long, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz")
    return {"customers": customers, "orders": orders, "order_items": items, "order_payments": payments, "order_reviews": reviews, "products": products, "sellers": sellers}


@pytest.mark.parametrize("kind", ["sample", "odd"])
def test_lines_agree(spark, retail, kind):
    if kind == "sample":
        orders, items, payments = retail.orders_with_delivery, retail.items, retail.payments
        ids = [retail.customers.selectExpr("customer_id", "customer_id * 2 as customer_key"), retail.products.selectExpr("product_id", "product_id + 5 as product_key"), retail.sellers.selectExpr("seller_id", "seller_id + 1 as seller_key")]
    else:
        t = odd(spark)
        orders, items, payments = t["orders"], t["order_items"], t["order_payments"]
        ids = [t[f"{n}s"].selectExpr(f"{n}_id", f"{n}_id * 10 as {n}_key") for n in ("customer", "product", "seller")]
    keyed = keep(orders.join(ids[0], "customer_id", "left"), "orders")
    assert orderbook.is_unique(keyed)
    lines, paid = keep(orderbook.sold_lines(items, keyed, *ids[1:]), "lines"), keep(orderbook.paid_lines(payments, keyed), "paid")
    assert gathered(orderbook.build_fact_sales(lines)) == gathered(facts.build_fact_sales(items, orders, *ids, text_ties=True))
    assert gathered(orderbook.build_fact_payments(paid)) == gathered(facts.build_fact_payments(payments, orders, ids[0]))
    assert gathered(orderbook.sold_by_seller(lines)) == gathered(dims.seller_stats(items.where("seller_id is not null"), orders))
    known = "customer_id is not null"
    assert gathered(orderbook.paid_by_customer(paid).where(known)) == gathered(dims.customer_stats(orders, payments).where(known))
    whole = orderbook.build_fact_orders(orderbook.line_book(keyed, lines), None, None, unique=True)
    assert gathered(whole) == gathered(facts.build_fact_orders(orders, items, ids[0]))


def test_a_load_meets_items_and_orders_once(spark, monkeypatch):
    """Neither the sums per order nor the sales join items and orders a second time."""

    def again(*_, **__):
        raise AssertionError("items are joined again")

    monkeypatch.setattr(orderbook, "order_book", again)
    monkeypatch.setattr(facts, "build_fact_sales", again)
    monkeypatch.setattr(facts, "build_fact_payments", again)
    t = odd(spark)
    wh = bulk_load(spark, t, work_path(spark, "odd"), RUN)
    sales = {(int(r.order_id), r.order_item_id, r.is_first_purchase) for r in wh.read("fact_sales").collect()}
    # 10 comes before 9 as text; an order without a date has no sales
    assert sales == {(9, 1, False), (9, 2, False), (9, 3, False), (2, 2, False)}
    assert sorted(r.sale_key for r in wh.read("fact_sales").collect()) == [1, 2, 3, 4]
    sold = {int(r.seller_id): (r.total_sales, float(r.total_revenue)) for r in wh.read("dim_seller").collect()}
    assert sold == {5: (4, 20.0), 6: (5, 24.0)}
    assert sorted(r.payment_sequential for r in wh.read("fact_payments").collect()) == [1, 1, 1, 1, 2]


def test_an_id_on_two_orders_is_summed_once(spark):
    t = odd(spark)
    t["orders"] = t["orders"].unionByName(t["orders"].where("order_id = 9"))
    assert not orderbook.is_unique(t["orders"])
    wh = bulk_load(spark, t, work_path(spark, "odd"), RUN)
    nine = [(r.item_count, float(r.total_order_value), r.order_key is not None) for r in wh.read("fact_orders").where("order_id = '9'").collect()]
    assert nine == [(3, 8.0, True)]
    assert wh.read("fact_sales").where("order_id = '9'").count() == 6


def test_a_later_load_works_on_what_is_new(spark, monkeypatch):
    """Customers who had their events and reviews that are stored are left out before their rows are made."""
    t = odd(spark)
    wh = bulk_load(spark, t, work_path(spark, "odd"), RUN)
    events = {(r.customer_key, r.test_key, r.event_date_key, r.event_key) for r in wh.read("fact_ab_test_events").collect()}
    seen = {}
    spy = warehouse.exposure_events
    monkeypatch.setattr(warehouse, "exposure_events", lambda customers, *a, **k: seen.update(customers=customers.count()) or spy(customers, *a, **k))
    build = facts.build_fact_reviews
    monkeypatch.setattr(facts, "build_fact_reviews", lambda reviews, orders, items, *a, **k: seen.update(items=items.count()) or build(reviews, orders, items, *a, **k))
    more = t["customers"].where("customer_id = 7").withColumn("customer_id", F.lit(11).cast("long"))
    t["customers"] = t["customers"].unionByName(more)
    t["order_reviews"] = t["order_reviews"].unionByName(t["order_reviews"].withColumns({"review_id": F.lit(2).cast("long"), "order_id": F.lit(2).cast("long")}))
    load_batch(wh, t, dt.datetime(2020, 2, 1))
    assert seen == {"customers": 1, "items": 3}
    after = wh.read("fact_ab_test_events").collect()
    assert events < {(r.customer_key, r.test_key, r.event_date_key, r.event_key) for r in after} and len(after) == len(events) + 1
    assert sorted((r.review_id, r.review_key is not None) for r in wh.read("fact_reviews").collect()) == [("1", True)] * 3 + [("2", True)] * 3


def test_rows_that_are_all_new_are_not_stored_again(spark, monkeypatch):
    table = MonthlyTable(spark, work_path(spark, "sales"), "day")
    schema = "k long, order_id string, day int"
    table.merge(spark.createDataFrame([(None, "a", 20200105)], schema), ["order_id"], "k")
    kept = []
    monkeypatch.setattr(months, "keep", lambda df, label: kept.append(keep(df, label)) or kept[-1])
    table.merge(spark.createDataFrame([(None, "b", 20200106), (None, "c", 20200106), (None, None, 20200107)], schema), ["order_id"], "k")
    assert len(kept) == 1 and sorted(r.k for r in table.read().collect()) == [1, 2, 3, 4]
    table.merge(spark.createDataFrame([(None, "b", 20200106), (None, "d", 20200106)], schema), ["order_id"], "k")
    assert [df.count() for df in kept] == [3, 2, 1] and sorted(r.k for r in table.read().collect()) == [1, 2, 3, 4, 5]
    version = table.versions_by_month()
    table.merge(spark.createDataFrame([], schema), ["order_id"], "k")
    assert table.versions_by_month() == version


def test_nobody_new_makes_no_events(spark, monkeypatch):
    t = odd(spark)
    wh = bulk_load(spark, t, work_path(spark, "odd"), RUN)
    before = sorted(map(tuple, wh.read("fact_ab_test_events").collect()), key=str)
    monkeypatch.setattr(warehouse, "exposure_events", lambda *_, **__: pytest.fail("events of customers who have theirs"))
    load_batch(wh, t, dt.datetime(2020, 2, 1))
    assert before and sorted(map(tuple, wh.read("fact_ab_test_events").collect()), key=str) == before


def test_only_months_that_are_there_are_updated(spark, monkeypatch):
    """Rows of new months are not moved to be looked up in old ones."""
    table = MonthlyTable(spark, work_path(spark, "orders"), "day")
    schema = "k long, order_id string, day int, v int"
    table.merge(spark.createDataFrame([(None, "a", 20200105, 1), (None, "n", None, 1)], schema), ["order_id"], "k")
    sources = []
    upsert = months.merge_upsert
    monkeypatch.setattr(months, "merge_upsert", lambda old, known, *a, **k: sources.append(known) or upsert(old, known, *a, **k))
    table.merge(spark.createDataFrame([(None, "a", 20200105, 2), (None, "n", None, 2), (None, "b", 20200301, 2)], schema), ["order_id"], "k", updates=["v"])
    rows = {r.order_id: r for r in table.read().collect()}
    assert {o: r.v for o, r in rows.items()} == {"a": 2, "n": 2, "b": 2} and {rows["a"].k, rows["n"].k} == {1, 2} and rows["b"].k == 3
    assert "202001" in sources[0]._jdf.queryExecution().optimizedPlan().toString()
