import datetime as dt
import os
from decimal import Decimal

import pytest

from tillwork import session
from tillwork.plans import cleaning


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_raw_files_become_typed_tables(spark, tmp_path):
    files = {
        "order_items": write(tmp_path, "items.csv",
            ",order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
            "0,o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\n"),
        "products": write(tmp_path, "products.csv",
            "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
            "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
            "p1,perfumaria,40,287,1,225,16,10,14\np2,,x,,1,abc,1,1,1\n"),
        "orders": write(tmp_path, "orders.csv",
            "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
            "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
            "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,,,2017-10-18 00:00:00\n"),
        "order_payments": write(tmp_path, "payments.csv",
            "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,voucher,2,72.19\n"),
        "geolocation": write(tmp_path, "geo.csv", "zip,lat\n01037,-23.5\n"),
    }
    t = cleaning.load_operational(spark, files, str(tmp_path / "out"))
    item = t["order_items"].first()
    assert "_c0" not in t["order_items"].columns
    assert (item.price, item.order_item_id, item.shipping_limit_date) == (
        Decimal("58.90"), 1, dt.datetime(2017, 9, 19, 9, 45, 35),
    )
    products = {r.product_id: r for r in t["products"].collect()}
    assert (products["p1"].product_name_length, products["p1"].product_weight_g) == (40.0, 225.0)
    assert (products["p2"].product_name_length, products["p2"].product_weight_g) == (None, None)
    assert [tuple(r) for r in cleaning.missing_category(t["products"]).collect()] == [("p2", 1)]
    order = t["orders"].first()
    assert (order.order_approved_at, order.order_delivered_customer_date) == (dt.datetime(2017, 10, 2, 11, 7, 15), None)
    assert t["order_payments"].first().payment_installments == 2
    assert t["geolocation"].first().zip == "01037"


def test_lines_that_do_not_fit_the_header_are_kept_aside(spark, tmp_path):
    path = write(tmp_path, "bad.csv", "a,b\n1,2\n3,4,5\n6\n7,\n")
    assert sorted((r.a, r.b) for r in cleaning.read_raw(spark, path).collect()) == [("1", "2"), ("7", None)]
    assert sorted(r[cleaning.BAD_LINE] for r in cleaning.read_rejected(spark, path).collect()) == ["3,4,5", "6"]
    out = str(tmp_path / "out")
    assert cleaning.load_operational(spark, {"geolocation": path}, out)["geolocation"].count() == 2
    assert spark.read.parquet(f"{out}/rejected/geolocation").count() == 2


class FakeSession:
    """Just enough of a session to ask for its folders."""

    def __init__(self, master, named=None):
        self.conf = self.sparkContext = self
        self.master, self.named, self.checkpoints = master, named, None

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, path):
        self.checkpoints = path


def test_shared_folder_is_the_one_the_cluster_names():
    cluster = FakeSession("yarn", "hdfs:///shared/work/")
    assert session.shared_folder(cluster) == "hdfs:///shared/work"
    assert cluster.checkpoints == "hdfs:///shared/work/"
    assert session.work_path(cluster, "x").startswith("hdfs:///shared/work/work/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))
