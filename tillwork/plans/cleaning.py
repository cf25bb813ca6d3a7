"""Raw operational files to typed, stored operational tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tillwork.catalog import OPERATIONAL
from tillwork.operators.relational import cast_strict, coerce_numeric, parse_timestamps, rename
from tillwork.sources.files import scan_table, sink_overwrite

# Two column names arrive misspelt.
MISSPELT = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
# A column without a name in the raw file is a leftover row number.
UNNAMED = ("_c0", "Unnamed: 0")

PRODUCT_NUMBERS = [
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
ORDER_TIMES = [f.name for f in OPERATIONAL["orders"].fields if f.name.startswith("order_") and
               f.dataType.typeName() == "timestamp_ntz"]


def clean_order_items(raw: DataFrame) -> DataFrame:
    typed = cast_strict(
        raw, {"order_item_id": "int", "price": "decimal(12,2)", "freight_value": "decimal(12,2)"}
    )
    return parse_timestamps(typed, ["shipping_limit_date"])


def clean_order_payments(raw: DataFrame) -> DataFrame:
    return cast_strict(
        raw,
        {"payment_sequential": "int", "payment_installments": "int", "payment_value": "decimal(12,2)"},
    )


def clean_order_reviews(raw: DataFrame) -> DataFrame:
    return parse_timestamps(cast_strict(raw, {"review_score": "int"}), ["review_creation_date"])


def clean_orders(raw: DataFrame) -> DataFrame:
    return parse_timestamps(raw, ORDER_TIMES)


def clean_products(raw: DataFrame) -> DataFrame:
    """Names put right; measures that are not numbers become NULL."""
    return coerce_numeric(rename(raw, MISSPELT), PRODUCT_NUMBERS)


CLEANERS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "order_reviews": clean_order_reviews,
    "orders": clean_orders,
    "products": clean_products,
}


BAD_LINE = "_bad_line"


def _read_lines(spark: SparkSession, path: str, free_text: bool) -> DataFrame:
    """A header CSV as text columns, with the whole line in ``BAD_LINE`` where its fields don't fit the header."""

    def reader() -> DataFrameReader:
        return spark.read.option("header", True).option("escape", '"').option("multiLine", free_text)

    names = reader().csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in [*names, BAD_LINE])
    return reader().schema(schema).option("columnNameOfCorruptRecord", BAD_LINE).csv(path)


def read_raw(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame:
    """The lines that fit the header, as text columns: the cleaners set the types, nothing is inferred.

    Lines with too many or too few fields are in ``read_rejected``.
    """
    lines = _read_lines(spark, path, free_text)
    return lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, *UNNAMED)


def read_rejected(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame:
    """The lines that don't fit the header, with the fields that could be read."""
    return _read_lines(spark, path, free_text).where(F.col(BAD_LINE).isNotNull())


def load_operational(spark: SparkSession, files: Mapping[str, str], out: str) -> dict[str, DataFrame]:
    """Clean every file named in ``files`` (table -> path) and store it below ``out``.

    Tables are replaced whole.  A table without a cleaner is stored as text.
    Lines that don't fit the header are stored below ``out/rejected``, also
    when there are none, so that their number can be checked.
    """
    tables = {}
    for name, path in files.items():
        free_text = name == "order_reviews"
        raw = read_raw(spark, path, free_text)
        target = f"{out.rstrip('/')}/{name}"
        sink_overwrite(CLEANERS.get(name, lambda df: df)(raw), target)
        sink_overwrite(read_rejected(spark, path, free_text), f"{out.rstrip('/')}/rejected/{name}")
        tables[name] = scan_table(spark, target)
    return tables


def missing_category(products: DataFrame) -> DataFrame:
    """Products without a category, by how often each id occurs."""
    lacking = products.where(F.col("product_category_name").isNull())
    return lacking.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "product_id")
