"""Business rules as Column builders.  Limits are parameters with the usual values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def customer_segment(n: Column, spent: Column, vip_above: float = 1000) -> Column:
    """Segment by number of order payments, then by spend.

    The order of the branches is part of the rule: two to five payments are
    'returning' whatever was spent.  A customer without orders has a NULL count
    and comes out 'regular', so do not replace the NULL first.
    """
    return (
        F.when(n == 1, "new")
        .when(n.between(2, 5), "returning")
        .when(spent > vip_above, "vip")
        .otherwise("regular")
    )


def seller_segment(n: Column) -> Column:
    """A seller without sales (NULL count) falls through to 'large'."""
    return F.when(n < 10, "small").when(n.between(10, 100), "medium").otherwise("large")


def product_flags(weight: Column, l: Column, h: Column, w: Column) -> dict[str, Column]:  # noqa: E741
    """NULL measures give NULL flags."""
    return {"is_heavy_item": weight > 1000, "is_large_item": (l * h * w) > 10000}


def payment_flags(installments: Column, kind: Column) -> dict[str, Column]:
    return {
        "is_installment_payment": installments > 1,
        "is_credit_card": kind == "credit_card",
    }


def review_flags(message: Column) -> dict[str, Column]:
    return {
        "has_comment": message.isNotNull() & (F.length(message) > 0),
        "comment_length": F.coalesce(F.length(message), F.lit(0)),
    }


def line_total(price: Column, freight: Column) -> Column:
    return (price + freight).cast("decimal(12,2)")
