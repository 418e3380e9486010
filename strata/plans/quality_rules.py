"""The quality rules of the landed tables. A rule's name says what it finds,
its response what the silver layer does about it; both are composed from the
rule's kind and columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import to_double, to_int, to_timestamp
from ..operators.quality import (Rule, duplicate_keys_rule, iqr_rule, missing_reference_rule, predicate_rule,
                                 surplus_rule)
from .silver import MIN_INSTALLMENTS, REVIEW_SCORE_RANGE, UNKNOWN_CATEGORY
from .specs import SILVER

# Bounding box of valid coordinates (latitude, longitude).
LAT_RANGE = (-34, 6)
LNG_RANGE = (-74, -34)
GEOLOCATION = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
               "geolocation_state")
KEEP = "kept"
UNUSED = "not read further"


def _outside_box() -> Column:
    return ~(to_double("geolocation_lat").between(*LAT_RANGE) & to_double("geolocation_lng").between(*LNG_RANGE))


def _repeats(table: str) -> Rule:
    key = SILVER[table].key
    return surplus_rule("uniqueness", table, f"surplus rows by {' + '.join(key)}", key, "one row per key")


def _finding(dimension: str, table: str, finding: str, test: Callable[[], Column], response: str) -> Rule:
    """Tests are built when needed, so rules can be listed without a session."""
    return predicate_rule(dimension, table, finding, test, response)


def _fence(column: str) -> Rule:
    return iqr_rule("outliers", "order_items", f"{column} beyond the upper fence", column, KEEP)


def landing_rules() -> list[Rule]:
    c = F.col
    low, high = REVIEW_SCORE_RANGE
    return [
        _repeats("orders"), _repeats("customers"), _repeats("products"), _repeats("sellers"), _repeats("order_items"),
        duplicate_keys_rule("uniqueness", "order_reviews", "order_id with several reviews", ["order_id"],
                            "newest valid review"),
        surplus_rule("uniqueness", "geolocation", "surplus rows by all columns", GEOLOCATION, UNUSED),
        _finding("completeness", "orders", "delivered, order_delivered_customer_date absent",
                 lambda: (c("order_status") == "delivered") & c("order_delivered_customer_date").isNull(),
                 "no delivery measures"),
        _finding("completeness", "products", "product_category_name absent", lambda: c("product_category_name").isNull(),
                 f"set to {UNKNOWN_CATEGORY}"),
        _finding("completeness", "order_reviews", "review_comment_message absent",
                 lambda: c("review_comment_message").isNull(), KEEP),
        _finding("consistency", "orders", "order_purchase_timestamp unreadable",
                 lambda: c("order_purchase_timestamp").isNotNull() & to_timestamp("order_purchase_timestamp").isNull(),
                 "set to NULL"),
        _finding("consistency", "orders", "order_delivered_customer_date before order_purchase_timestamp",
                 lambda: to_timestamp("order_delivered_customer_date") < to_timestamp("order_purchase_timestamp"),
                 "set to NULL"),
        _finding("consistency", "customers", "customer_zip_code_prefix not of length 5",
                 lambda: F.length(F.trim(c("customer_zip_code_prefix"))) != 5, "padded with zeros"),
        missing_reference_rule("consistency", "products", "product_category_name not in category_translation",
                               "product_category_name", "category_translation", "product_category_name", "original name"),
        _finding("accuracy", "order_items", "price is 0 or less", lambda: to_double("price") <= 0, KEEP),
        _finding("accuracy", "order_items", "freight_value below 0", lambda: to_double("freight_value") < 0, KEEP),
        _finding("accuracy", "order_reviews", f"review_score not within {low} to {high}",
                 lambda: ~F.coalesce(to_int("review_score"), F.lit(0)).between(low, high), "row dropped"),
        _finding("accuracy", "order_payments", "payment_installments is 0", lambda: to_int("payment_installments") == 0,
                 f"raised to {MIN_INSTALLMENTS}"),
        _finding("accuracy", "order_payments", "payment_type is not_defined",
                 lambda: c("payment_type") == "not_defined", "left out of reports"),
        _finding("accuracy", "products", "product_weight_g is 0", lambda: to_double("product_weight_g") == 0,
                 "set to NULL"),
        _finding("accuracy", "geolocation", "coordinates outside the box", _outside_box, UNUSED),
        _fence("price"), _fence("freight_value"),
    ]
