"""Specifications of the retail tables.

A field says what a column is: where it comes from, how it is read and what it
means. The silver and gold builders, the data dictionary and the landing
headers all follow from these lists.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (clean_text, date_key, days_between, late_flag, lower_text, map_lookup, pad_code,
                                 to_decimal, to_int, to_timestamp, upper_text)
from ..operators.domains import (ANYTHING, Domain, above, at_least, between, key_of, like, one_of,
                                 with_members)

#: readers of landed text, by kind of field
READERS = {"text": clean_text, "lower": lower_text, "upper": upper_text, "code": pad_code, "int": to_int,
           "amount": to_decimal, "time": to_timestamp}
READ_AS = {"text": "trimmed text", "lower": "trimmed lower-case text", "upper": "trimmed upper-case text",
           "code": "zero-padded code", "int": "whole number", "amount": "amount with two decimals",
           "time": "date and time"}


@dataclass(frozen=True)
class Field:
    """A silver column, read from the landed column ``landed`` (its own name
    where not given) by the reader of its ``kind``."""
    name: str
    kind: str
    landed: str | None = None

    @property
    def header(self) -> str:
        return self.landed or self.name


@dataclass(frozen=True)
class Typed:
    """A silver table: its fields and the key that identifies a row; rows
    without a key stay unless ``keyed``."""
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    keyed: bool = False

    def read(self, landed: DataFrame) -> DataFrame:
        return landed.select(*[READERS[f.kind](f.header).alias(f.name) for f in self.fields])


# The columns of the landed files, in their order, and how each is read.
SILVER = {
    "customers": Typed(("customer_id",), (
        Field("customer_id", "text"),
        Field("customer_unique_id", "text"),
        Field("customer_zip_code_prefix", "code"),
        Field("customer_city", "lower"),
        Field("customer_state", "upper"),
    ), keyed=True),
    "sellers": Typed(("seller_id",), (
        Field("seller_id", "text"),
        Field("seller_zip_code_prefix", "code"),
        Field("seller_city", "lower"),
        Field("seller_state", "upper"),
    ), keyed=True),
    "orders": Typed(("order_id",), (
        Field("order_id", "text"),
        Field("customer_id", "text"),
        Field("order_status", "lower"),
        Field("order_purchase_timestamp", "time"),
        Field("order_approved_at", "time"),
        Field("order_delivered_carrier_date", "time"),
        Field("order_delivered_customer_date", "time"),
        Field("order_estimated_delivery_date", "time"),
    ), keyed=True),
    "order_items": Typed(("order_id", "order_item_id"), (
        Field("order_id", "text"),
        Field("order_item_id", "int"),
        Field("product_id", "text"),
        Field("seller_id", "text"),
        Field("shipping_limit_date", "time"),
        Field("price", "amount"),
        Field("freight_value", "amount"),
    )),
    "order_payments": Typed(("order_id", "payment_sequential"), (
        Field("order_id", "text"),
        Field("payment_sequential", "int"),
        Field("payment_type", "lower"),
        Field("payment_installments", "int"),
        Field("payment_value", "amount"),
    )),
    "order_reviews": Typed(("order_id",), (
        Field("review_id", "text"),
        Field("order_id", "text"),
        Field("review_score", "int"),
        Field("review_creation_date", "time"),
        Field("review_answer_timestamp", "time"),
    )),
    "category_translation": Typed(("product_category_name",), (
        Field("product_category_name", "lower"),
        Field("product_category_name_english", "lower"),
    )),
    "products": Typed(("product_id",), (
        Field("product_id", "text"),
        Field("product_category_name", "lower"),
        Field("product_name_length", "int", landed="product_name_lenght"),
        Field("product_description_length", "int", landed="product_description_lenght"),
        Field("product_photos_qty", "int"),
        Field("product_weight_g", "int"),
        Field("product_length_cm", "int"),
        Field("product_height_cm", "int"),
        Field("product_width_cm", "int"),
    ), keyed=True),
}


@dataclass(frozen=True)
class Derived:
    """A gold column: ``how`` applied to the silver columns ``of``."""
    name: str
    how: str
    of: tuple[str, ...]
    about: str
    domain: Domain = ANYTHING


_HOW = {
    "same": lambda c: F.col(c),
    "day key": date_key,
    "days from": lambda start, end: days_between(end, start),
    "sum": lambda a, b: F.col(a) + F.col(b),
    "late": lambda actual, promised: late_flag(days_between(actual, promised)),
}


def derive(df: DataFrame, fields: tuple[Derived, ...], region_map=None) -> DataFrame:
    def column(f: Derived) -> Column:
        return map_lookup(f.of[0], region_map) if f.how == "region" else _HOW[f.how](*f.of)
    return df.select(*[column(f).alias(f.name) for f in fields])


def _place(of: str) -> tuple[Derived, ...]:
    return (Derived("zip_prefix", "same", (f"{of}_zip_code_prefix",), "leading five digits of the postal code",
                    like("^[0-9]{5}$")),
            Derived("city", "same", (f"{of}_city",), "city"),
            Derived("state", "same", (f"{of}_state",), "state code"),
            Derived("region", "region", (f"{of}_state",), f"region of the {of}'s state, empty for an unlisted state"))


def _cm(*sides: str) -> tuple[Derived, ...]:
    return tuple(Derived(f"{s}_cm", "same", (f"product_{s}_cm",), f"package {s} in centimetres", above(0)) for s in sides)


# Fixed values of the retail model.
ORDER_STATES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

_WHEN = Derived("purchase_date_key", "day key", ("order_purchase_timestamp",), "day of purchase",
                key_of("dim_date", "date_key"))

#: gold table -> (what a row is, the silver tables it is made from, its fields)
GOLD: dict[str, tuple[str, tuple[str, ...], tuple[Derived, ...]]] = {
    "dim_customer": ("a customer as named by one order", ("customers",), (
        Derived("customer_id", "same", ("customer_id",), "key", ANYTHING.needed()),
        Derived("customer_unique_id", "same", ("customer_unique_id",), "the person, who may stand behind several keys"),
        *_place("customer"))),
    "dim_seller": ("a seller", ("sellers",), (
        Derived("seller_id", "same", ("seller_id",), "key", ANYTHING.needed()), *_place("seller"))),
    "dim_product": ("a product", ("products", "category_translation"), (
        Derived("product_id", "same", ("product_id",), "key", ANYTHING.needed()),
        Derived("category", "same", ("product_category_name",), "category, never empty", ANYTHING.needed()),
        Derived("category_en", "same", ("product_category_name_english",), "category in English, as landed where untranslated"),
        Derived("photos_qty", "same", ("product_photos_qty",), "photos in the listing", at_least(1)),
        Derived("weight_g", "same", ("product_weight_g",), "weight in grams, empty where not positive",
                above(0)),
        *_cm("length", "height", "width"))),
    "fact_order_items": ("an item of an order", ("order_items", "orders", "order_reviews"), (
        Derived("order_id", "same", ("order_id",), "key, with item_id", ANYTHING.needed()),
        Derived("item_id", "same", ("order_item_id",), "key, with order_id", at_least(1).needed()),
        _WHEN,
        Derived("customer_id", "same", ("customer_id",), "who bought", key_of("dim_customer", "customer_id").needed()),
        Derived("product_id", "same", ("product_id",), "what was sold", key_of("dim_product", "product_id").needed()),
        Derived("seller_id", "same", ("seller_id",), "who sold it", key_of("dim_seller", "seller_id").needed()),
        Derived("item_price", "same", ("price",), "price of the item", above(0).needed()),
        Derived("freight_value", "same", ("freight_value",), "freight of the item", at_least(0).needed()),
        Derived("item_total", "sum", ("price", "freight_value"), "price and freight"),
        Derived("order_status", "same", ("order_status",), "state the order is in", one_of(*ORDER_STATES)),
        Derived("review_score", "same", ("review_score",), "score of the order's newest valid review", between(1, 5)),
        Derived("purchased_at", "same", ("order_purchase_timestamp",), "moment of purchase"),
        Derived("estimated_at", "same", ("order_estimated_delivery_date",), "delivery as promised"),
        Derived("delivered_at", "same", ("order_delivered_customer_date",), "delivery as made, empty if before the purchase"),
        Derived("lead_time_days", "days from", ("order_purchase_timestamp", "order_delivered_customer_date"),
                "days the customer waited", at_least(0)),
        Derived("delay_days", "days from", ("order_estimated_delivery_date", "order_delivered_customer_date"),
                "days past the promise, below zero when early"),
        Derived("is_late", "late", ("order_delivered_customer_date", "order_estimated_delivery_date"),
                "whether it came after the promised day"))),
    "fact_payments": ("a payment towards an order", ("order_payments", "orders"), (
        Derived("order_id", "same", ("order_id",), "key, with payment_seq", ANYTHING.needed()),
        Derived("payment_seq", "same", ("payment_sequential",), "key, with order_id", at_least(1).needed()),
        _WHEN,
        Derived("customer_id", "same", ("customer_id",), "who bought", key_of("dim_customer", "customer_id").needed()),
        Derived("payment_type", "same", ("payment_type",), "means of payment", one_of(*PAYMENT_TYPES)),
        Derived("installments", "same", ("payment_installments",), "instalments", at_least(1)),
        Derived("payment_value", "same", ("payment_value",), "amount", at_least(0)))),
}

#: the calendar has no landed source; its fields by meaning, and their domains
CALENDAR = {"date_key": "key, year month day as one number", "date": "the day", "year_month": "month for series",
            "year": "calendar year", "month": "month number", "quarter": "quarter number",
            "weekday": "day of the week, Sunday is 1", "is_weekend": "whether Saturday or Sunday"}
CALENDAR_DOMAINS = {"date_key": ANYTHING.needed(), "month": between(1, 12), "quarter": between(1, 4), "weekday": between(1, 7)}


def gold_domains(region_map: Mapping[str, str]) -> dict[str, dict[str, Domain]]:
    """The domains of the gold columns; states and regions are those of the
    region map."""
    out = {t: {f.name: f.domain for f in fields if f.domain != ANYTHING} for t, (_, _, fields) in GOLD.items()}
    out["dim_date"] = dict(CALENDAR_DOMAINS)
    places = ("dim_customer", "dim_seller")
    out = with_members(out, [(t, "state") for t in places], sorted(region_map))
    return with_members(out, [(t, "region") for t in places], sorted(set(region_map.values())))
