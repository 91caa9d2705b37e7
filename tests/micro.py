"""A hand-made shop with ties, orphans, missing values and days that touch midnight."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from basketline.schemas import SCHEMAS

AS_OF = dt.date(2026, 3, 1)


def at(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


USERS = [
    ("U1", "ann", "F", 30, "X", "11", "Gold", dt.date(2025, 1, 1)),
    ("U2", "bob", "M", 40, "Y", "12", "Silver", dt.date(2025, 1, 2)),
    ("U3", "cy", "M", 50, "X", "13", "Bronze", dt.date(2025, 1, 3)),
]
PRODUCTS = [
    ("P1", "one", "A", "A-1", D("30.00"), "b1", 5, dt.date(2025, 1, 1)),
    ("P2", "two", "B", "B-1", D("40.00"), "b2", 5, dt.date(2025, 1, 1)),
]
ORDERS = [
    ("O1", "U1", D("100.00"), "paid", 2, at("2026-01-01 10:00:00"), at("2026-01-01 10:05:59")),
    ("O2", "U1", D("50.00"), "cancelled", 1, at("2026-01-01 10:00:00"), None),
    ("O3", "U1", D("30.00"), "received", 0, at("2026-01-02 23:59:59"), at("2026-01-03 00:00:00")),
    ("O4", "U1", D("20.00"), "shipped", 1, at("2026-01-03 00:00:01"), at("2026-01-03 00:10:01")),
    ("O5", "U2", D("70.00"), "refunded", 0, at("2026-01-05 08:00:00"), at("2026-01-05 08:01:00")),
    ("O6", "U9", D("10.00"), "paid", 1, at("2026-01-11 12:00:00"), at("2026-01-11 12:30:00")),
]
ITEMS = [
    ("O1", "P1", 2, D("30.00"), D("60.00")),
    ("O1", "P2", 1, D("40.00"), D("40.00")),
    ("O2", "P2", 5, D("10.00"), D("50.00")),
    ("O4", "P1", 1, D("20.00"), D("20.00")),
    ("O6", "P9", 1, D("10.00"), D("10.00")),
]


def raw_tables(spark, users=USERS, products=PRODUCTS, orders=ORDERS, items=ITEMS) -> dict:
    rows = {"ods_users": users, "ods_products": products, "ods_orders": orders, "ods_order_items": items}
    return {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in rows.items()}


def rows(df, *columns) -> list[tuple]:
    """All rows, sorted, as tuples; NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
