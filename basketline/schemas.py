"""Declared tables: column types, keys and text widths.

Counts in the summary layer are ``bigint`` and amounts ``decimal(18,2)``: narrower
types overflow for a best-selling product once the facts reach billions of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "date": DateType(),
    "timestamp_ntz": TimestampNTZType(), "decimal(10,2)": DecimalType(10, 2), "decimal(12,2)": DecimalType(12, 2),
    "decimal(18,2)": DecimalType(18, 2),
}

_DDL = {
    "ods_users": "user_id string, username string, gender string, age int, city string, "
                 "phone string, level string, register_date date",
    "ods_products": "product_id string, product_name string, category string, sub_category string, "
                    "price decimal(10,2), brand string, stock int, on_shelf_date date",
    "ods_orders": "order_id string, user_id string, total_amount decimal(12,2), status string, "
                  "item_count int, create_time timestamp_ntz, pay_time timestamp_ntz",
    "ods_order_items": "order_id string, product_id string, quantity int, unit_price decimal(10,2), "
                       "amount decimal(12,2)",
    "dwd_orders": "order_id string, user_id string, username string, age int, city string, "
                  "user_level string, total_amount decimal(12,2), item_count int, status string, "
                  "create_time timestamp_ntz, pay_time timestamp_ntz, order_date date, order_hour int, "
                  "order_weekday int, is_valid_order int, is_first_order int, pay_latency_min int",
    "dwd_order_items": "order_id string, product_id string, quantity int, unit_price decimal(10,2), "
                       "amount decimal(12,2), product_name string, category string, "
                       "sub_category string, brand string, user_id string, "
                       "order_time timestamp_ntz, is_valid_order int",
    "dws_user_summary": "user_id string, username string, city string, user_level string, "
                        "total_orders bigint, valid_orders bigint, total_quantity bigint, "
                        "total_amount decimal(18,2), first_order_date date, last_order_date date, "
                        "days_since_last int, active_days bigint, avg_order_amount decimal(18,2), "
                        "avg_days_between decimal(10,2), r_score int, f_score int, m_score int, "
                        "rfm_score string, rfm_segment string, favorite_category string, "
                        "favorite_category_amount decimal(18,2), is_repurchase int",
    "dws_product_summary": "product_id string, product_name string, category string, "
                           "sub_category string, brand string, price decimal(10,2), "
                           "total_quantity bigint, total_orders bigint, total_users bigint, "
                           "total_amount decimal(18,2), first_sale_date date, last_sale_date date, "
                           "avg_quantity_per_order decimal(10,2), avg_user_quantity decimal(18,2), "
                           "category_rank bigint",
    "dws_date_summary": "date date, dau bigint, new_users bigint, repurchase_users bigint, "
                        "total_active_users bigint, total_orders bigint, valid_orders bigint, "
                        "total_amount decimal(18,2), avg_order_value decimal(18,2), "
                        "avg_user_amount decimal(18,2), year int, month int, weekday int",
}


def _struct(columns: str) -> StructType:
    """Schema of a "name type, name type" text, without needing a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in map(str.split, columns.split(", "))])


SCHEMAS: dict[str, StructType] = {name: _struct(columns) for name, columns in _DDL.items()}

PRIMARY_KEYS: dict[str, list[str]] = {
    "ods_users": ["user_id"],
    "ods_products": ["product_id"],
    "ods_orders": ["order_id"],
    "ods_order_items": ["order_id", "product_id"],
    "dwd_orders": ["order_id"],
    "dwd_order_items": ["order_id", "product_id"],
    "dws_user_summary": ["user_id"],
    "dws_product_summary": ["product_id"],
    "dws_date_summary": ["date"],
}

# Declared text widths of the raw tables.
TEXT_WIDTHS: dict[str, dict[str, int]] = {
    "ods_users": {"user_id": 20, "username": 100, "gender": 2, "city": 50, "phone": 20, "level": 20},
    "ods_products": {"product_id": 20, "product_name": 255, "category": 50, "sub_category": 50,
                     "brand": 100},
    "ods_orders": {"order_id": 20, "user_id": 20, "status": 20},
    "ods_order_items": {"order_id": 20, "product_id": 20},
}


def conform(df: DataFrame, schema: StructType | str, lenient: bool = False) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    Decimals round half up to the declared scale. A value that does not fit raises
    under ANSI mode; ``lenient`` turns it into NULL instead.
    """
    schema = SCHEMAS[schema] if isinstance(schema, str) else schema
    types = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        column, target = F.col(field.name), field.dataType.simpleString()
        if types[field.name] != target:
            column = column.try_cast(target) if lenient else column.cast(target)
        columns.append(column.alias(field.name))
    return df.select(columns)
