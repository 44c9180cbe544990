"""Stock extract and stock records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.functions.choose import flag_bool, null_default, stock_labels
from outledger.functions.numeric import trunc_int
from outledger.operators.filters import above
from outledger.operators.joins import where_exists
from outledger.plans.items import Tables, sellable_items
from outledger.rules import Rules

_c = F.col


def _columns(colour: Column, size: Column) -> list[Column]:
    highlight, message = stock_labels(_c("MinLevel"), _c("OnHand"))
    return [
        _c("DocEntry").alias("ProductMappingId"),
        _c("ItemCode").alias("ProductCode"),
        colour.alias("ColorCode"),
        _c("U_SubGrp7").alias("AttributeValue"),
        _c("U_SubGrp4").alias("StyleCode"),
        size.alias("Size"),
        trunc_int(_c("OnHand")).alias("StockQuantity"),
        F.lit("Stock").alias("Type"),
        flag_bool(_c("validFor")).alias("IsActive"),
        highlight.alias("StockHighlightMessageDetails"),
        message.alias("StockMessage"),
    ]


def warehouse_stock(t: Tables, rules: Rules) -> DataFrame:
    """On-hand quantities of the delivering warehouse."""
    return t["stock"].filter(_c("WhsCode") == rules.warehouse).select("ItemCode", "OnHand")


def stock_rows(t: Tables, rules: Rules) -> DataFrame:
    """Sellable items with at least one whole unit in the warehouse."""
    on_hand = above(warehouse_stock(t, rules), "OnHand", 0, cast="int")
    joined = sellable_items(t, rules).join(on_hand, "ItemCode")
    return joined.select(
        *_columns(null_default(_c("U_SubGrp6"), _c("U_SubGrp11")), F.rtrim("U_SubGrp5"))
    )


def stock_rows_by_key(t: Tables, rules: Rules, keys: DataFrame) -> DataFrame:
    """Wanted items: other colour and size columns, no exclusions, empty stock included."""
    wanted = where_exists(
        t["items"].filter("validFor = 'Y'"),
        keys.select(_c("record_key").alias("ItemCode")),
        "ItemCode",
    )
    joined = wanted.join(warehouse_stock(t, rules), "ItemCode")
    return joined.select(*_columns(_c("U_SubGrp13"), _c("U_Size")))


def stock_records(rows: DataFrame) -> DataFrame:
    """Flat typed outgoing records."""
    return rows.select(
        _c("ProductMappingId").cast("string").alias("ProductMappingId"),
        "ProductCode",
        "ColorCode",
        "AttributeValue",
        "StyleCode",
        "Size",
        _c("StockQuantity").cast("double").alias("StockQuantity"),
        "Type",
        F.coalesce("IsActive", F.lit(False)).alias("IsActive"),
        "StockHighlightMessageDetails",
        "StockMessage",
    )
