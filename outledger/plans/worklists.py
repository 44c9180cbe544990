"""Filtered, paged worklists: a base per dataset, its delivery state, and the page."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import PUNCH_STATUSES
from outledger.functions.choose import classify_like, flag, null_default
from outledger.functions.dates import date_text, moment
from outledger.functions.text import clean_grade, first_phone
from outledger.operators.aggregates import sum_whole
from outledger.operators.filters import FilterSpec, contained, exclude_values
from outledger.operators.joins import first_per_key, where_exists
from outledger.operators.paging import overlay_status, worklist
from outledger.plans.items import Tables, priced_items, sellable_items
from outledger.plans.partners import active_partners, category
from outledger.plans.receivables import receivable_summary
from outledger.plans.stock import warehouse_stock
from outledger.rules import Rules

_c = F.col


def item_base(t: Tables, rules: Rules) -> DataFrame:
    """Sellable items with a positive item-book price."""
    items = where_exists(sellable_items(t, rules), t["item_groups"], "ItmsGrpCod")
    return where_exists(items, priced_items(t), "ItemCode").select(
        _c("ItemCode").alias("ProductCode"),
        _c("ItemName").alias("ProductName"),
        flag(_c("validFor")).alias("ProductIsActive"),
        _c("U_SubGrp7").alias("ProductGroupCode"),
        _c("U_SubGrp1").alias("Brand"),
        _c("U_SubGrp3").alias("CategoryName"),
        _c("U_SubGrp4").alias("StyleCode"),
        F.rtrim("U_SubGrp5").alias("SizeCode"),
        F.rtrim("U_SubGrp6").alias("ColorCode"),
        null_default(_c("U_SubGrp11"), _c("U_SubGrp6")).alias("ColorName"),
        _c("SalPackMsr").alias("UOM"),
        _c("U_HSNCODE").alias("HSNCode"),
        _c("U_taxrate").alias("TaxBelow"),
        _c("U_taxrate1000").alias("TaxAbove"),
        classify_like(_c("U_SubGrp1"), rules.division_patterns).alias("DivisionCode"),
    )


def price_base(t: Tables, rules: Rules) -> DataFrame:
    """Price summary per item and brand, prices met with lines on the document alone.

    Every price counts once per line of its document. Prices are reduced to states
    and lines to brands before they meet, and the counts are multiplied, so a
    document with many of both never forms the pairs.
    """
    prices = (
        t["item_book_prices"]
        .filter("U_SelPrice > 0")
        .groupBy("DocEntry", "U_State")
        .agg(
            F.count("*").alias("prices"),
            F.min("U_SelPrice").alias("low"),
            F.max("U_SelPrice").alias("high"),
        )
    )
    lines = (
        exclude_values(t["item_book_lines"], "U_Brand", rules.excluded_brands, trimmed=True)
        .groupBy("DocEntry", _c("U_Brand").alias("Brand"))
        .agg(F.count("*").alias("lines"))
    )
    books = t["item_books"].select("DocEntry", _c("U_ItemCode").alias("ProductCode"))
    summary = (
        prices.join(lines, "DocEntry")
        .join(books, "DocEntry")
        .groupBy("ProductCode", "Brand")
        .agg(
            F.sum(_c("prices") * _c("lines")).alias("price_entries"),
            F.count_distinct("U_State").alias("state_count"),
            F.min("low").alias("min_price"),
            F.max("high").alias("max_price"),
        )
    )
    items = t["items"].select(
        _c("ItemCode").alias("ProductCode"),
        _c("ItemName").alias("ProductName"),
        _c("U_SubGrp7").alias("ProductGroupCode"),
    )
    return items.join(summary, "ProductCode")


def partner_base(t: Tables, rules: Rules) -> DataFrame:
    """Active partners with phone and the city of their first billing address."""
    rows = first_per_key(
        active_partners(t, rules).drop("City"),
        t["addresses"].filter("AdresType = 'B'"),
        ["CardCode"],
        ["LineNum", "Address"],
        ["City"],
    )
    return rows.select(
        _c("CardCode").alias("BPCode"),
        _c("CardName").alias("BPName"),
        category(rules).alias("BPCategory"),
        _c("U_AreaCode").alias("AreaCode"),
        clean_grade(_c("U_Grade")).alias("GradeOfBP"),
        null_default(_c("U_GSTIN"), F.lit("")).alias("GSTNo"),
        first_phone(_c("Phone1"), _c("Phone2"), default="").alias("Phone1"),
        "City",
    )


def listed_schemes(t: Tables, rules: Rules) -> DataFrame:
    """Schemes whose validity lies inside the listed window."""
    low, high = moment(rules.scheme_list_from), moment(rules.scheme_list_to)
    return contained(t["schemes"], "U_FrmDt", "U_ToDt", low, high)


def scheme_base(t: Tables, rules: Rules) -> DataFrame:
    """Schemes inside the listed window with what their lines say."""
    listed = listed_schemes(t, rules)
    lines = where_exists(t["scheme_lines"], listed, "DocEntry").groupBy("DocEntry").agg(
        F.max(classify_like(_c("U_bran"), rules.division_patterns)).alias("DivisionCode"),
        F.max("U_Discunt").alias("DiscountBasis"),
        F.count_distinct("LineId").alias("LineCount"),
    )
    return listed.join(lines, "DocEntry").select(
        "DocEntry",
        F.concat_ws("", "Object", _c("DocNum").cast("string")).alias("PolicyNumber"),
        _c("Remark").alias("PolicyName"),
        "DivisionCode",
        "DiscountBasis",
        date_text(_c("U_FrmDt")).alias("FromDate"),
        date_text(_c("U_ToDt")).alias("ToDate"),
        "LineCount",
    )


def stock_base(t: Tables, rules: Rules) -> DataFrame:
    """Whole units in the warehouse per active item."""
    units = sum_whole(warehouse_stock(t, rules), ["ItemCode"], "OnHand", "StockQuantity")
    return t["items"].filter("validFor = 'Y'").join(units, "ItemCode").select(
        _c("ItemCode").alias("ProductCode"),
        _c("ItemName").alias("ProductName"),
        _c("U_SubGrp4").alias("StyleCode"),
        _c("U_SubGrp1").alias("Brand"),
        "StockQuantity",
    )


# dataset: (record key, search columns, group column)
LISTS = {
    "products": ("ProductCode", ("ProductCode", "ProductName"), "ProductGroupCode"),
    "pricelists": ("ProductCode", ("ProductCode", "ProductName", "Brand"), "ProductGroupCode"),
    "businesspartners": ("BPCode", ("BPCode", "BPName"), None),
    "schemes": ("DocEntry", ("PolicyNumber", "PolicyName"), None),
    "stockInventory": ("ProductCode", ("ProductCode", "ProductName"), None),
    "outstanding": ("CardCode", ("CardCode", "CardName"), None),
}


def base_of(dataset: str, t: Tables, rules: Rules, as_of: str) -> DataFrame:
    """The unfiltered records of a worklist."""
    if dataset == "products":
        return item_base(t, rules)
    if dataset == "pricelists":
        return price_base(t, rules)
    if dataset == "businesspartners":
        return partner_base(t, rules)
    if dataset == "schemes":
        return scheme_base(t, rules)
    if dataset == "stockInventory":
        return stock_base(t, rules)
    if dataset == "outstanding":
        return receivable_summary(t, rules, as_of)
    raise ValueError(f"unknown dataset: {dataset}")


def records_with_status(
    dataset: str, t: Tables, rules: Rules, status: DataFrame, as_of: str
) -> DataFrame:
    """The records of a dataset with their delivery state."""
    key = LISTS[dataset][0]
    return overlay_status(base_of(dataset, t, rules, as_of), status, key, dataset)


def spec_for(dataset: str, spec: FilterSpec, rules: Rules) -> FilterSpec:
    """The filter set bound to the columns of a dataset."""
    _, search_in, group = LISTS[dataset]
    columns = {"status": "push_status", "division": "DivisionCode"}
    if group:
        columns["group"] = group
    return replace(spec, search_in=search_in, columns=columns)


def list_order(dataset: str) -> list[str]:
    """A unique order; a price summary has one row per item and brand."""
    key = LISTS[dataset][0]
    return [key, "Brand"] if dataset == "pricelists" else [key]


def tracked_records(
    dataset: str, t: Tables, rules: Rules, status: DataFrame, records: DataFrame
) -> DataFrame | None:
    """The rows whose states a worklist counts, where they differ from its records.

    Price lists count each item once, whatever its brands; schemes also count those
    without lines.
    """
    if dataset == "pricelists":
        return records.select("ProductCode", "push_status").distinct()
    if dataset == "schemes":
        return overlay_status(
            listed_schemes(t, rules).select("DocEntry").distinct(), status, "DocEntry", dataset
        )
    return None


def dataset_worklist(
    dataset: str,
    t: Tables,
    rules: Rules,
    status: DataFrame,
    spec: FilterSpec,
    as_of: str,
    page: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """One page of a dataset with totals and unfiltered status counts."""
    records = records_with_status(dataset, t, rules, status, as_of)
    return worklist(
        records,
        spec_for(dataset, spec, rules),
        list_order(dataset),
        page,
        limit,
        tracked=tracked_records(dataset, t, rules, status, records),
    )


def attendance_worklist(
    log: DataFrame, spec: FilterSpec, page: int = 1, limit: int | None = None
) -> DataFrame:
    """One page of the punch log, newest first."""
    bound = replace(
        spec,
        search_in=("employee_id", "ref_id"),
        columns={"status": "push_status", "kind": "punch_type", "date": "punch_time"},
    )
    newest: list[Column] = [F.desc("id")]
    return worklist(log, bound, newest, page, limit, PUNCH_STATUSES)
