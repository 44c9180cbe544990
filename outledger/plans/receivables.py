"""Open receivables: extract, records and per-partner summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.functions.choose import case, classify_like
from outledger.functions.dates import (
    date_text,
    days_overdue,
    effective_due,
    millis_text,
    moment,
)
from outledger.functions.numeric import digits_to_int, number_or_null
from outledger.operators.batching import assign_batches
from outledger.operators.filters import nonzero
from outledger.operators.joins import key_text, where_exists
from outledger.operators.skew import HotKeys
from outledger.plans.items import Tables
from outledger.rules import Rules

_c = F.col


def customers(t: Tables, rules: Rules) -> DataFrame:
    """Partners that are customers of a known group, whatever their validity."""
    own = t["partners"].filter(_c("CardType") == rules.partner_type)
    return where_exists(own, t["partner_groups"], "GroupCode").select("CardCode", "CardName")


def division_of(brand: Column, rules: Rules) -> Column:
    """Division of an invoice brand; a missing brand falls to the default."""
    return classify_like(brand, rules.receivable_patterns, rules.receivable_default)


def open_lines(t: Tables, rules: Rules, keys: DataFrame | None = None) -> DataFrame:
    """Open journal lines of customers with their booking and invoice.

    The lines are the fact side of every join: one transaction may hold a large
    share of them, so its lines are spread before the two joins on it.
    """
    lines = nonzero(t["journal_lines"], "BalDueDeb").withColumnRenamed("TransType", "LineType")
    lines = lines.withColumn("Ref1", F.rtrim("Ref1"))
    if keys is not None:
        lines = where_exists(
            lines, keys.select(_c("record_key").alias("ShortName")), "ShortName"
        )
    # Counted on the raw table: a plain scan of one column, and an upper bound.
    hot = HotKeys(t["journal_lines"], ["TransId"])
    booking = t["journal"].select("TransId", "RefDate", "memo", "TransType")
    invoices = t["invoices"].select(
        "TransId",
        key_text(_c("DocNum")).alias("Ref1"),
        _c("CardCode").alias("ShortName"),
        "DocEntry",
        "DocDate",
        "DocTotal",
        "U_Brand",
    )
    booked = hot.spread(lines).join(hot.repeat(booking), hot.join_on)
    billed = booked.join(hot.repeat(invoices), [*hot.join_on, "Ref1", "ShortName"], "left")
    return billed.withColumn(
        "duedat", effective_due(_c("LineType"), _c("DueDate"), _c("RefDate"))
    ).withColumnRenamed("ShortName", "CardCode")


def receivable_rows(
    t: Tables, rules: Rules, as_of: str, keys: DataFrame | None = None
) -> DataFrame:
    """The receivables extract; a partner with several billing addresses repeats its lines."""
    places = (
        t["addresses"].filter("AdresType = 'B'").select("CardCode", "City", "State")
    )
    who = customers(t, rules).join(places, "CardCode", "left")
    now = moment(as_of)
    division = division_of(_c("U_Brand"), rules)
    return (
        open_lines(t, rules, keys)
        .join(who, "CardCode")
        .select(
            division.alias("DivisionCode"),
            division.alias("DivisionName"),
            _c("U_Brand").alias("Brand"),
            case(
                [(_c("TransType") == "13", "AR Invoice"), (_c("TransType") == "30", "Journal")]
            ).alias("DocType"),
            digits_to_int(_c("Ref1")).alias("InvoiceNo"),
            _c("DocDate").alias("InvoiceDate"),
            _c("duedat").alias("DueDate"),
            "CardCode",
            "CardName",
            "City",
            _c("State").alias("STATE"),
            _c("memo").alias("DocumentRemarks"),
            days_overdue(_c("BalDueDeb"), _c("duedat"), now).alias("OverdueDays"),
            now.alias("OverdueDate"),
            F.when(_c("TransType") == "30", _c("Debit"))
            .otherwise(F.coalesce("DocTotal", F.lit(0)))
            .alias("DocumentValue"),
            _c("BalDueDeb").alias("BalanceToBePaid"),
        )
    )


def receivable_records(rows: DataFrame) -> DataFrame:
    """Flat outgoing records with formatted dates and plain numbers."""
    return rows.select(
        "DivisionCode",
        "DivisionName",
        "Brand",
        "DocType",
        "InvoiceNo",
        date_text(_c("InvoiceDate")).alias("InvoiceDate"),
        millis_text(_c("DueDate")).alias("DueDate"),
        "CardCode",
        "CardName",
        "City",
        "STATE",
        "DocumentRemarks",
        F.coalesce("OverdueDays", F.lit(0)).alias("OverdueDays"),
        millis_text(_c("OverdueDate")).alias("OverdueDate"),
        number_or_null(_c("DocumentValue")).alias("DocumentValue"),
        number_or_null(_c("BalanceToBePaid")).alias("BalanceToBePaid"),
    )


RECORD_ORDER = [
    "CardCode",
    "InvoiceNo",
    "DueDate",
    "DocumentRemarks",
    "BalanceToBePaid",
    "DocumentValue",
    "City",
    "STATE",
    "Brand",
    "DocType",
    "OverdueDays",
]


def receivable_batches(records: DataFrame, size: int) -> DataFrame:
    """Records with batch number and BatchEnd, true only on the very last record.

    Records that are equal in every ordered column are interchangeable.
    """
    batches = assign_batches(records, RECORD_ORDER, size)
    return batches.select(
        *records.columns, "pos", "batch_no", "batch_size", _c("batch_end").alias("BatchEnd")
    )


def receivable_summary(t: Tables, rules: Rules, as_of: str) -> DataFrame:
    """Open entries, balance and longest delay per customer.

    Lines are summed per customer first; names and places join the sums. A customer
    with several billing addresses counts its entries once per address.
    """
    lines = open_lines(t, rules)
    late = days_overdue(_c("BalDueDeb"), _c("duedat"), moment(as_of))
    sums = lines.groupBy("CardCode").agg(
        F.max(division_of(_c("U_Brand"), rules)).alias("DivisionCode"),
        F.count("*").alias("entries"),
        F.sum("BalDueDeb").alias("balance"),
        F.max(late).alias("MaxOverdueDays"),
    )
    places = (
        t["addresses"]
        .filter("AdresType = 'B'")
        .groupBy("CardCode")
        .agg(
            F.max("City").alias("City"), F.max("State").alias("State"), F.count("*").alias("copies")
        )
    )
    copies = F.coalesce("copies", F.lit(1))
    return (
        sums.join(customers(t, rules), "CardCode")
        .join(places, "CardCode", "left")
        .select(
            "CardCode",
            "CardName",
            "City",
            "State",
            "DivisionCode",
            (_c("entries") * copies).alias("InvoiceCount"),
            (_c("balance") * copies).alias("TotalBalance"),
            "MaxOverdueDays",
        )
    )
