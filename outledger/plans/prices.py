"""Price extract and price documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.functions.choose import null_default, pick
from outledger.functions.dates import moment
from outledger.operators.filters import exclude_values, valid_at
from outledger.operators.joins import where_exists, where_listed
from outledger.operators.nesting import ChildList, nest_lists, ordered_list
from outledger.operators.ranking import first_by, union_sources
from outledger.plans.items import SIZE_KEY, Tables, item_size_key, size_key
from outledger.rules import Rules

_c = F.col

# Complete order of price rows inside one source.
PRICE_ORDER = ["PriceListID", "PriceID", "Price", "MRP"]


def size_prices(t: Tables, rules: Rules, as_of: str) -> DataFrame:
    """The best size-book price per size key and state.

    The books are reduced to that before any item is joined: which row wins does not depend on the
    item, so items sharing a key never multiply price rows. Nor does it depend on the state within a
    document, which offers all its prices in all its states: the best price per document and size key
    is taken first, and only these meet the document's states. Lines, prices and states of other than
    valid books are dropped before anything else is done with them.
    """
    books = valid_at(t["size_books"], "U_ValidFrom", "U_ValidTo", moment(as_of)).select("DocEntry")

    def valid(role: str) -> DataFrame:
        return where_listed(t[role], "DocEntry", books)

    prices = valid("size_book_prices").filter("U_MRP > 0 and U_SelPrice > 0").select(
        "DocEntry", _c("U_UniqID").alias("PriceID"), "U_Size",
        _c("U_SelPrice").alias("Price"), _c("U_MRP").alias("MRP"),
    )
    states = valid("size_book_states").filter("U_Selected = 'Y'").select(
        _c("DocEntry").alias("PriceListID"), _c("U_Code").alias("SubBrandCode")
    )
    lines = exclude_values(
        valid("size_book_lines"), "U_SubGroup1", rules.excluded_brands, trimmed=True
    ).select("DocEntry", _c("LineId").alias("PriceID"), "U_SubGroup7", "U_SubGroup4", "U_SubGroup1")
    rows = prices.join(lines, ["DocEntry", "PriceID"]).select(
        _c("DocEntry").alias("PriceListID"), "PriceID", "Price", "MRP",
        *size_key("U_SubGroup7", "U_SubGroup4", "U_SubGroup1", "U_Size"),
    )
    in_document = first_by(rows, ["PriceListID", *SIZE_KEY], PRICE_ORDER)
    offered = in_document.join(states.distinct(), "PriceListID")
    return first_by(offered, [*SIZE_KEY, "SubBrandCode"], PRICE_ORDER)


def item_prices(t: Tables, rules: Rules) -> DataFrame:
    """The best item-book price per item and state, from unlocked lines."""
    lines = exclude_values(
        t["item_book_lines"].filter("U_Lock = 'N'"), "U_Brand", rules.excluded_brands, trimmed=True
    ).select("DocEntry", _c("LineId").alias("U_RowId"), "U_CatalgCode")
    # Lines meet their book first; prices then join on document and row, which spreads a large document.
    rows = (
        t["item_book_prices"]
        .filter("U_MRP > 0 and U_SelPrice > 0")
        .join(lines.join(t["item_books"], "DocEntry"), ["DocEntry", "U_RowId"])
        .select(
            _c("U_ItemCode").alias("ItemCode"),
            _c("U_State").alias("SubBrandCode"),
            _c("DocEntry").alias("PriceListID"),
            _c("LineId").alias("PriceID"),
            _c("U_SelPrice").alias("Price"),
            _c("U_MRP").alias("MRP"),
            "U_CatalgCode",
        )
    )
    return first_by(rows, ["ItemCode", "SubBrandCode"], [*PRICE_ORDER, "U_CatalgCode"])


def price_rows(t: Tables, rules: Rules, as_of: str) -> DataFrame:
    """One price per item and state: the size book where it has one, else the item book.

    All rows of an item are in one partition, so grouping them further by item shuffles nothing.
    """
    # Equal keys fold first: repeated items, also those without a code, do not multiply prices.
    items = (
        t["items"]
        .filter("validFor = 'Y'")
        .select("ItemCode", "ItemName", "U_SubGrp1", *item_size_key())
        .groupBy("ItemCode", "U_SubGrp1", *SIZE_KEY)
        .agg(F.min("ItemName").alias("ItemName"))
    )
    no_code = F.lit(None).cast("string")
    from_size = items.join(size_prices(t, rules, as_of), SIZE_KEY).withColumn(
        "U_CatalgCode", no_code
    )
    from_item = items.join(item_prices(t, rules), "ItemCode")

    # Items x states are shuffled once, and without the columns that are the same in every row.
    def narrow(df: DataFrame) -> DataFrame:
        by_code = F.rtrim("U_SubGrp1") == F.lit(rules.catalogue_brand.rstrip(" "))
        return df.select(
            _c("ItemCode").alias("ProductCode"),
            "PriceListID",
            "SubBrandCode",
            pick(by_code, _c("U_CatalgCode"), _c("ItemName")).alias("BPProductName"),
            "Price",
            "MRP",
            "PriceID",
        )

    offers = union_sources([narrow(from_size), narrow(from_item)]).repartition("ProductCode")
    best = first_by(offers, ["ProductCode", "SubBrandCode"], ["source_priority", *PRICE_ORDER])
    return best.select(
        "ProductCode",
        "PriceListID",
        "SubBrandCode",
        "BPProductName",
        _c("SubBrandCode").alias("PriceListCode"),
        no_code.alias("EffectiveFrom"),
        no_code.alias("EffectiveTo"),
        F.lit(1).alias("PriceListIsActive"),
        F.lit(rules.dealer_name).alias("BPCategory"),
        "Price",
        "MRP",
        "PriceID",
        F.lit(1).alias("PriceIsActive"),
    )


def book_entries(t: Tables, rules: Rules) -> DataFrame:
    """Item-book prices per brand line of their document.

    Prices meet lines on the document alone, as the by-key extract wants it. Lines
    with the same brand and lock would only repeat equal rows, which the documents
    fold again, so lines are made distinct before they meet the prices.
    """
    lines = exclude_values(t["item_book_lines"], "U_Brand", rules.excluded_brands, trimmed=True)
    prices = t["item_book_prices"].filter("U_SelPrice > 0").select(
        "DocEntry", "LineId", "U_State", "U_SelPrice", "U_MRP"
    )
    return prices.join(
        lines.select("DocEntry", "U_Brand", "U_Lock").distinct(), "DocEntry"
    ).join(t["item_books"], "DocEntry")


def price_rows_by_key(t: Tables, rules: Rules, keys: DataFrame) -> DataFrame:
    """Prices of wanted items: item books only, brand and code in place of state and name."""
    wanted = keys.select(_c("record_key").alias("U_ItemCode"))
    books = {**t, "item_books": where_exists(t["item_books"], wanted, "U_ItemCode")}
    entries = book_entries(books, rules)
    items = t["items"].select(_c("ItemCode").alias("U_ItemCode"))
    none = F.lit(None).cast("string")
    active = F.when(_c("U_Lock") == "Y", 0).otherwise(1)
    return where_exists(entries, items, "U_ItemCode").select(
        _c("U_ItemCode").alias("ProductCode"),
        _c("DocEntry").alias("PriceListID"),
        _c("U_Brand").alias("SubBrandCode"),
        _c("U_ItemCode").alias("BPProductName"),
        _c("U_State").alias("PriceListCode"),
        none.alias("EffectiveFrom"),
        none.alias("EffectiveTo"),
        active.alias("PriceListIsActive"),
        F.lit(rules.dealer_name).alias("BPCategory"),
        _c("U_SelPrice").alias("Price"),
        _c("U_MRP").alias("MRP"),
        _c("LineId").alias("PriceID"),
        active.alias("PriceIsActive"),
    )


def price_documents(
    rows: DataFrame, rules: Rules, now: Column, part_rows: int | None = 10_000
) -> DataFrame:
    """Item -> price lists -> prices, as two successive groupings.

    ``part_rows=None`` suits the full extract: one price per item and state. Rows are then read once,
    and every grouping keeps to partitions by ``ProductCode`` if the rows have them. Otherwise rows
    are read more than once, so an expensive extract is pinned first.
    """
    entry = ["ProductCode", "PriceListID", "_code"]
    head_fields = [
        "SubBrandCode",
        "BPProductName",
        "PriceListCode",
        "EffectiveFrom",
        "EffectiveTo",
        "PriceListIsActive",
    ]
    order = ["PriceID", "SubBrandCode", "Price", "MRP"]
    keyed = rows.withColumn("_code", F.coalesce("PriceListCode", F.lit("")))
    # A price without an id is its own child key, so null must compare like a value. The first price
    # of a list is also the first of its rows, which gives the list its head.
    kept = [*head_fields, "BPCategory", "Price", "MRP", "PriceIsActive"]
    best = keyed.groupBy(*entry, "PriceID").agg(
        F.min_by(F.struct(*kept), F.struct(*order[1:])).alias("_row")
    )
    prices = best.select(
        *entry,
        "PriceID",
        F.struct(*[_c(f"_row.{c}").alias(c) for c in head_fields]).alias("_head"),
        _c("_row.BPCategory").alias("BPCategory"),
        null_default(_c("_row.Price"), F.lit(0)).alias("Price"),
        null_default(_c("_row.MRP"), F.lit(0)).alias("MRP"),
        null_default(_c("_row.PriceIsActive"), F.lit(1)).alias("IsActive"),
    )
    fields = ["PriceListID", "PriceID", "BPCategory", "Price", "MRP", "IsActive"]
    head = F.min_by("_head", F.struct("PriceID")).alias("h")
    if part_rows is None:
        inner = prices.groupBy(*entry).agg(
            head, ordered_list(["PriceID"], fields).alias("Prices")
        ).withColumn("part_no", F.lit(0))
    else:
        keys = prices.withColumn("entry", F.struct(*entry))
        chunks = nest_lists({"Prices": ChildList(keys, fields, ["PriceID"])}, "entry", part_rows)
        inner = keys.groupBy("entry").agg(head).join(chunks, "entry").select("*", "entry.*")
    lists = inner.select(
        "ProductCode",
        "PriceListID",
        "_code",
        _c("part_no").alias("_part"),
        _c("h.SubBrandCode").alias("SubBrandCode"),
        null_default(_c("h.BPProductName"), _c("ProductCode")).alias("BPProductName"),
        _c("h.PriceListCode").alias("PriceLisCode"),
        null_default(_c("h.EffectiveFrom"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss")).alias(
            "EffectiveFrom"
        ),
        null_default(_c("h.EffectiveTo"), F.lit(rules.price_end)).alias("EffectiveTo"),
        null_default(_c("h.PriceListIsActive"), F.lit(1)).alias("IsActive"),
        "Prices",
    )
    list_fields = [
        "PriceListID",
        "SubBrandCode",
        "BPProductName",
        "PriceLisCode",
        "EffectiveFrom",
        "EffectiveTo",
        "IsActive",
        "Prices",
    ]
    return nest_lists(
        {"PriceList": ChildList(lists, list_fields, ["PriceListID", "_code", "_part"])},
        "ProductCode",
        part_rows,
    )
