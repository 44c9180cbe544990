"""Documents and states worked out by hand for the awkward cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from erp import by, table, tables
from pyspark.sql import functions as F

from outledger.fixed_values import COUNTRY_NAMES, STATE_NAMES
from outledger.functions import choose, dates, numeric, text
from outledger.functions.dates import moment
from outledger.operators import delivery, joins, state
from outledger.operators.batching import assign_batches, delivery_plan, mark_end, outbox_write
from outledger.operators.nesting import heads, json_array, json_text
from outledger.operators.paging import far_page, page_meta, page_of
from outledger.plans import attendance, items, partners, prices, receivables, schemes, stock
from outledger.rules import Rules
from outledger.sources.pages import incomplete_extracts, page_records, read_pages
from outledger.sources.tables import jdbc_options

AS_OF = "2026-01-15 00:00:00"
RULES = Rules(
    excluded_brands=("SAMPLE",),
    division_patterns=(("%NORTH%", "NORTH"), ("%SOUTH%", "SOUTH")),
    brand_divisions={"SOUTH DHOTI": "SOUTH", "NORTH SHIRT": "NORTH"},
    receivable_patterns=(("%SOUTH%", "SOUTH"),),
    receivable_default="NORTH",
    catalogue_brand="SOUTH DHOTI",
    warehouse="MAIN",
    image_groups=("G1",),
    transporter="Carrier",
    sub_brands=(
        ("NORTH", "NORTH SHIRT", "U_Dis7"),
        ("SOUTH", "SOUTH DHOTI", "U_Dis1"),
    ),
)

ITEM_ROW = (
    "ProductCode string, ProductName string, ProductIsActive int, ProductGroupCode string, "
    "ShortDesc string, DetailedDesc string, CategoryName string, StyleCode string, "
    "SizeCode string, DivisionCode string, UOM string, AttributeSetName string, "
    "SizeGroup string, HSNCode string, Brand string, SalPackUn decimal(18,6), "
    "ColorCode string, ColorName string, Color string, Shade string, "
    "Min_Qty decimal(18,6), Max_Qty decimal(18,6), IsCoreColor int, "
    "TaxBelow decimal(18,6), TaxAbove decimal(18,6), SubBrandCode string, seq int"
)


def test_item_document_colours_taxes_and_defaults(spark):
    base = {"ProductCode": "P1", "ProductName": "Shirt", "SubBrandCode": "B", "CategoryName": "C"}
    rows = table(
        spark,
        ITEM_ROW,
        {**base, "seq": 1, "ColorCode": "RED", "Min_Qty": 0, "TaxAbove": 12, "AttributeSetName": "S"},
        {**base, "seq": 2, "ColorCode": "RED", "Min_Qty": 7, "TaxBelow": 5},
        {**base, "seq": 3, "ColorCode": "BLUE", "Min_Qty": 3, "Max_Qty": 9, "TaxBelow": 18},
        {**base, "seq": 4, "ColorCode": ""},
    )
    [doc] = by(items.item_documents(rows, RULES, order=["seq"]), "ProductCode").values()
    colours = {c["ColorCode"]: c for c in doc["ProductColors"]}
    assert set(colours) == {"RED", "BLUE"}
    assert colours["RED"]["Min_Qty"] == 1 and colours["RED"]["Max_Qty"] == 100000
    assert colours["BLUE"]["Min_Qty"] == 3 and colours["BLUE"]["Max_Qty"] == 9
    assert doc["ProductTaxes"] == [
        [
            {"TaxPer": "5.00", "EvalExpression": "Price < 2500"},
            {"TaxPer": "18.00", "EvalExpression": "Price >= 2500"},
        ]
    ]
    [attribute] = doc["ProductAttributes"]
    assert attribute["AttrVal"] == "Default"
    assert attribute["Attribute"]["AttributeName"] == "General"
    assert attribute["AttributeSet"]["AttributeSetName"] == "S"
    assert doc["ProductSubBrands"][0]["SubBrandCode"] == "B"
    assert doc["ProductDefaults"][0]["ColorCode"] == "RED"
    assert doc["Product"]["DfltWH"] == "MAIN" and doc["Product"]["PreBooking"] == 1
    assert (doc["part_no"], doc["parts"]) == (0, 1)


def test_item_document_attributes_first_wins(spark):
    rows = table(
        spark,
        ITEM_ROW + ", AttrVal string, AttributeName string, IsMainAttribute int",
        {"ProductCode": "P1", "seq": 1, "AttributeName": "Fit", "AttrVal": "Slim"},
        {"ProductCode": "P1", "seq": 2, "AttributeName": "Fit", "AttrVal": "Slim", "IsMainAttribute": 0},
        {"ProductCode": "P1", "seq": 3, "AttributeName": "Fit", "AttrVal": "Wide", "IsMainAttribute": 0},
        {"ProductCode": "P1", "seq": 4, "AttributeName": "Fit", "AttrVal": ""},
    )
    [doc] = by(items.item_documents(rows, RULES, order=["seq"]), "ProductCode").values()
    mains = {a["AttrVal"]: a["Attribute"]["IsMainAttribute"] for a in doc["ProductAttributes"]}
    assert mains == {"Slim": 1, "Wide": 0}
    assert doc["ProductColors"] == [] and doc["ProductSubBrands"] is None


def item(code, **more):
    return {
        "ItemCode": code,
        "ItemName": f"name {code}",
        "validFor": "Y",
        "ItmsGrpCod": 1,
        "U_SubGrp1": "NORTH SHIRT",
        "U_SubGrp4": "ST",
        "U_SubGrp5": "40 ",
        "U_SubGrp7": "G1",
        **more,
    }


def size_book(entry, key=("G1", "ST", "NORTH SHIRT", "40"), start="2026-01-01", price=50, mrp=60):
    group, style, brand, size = key
    return {
        "size_books": [
            {"DocEntry": entry, "U_ValidFrom": start, "U_ValidTo": "2026-12-31"}
        ],
        "size_book_lines": [
            {
                "DocEntry": entry,
                "LineId": 1,
                "U_SubGroup7": group,
                "U_SubGroup4": style,
                "U_SubGroup1": brand,
            }
        ],
        "size_book_states": [
            {"DocEntry": entry, "U_Code": "TN", "U_Selected": "Y"},
            {"DocEntry": entry, "U_Code": "KA", "U_Selected": "N"},
        ],
        "size_book_prices": [
            {"DocEntry": entry, "U_UniqID": 1, "U_Size": size, "U_SelPrice": price, "U_MRP": mrp}
        ],
    }


def test_item_rows_either_branch_and_catalogue(spark):
    roles = size_book(1)
    roles["items"] = [
        item("BOOK"),
        item("LISTED", U_SubGrp7="G2"),
        item("BOTH"),
        item("NONE", U_SubGrp7="G3"),
        item("GONE", validFor="N"),
        item("SAMPLE", U_SubGrp1="SAMPLE"),
        item("NOBRAND", U_SubGrp1=None),
        item("CAT", U_SubGrp1="SOUTH DHOTI"),
        item("NOCAT", U_SubGrp1="SOUTH DHOTI"),
    ]
    roles["item_groups"] = [{"ItmsGrpCod": 1}]
    roles["item_books"] = [
        {"DocEntry": i, "U_ItemCode": c}
        for i, c in enumerate(["LISTED", "BOTH", "CAT", "NOCAT", "NOBRAND"], 1)
    ]
    roles["item_book_prices"] = [
        {"DocEntry": i, "LineId": 1, "U_RowId": 1, "U_State": "TN", "U_SelPrice": 5, "U_MRP": 6}
        for i in range(1, 6)
    ]
    roles["item_book_lines"] = [
        {"DocEntry": 3, "LineId": 1, "U_Lock": "N", "U_CatalgCode": "OLD"},
        {"DocEntry": 3, "LineId": 2, "U_Lock": "N", "U_CatalgCode": "NOW"},
        {"DocEntry": 3, "LineId": 3, "U_Lock": "Y", "U_CatalgCode": "LOCKED"},
    ]
    rows = by(items.item_rows(tables(spark, **roles), RULES, AS_OF), "ProductCode")
    assert set(rows) == {"BOOK", "LISTED", "BOTH", "CAT", "NOCAT"}
    assert rows["CAT"]["ProductName"] == "NOW" and rows["NOCAT"]["ProductName"] is None
    assert rows["BOOK"]["SizeCode"] == "40" and rows["BOOK"]["DivisionCode"] == "NORTH"
    expired = items.item_rows(tables(spark, **roles), RULES, "2027-06-01 00:00:00")
    assert set(by(expired, "ProductCode")) == {"LISTED", "BOTH", "CAT", "NOCAT"}


def test_concatenated_keys_collide_and_columns_do_not(spark):
    left = spark.createDataFrame([("A", "BC", None)], "a string, b string, c string")
    right = spark.createDataFrame([("AB", "C", "")], "x string, y string, z string")
    assert joins.join_on_concat(left, right, ["a", "b", "c"], ["x", "y", "z"]).count() == 1
    renamed = right.toDF("a", "b", "c")
    assert joins.inner(left, renamed, ["a", "b"]).count() == 0


def test_price_sources_priority(spark):
    roles = size_book(1)
    more = size_book(2, price=0)
    roles = {k: roles[k] + more[k] for k in roles}
    roles["items"] = [item("A"), item("B", U_SubGrp7="G2"), item("C", U_SubGrp7="G3")]
    roles["item_books"] = [{"DocEntry": 10, "U_ItemCode": "A"}, {"DocEntry": 11, "U_ItemCode": "B"}]
    roles["item_book_lines"] = [
        {"DocEntry": 10, "LineId": 1, "U_Brand": "NORTH SHIRT", "U_Lock": "N"},
        {"DocEntry": 10, "LineId": 2, "U_Brand": "NORTH SHIRT", "U_Lock": "Y"},
        {"DocEntry": 11, "LineId": 1, "U_Brand": "NORTH SHIRT", "U_Lock": "N"},
    ]
    price = {"U_SelPrice": 9, "U_MRP": 10}
    roles["item_book_prices"] = [
        {"DocEntry": 10, "LineId": 1, "U_RowId": 1, "U_State": "TN", **price},
        {"DocEntry": 10, "LineId": 2, "U_RowId": 1, "U_State": "KA", **price},
        {"DocEntry": 10, "LineId": 3, "U_RowId": 2, "U_State": "GA", **price},
        {"DocEntry": 11, "LineId": 1, "U_RowId": 1, "U_State": "TN", "U_SelPrice": 0, "U_MRP": 10},
        {"DocEntry": 11, "LineId": 2, "U_RowId": 1, "U_State": "KA", "U_SelPrice": 4, "U_MRP": 0},
    ]
    t = tables(spark, **roles)
    rows = by(prices.price_rows(t, RULES, AS_OF), "ProductCode", "SubBrandCode")
    assert set(rows) == {("A", "TN"), ("A", "KA")}
    assert rows["A", "TN"]["Price"] == 50 and rows["A", "TN"]["PriceListID"] == 1
    assert rows["A", "KA"]["Price"] == 9 and rows["A", "KA"]["BPProductName"] == "name A"
    docs = by(
        prices.price_documents(prices.price_rows(t, RULES, AS_OF), RULES, moment(AS_OF)),
        "ProductCode",
    )
    lists = {entry["PriceLisCode"]: entry for entry in docs["A"]["PriceList"]}
    assert set(lists) == {"TN", "KA"}
    assert lists["TN"]["EffectiveFrom"] == "2026-01-15T00:00:00"
    assert lists["TN"]["EffectiveTo"] == "2060-12-31T00:00:00"
    assert [p["PriceID"] for p in lists["KA"]["Prices"]] == [2]
    wanted = spark.createDataFrame([("A",)], "record_key string")
    keyed = prices.price_rows_by_key(t, RULES, wanted).collect()
    # two lines of the document repeat each of its three prices, locked or not
    assert len(keyed) == 6
    assert {r.SubBrandCode for r in keyed} == {"NORTH SHIRT"}
    assert {r.BPProductName for r in keyed} == {"A"}


def test_scheme_document(spark):
    line = {"DocEntry": 5, "U_Discunt": "Quantity", "U_bran": "SOUTH DHOTI", "U_Qual": "G1"}
    t = tables(
        spark,
        schemes=[
            {"DocEntry": 5, "DocNum": 77, "Object": "S", "Remark": "Deal", "U_FrmDt": "2026-01-01",
             "U_ToDt": "2026-02-01"},
            {"DocEntry": 6, "DocNum": 78, "Object": "S", "U_FrmDt": "2026-01-01", "U_ToDt": "2026-02-01"},
            {"DocEntry": 7, "DocNum": 79, "Object": "S", "U_FrmDt": "2025-01-01", "U_ToDt": "2025-02-01"},
        ],
        scheme_lines=[
            {**line, "LineId": 1, "U_BillsQty": 10, "U_OffersQty": 1},
            {**line, "LineId": 2, "U_BillsQty": 20, "U_OffersQty": 2, "U_bran": "NORTH SHIRT"},
            {"DocEntry": 6, "LineId": 1, "U_Discunt": "Other", "U_bran": "NEW", "U_Qual": "G9",
             "U_Stat": "TN"},
            {"DocEntry": 7, "LineId": 1, "U_Qual": "G1"},
        ],
        states=[{"Code": "TN", "Name": "Tamil Nadu"}],
        items=[item("A"), item("B"), item("C", U_SubGrp4="OTHER"), item("D", U_SubGrp4=None)],
    )
    valid = schemes.valid_schemes(t, AS_OF)
    docs = by(schemes.scheme_documents(t, valid, RULES, moment(AS_OF)), "PolicyID")
    assert set(docs) == {5, 6}
    policy = docs[5]["Policy"]
    assert policy["PolicyNumber"] == "S5" and policy["Revision"] == 2
    assert policy["SavingType"] == "SC" and policy["DivisionCode"] == "SOUTH"
    assert policy["StateMapping"] is None
    groups = {g["StyleCode"]: g for g in policy["SC_ProdGroupMapping"]}
    assert set(groups) == {"ST", "OTHER"}
    assert groups["ST"]["MappingID"] == "51" and groups["ST"]["MinOrderQty"] == Decimal("10.00")
    assert groups["ST"]["SC_ProdAlternate"] == [
        {"GroupName": "G1", "StyleName": "G1", "IsActive": 0}
    ]
    assert policy["RoleMapping"] == [{"Role": "RBM"}, {"Role": "SE"}]
    assert policy["SC_BpInclution"] == [{"BPCode": None}]
    other = docs[6]["Policy"]
    assert other["SavingType"] is None and other["DivisionCode"] is None
    assert other["StateMapping"] == [{"StateCode": "Tamil Nadu"}]
    assert other["SC_ProdGroupMapping"] is None
    keys = spark.createDataFrame([("7",)], "record_key string")
    keyed = by(
        schemes.scheme_documents_by_key(t, keys, RULES, "2026-05-20T00:00:00", "2026-07-01T00:00:00"),
        "PolicyID",
    )
    assert keyed[7]["PolicyNumber"] == "S79" and keyed[7]["Applicability"] == "P"
    assert keyed[7]["FromDate"] == "2026-05-20T00:00:00"
    assert {p["ProductCode"] for p in keyed[7]["SC_ProductMapping"]} == {"A", "B", "C", "D"}


def test_scheme_reach_counts_partners_once(spark):
    t = tables(
        spark,
        schemes=[{"DocEntry": 1}],
        scheme_lines=[
            {"DocEntry": 1, "LineId": 1, "U_Stat": "TN"},
            {"DocEntry": 1, "LineId": 2, "U_Stat": "TN"},
            {"DocEntry": 1, "LineId": 3, "U_Stat": "KA"},
        ],
        partners=[{"CardCode": "A"}, {"CardCode": "B"}],
        addresses=[
            {"CardCode": "A", "AdresType": "B", "State": "TN", "LineNum": 1},
            {"CardCode": "A", "AdresType": "S", "State": "KA", "LineNum": 2},
            {"CardCode": "B", "AdresType": "B", "State": "KA", "LineNum": 1},
        ],
    )
    [row] = schemes.scheme_partner_counts(t, t["schemes"]).collect()
    assert row.partners == 2


def test_partner_document(spark):
    partner = {"CardType": "C", "validFor": "Y", "GroupCode": "100", "U_AreaCode": "A1"}
    t = tables(
        spark,
        partners=[
            {**partner, "CardCode": "P", "CardName": "Shop", "DocEntry": 4, "Phone1": "98x7654321",
             "Phone2": "+91 8765432109", "U_Grade": "-", "U_Dis7": 7, "ShipToDef": "ADR2"},
            {**partner, "CardCode": "Q", "CardName": "Mart", "U_Grade": "Grade A", "GroupCode": "9",
             "Currency": "USD"},
            {**partner, "CardCode": "R", "U_AreaCode": None},
            {**partner, "CardCode": "S", "U_AreaCode": "  "},
            {**partner, "CardCode": "T", "validFor": "N"},
        ],
        addresses=[
            {"CardCode": "P", "LineNum": 0, "AdresType": "B", "Address": "ADR1", "Building": " ",
             "City": "Erode", "State": "ZZ", "Country": "in", "Street": "Main"},
            {"CardCode": "P", "LineNum": 1, "AdresType": "S", "Address": "ADR2", "City": "Salem",
             "State": " tn", "Country": ""},
        ],
        contacts=[
            {"CardCode": "P", "CntctCode": 1, "Name": "Ann", "Active": "Y"},
            {"CardCode": "P", "CntctCode": 2, "Name": "Bob", "Position": "owner", "Active": "N"},
        ],
    )
    docs = by(partners.partner_documents(t, RULES), "BPCode")
    assert set(docs) == {"P", "Q"}
    p, q = docs["P"], docs["Q"]
    assert p["GradeOfBP"] == "C" and q["GradeOfBP"] == " A"
    assert p["DefaultCurrency"] == "INR" and q["DefaultCurrency"] == "USD"
    assert p["BPCategory"] == "Dealer" and q["BPCategory"] == ""
    assert p["DisplayName"] == "Shop" and p["Latitude"] == "0.00"
    ship_to = {a["Type"]: a for a in p["BillShipTo"]}
    assert len(p["BillShipTo"]) == 2
    bill = ship_to["B"]["Address"]
    assert ship_to["B"]["BillShipID"] == "40" and ship_to["S"]["LocationName"] == "SHIP"
    assert bill["Line1"] == "Erode" and bill["Line3"] == "Main"
    assert bill["State"] == "ZZ" and bill["Country"] == "India" and bill["County"] == "in"
    assert ship_to["S"]["Address"]["State"] == "Tamil Nadu"
    assert ship_to["S"]["Address"]["Country"] == "" and ship_to["S"]["Address"]["IsDefault"] == 1
    assert bill["PhoneNumber"] == "8765432109"
    seen = {(c["ContactPersonID"], c["DivisionCode"]) for c in p["Map_BpContactDetails"]}
    assert seen == {(1, "NORTH"), (1, "SOUTH"), (2, "NORTH"), (2, "SOUTH")}
    roles = {c["ContactPersonID"]: c["Designation"] for c in p["Map_BpContactDetails"]}
    assert roles == {1: "proprietor", 2: "owner"}
    assert q["BillShipTo"] == [] and q["Map_BpContactDetails"] == []
    discounts = {d["SubBrandName"]: d["DiscountPer"] for d in p["MST_Map_BP_SubBrand"]}
    assert discounts == {"NORTH SHIRT": 7, "SOUTH DHOTI": 0}
    assert q["MST_MAP_BP_Division"][0]["Grade"] == "A"
    flat = partners.partner_rows(t, RULES).filter("BPCode = 'P'").collect()
    assert {(r.Brand, r.DiscountPer) for r in flat} == {("NORTH SHIRT", 7), ("SOUTH DHOTI", 0)}
    cut = partners.partner_documents(t, RULES, part_rows=2)
    whole = partners.partner_documents(t, RULES)
    names = ["BPCode", "BPName", "AreaCode", "BPCategory"]
    first = [sorted((*[r[n] for n in names], r.BillShipTo[:1]) for r in heads(x).collect()) for x in (cut, whole)]
    assert first[0] == first[1]
    split = cut.filter("BPCode = 'P'").orderBy("part_no").collect()
    assert len(split) > 1 and {r.parts for r in split} == {len(split)}
    assert [r.part_no for r in split] == list(range(len(split)))
    one = whole.filter("BPCode = 'P'").first()
    assert [c for r in split for c in r.Map_BpContactDetails] == one.Map_BpContactDetails
    assert [c for r in split for c in r.BillShipTo] == one.BillShipTo
    assert sum(len(r.BillShipTo) + len(r.Map_BpContactDetails) for r in split) == 6


def test_stock_rows_thresholds(spark):
    t = tables(
        spark,
        items=[
            item("A", MinLevel=1, DocEntry=1, U_SubGrp6=None, U_SubGrp11="alt", U_SubGrp13="core"),
            item("B", MinLevel=1, DocEntry=2, U_SubGrp6="red"),
            item("C", MinLevel=1.9, DocEntry=3),
            item("D", MinLevel=5, DocEntry=4),
            item("E", DocEntry=5, U_SubGrp1="SAMPLE"),
        ],
        stock=[
            {"ItemCode": c, "WhsCode": "MAIN", "OnHand": n}
            for c, n in (("A", 0.9), ("B", 1.0), ("C", 1.2), ("D", 4.99), ("E", 3))
        ]
        + [{"ItemCode": "A", "WhsCode": "OTHER", "OnHand": 50}],
    )
    rows = by(stock.stock_records(stock.stock_rows(t, RULES)), "ProductCode")
    assert set(rows) == {"B", "C", "D"}
    labels = {
        c: (r["StockQuantity"], r["StockHighlightMessageDetails"], r["StockMessage"])
        for c, r in rows.items()
    }
    assert labels == {
        "B": (1.0, "Low Stock", "Stock Available"),
        "C": (1.0, "High Stock", "Stock Available"),
        "D": (4.0, "High Stock", "Very few stock left"),
    }
    keys = spark.createDataFrame([("A",), ("E",)], "record_key string")
    keyed = by(stock.stock_rows_by_key(t, RULES, keys), "ProductCode")
    assert set(keyed) == {"A", "E"} and keyed["A"]["StockQuantity"] == 0
    assert keyed["A"]["ColorCode"] == "core"


def test_receivables(spark):
    line = {"TransId": 1, "ShortName": "P", "BalDueDeb": 100, "Debit": 120, "TransType": "13",
            "DueDate": "2026-01-10"}
    t = tables(
        spark,
        partners=[{"CardCode": "P", "CardName": "Shop", "CardType": "C", "GroupCode": "1"},
                  {"CardCode": "V", "CardType": "S", "GroupCode": "1"},
                  {"CardCode": "N", "CardType": "C", "GroupCode": "unknown"}],
        partner_groups=[{"GroupCode": "1"}],
        addresses=[{"CardCode": "P", "AdresType": "B", "City": "Erode", "State": "TN"},
                   {"CardCode": "P", "AdresType": "S", "City": "Salem", "State": "KA"}],
        journal=[{"TransId": 1, "RefDate": "2026-01-01", "TransType": "13", "memo": "m"},
                 {"TransId": 2, "RefDate": "2026-01-01", "TransType": "30"},
                 {"TransId": 3, "RefDate": "2026-01-01", "TransType": "-2"}],
        journal_lines=[
            {**line, "Ref1": "12"},
            {**line, "Ref1": "12a"},
            {**line, "Ref1": ""},
            {**line, "Ref1": None},
            {**line, "Ref1": "12", "BalDueDeb": 0},
            {**line, "TransId": 2, "Ref1": "7", "TransType": "30", "BalDueDeb": -5},
            {**line, "TransId": 3, "Ref1": "8", "TransType": "-2"},
            {**line, "ShortName": "V"},
            {**line, "ShortName": "N"},
        ],
        invoices=[{"DocNum": 12, "DocEntry": 3, "DocDate": "2026-01-02", "DocTotal": 500,
                   "CardCode": "P", "U_Brand": "SOUTH DHOTI ", "TransId": 1}],
    )
    records = receivables.receivable_records(receivables.receivable_rows(t, RULES, AS_OF))
    rows = records.collect()
    assert len(rows) == 6
    first = next(r for r in rows if r.Brand)
    assert first.DivisionCode == "SOUTH" and first.InvoiceNo == 12 and first.DocumentValue == 500
    assert first.InvoiceDate == "2026-01-02" and first.DueDate == "2026-01-01 00:00:00.000"
    assert first.OverdueDays == 14 and first.STATE == "TN" and first.City == "Erode"
    plain = [r for r in rows if not r.Brand]
    assert {r.DivisionCode for r in plain} == {"NORTH"}
    journal = next(r for r in rows if r.DocType == "Journal")
    assert journal.DocumentValue == 120 and journal.OverdueDays == 0
    assert journal.DueDate == "2026-01-10 00:00:00.000" and journal.InvoiceNo == 7
    opening = next(r for r in rows if r.InvoiceNo == 8)
    assert opening.DocType is None and opening.OverdueDays == 5 and opening.DocumentValue == 0
    assert sorted(r.InvoiceNo or -1 for r in rows) == [-1, -1, -1, 7, 8, 12]
    marked = receivables.receivable_batches(records, 4).collect()
    assert sum(r.BatchEnd for r in marked) == 1
    assert sorted(r.batch_no for r in marked) == [1, 1, 1, 1, 2, 2]
    [total] = receivables.receivable_summary(t, RULES, AS_OF).collect()
    assert total.InvoiceCount == 6 and total.TotalBalance == 495 and total.MaxOverdueDays == 14
    assert total.DivisionCode == "SOUTH"


PUNCH = "ref_id bigint, employee_id string, punch_type string, punch_time timestamp_ntz"


def test_attendance_runs(spark):
    rows = [
        {"ref_id": 1, "employee_id": "E", "punch_type": "I", "punch_time": "2026-01-15 09:10:00"},
        {"ref_id": 2, "employee_id": "E", "punch_type": "I", "punch_time": "2026-01-15 09:00:00"},
        {"ref_id": 3, "employee_id": "E", "punch_type": "O", "punch_time": "2026-01-15 17:00:00"},
        {"ref_id": 4, "employee_id": None, "punch_type": "I", "punch_time": "2026-01-15 09:00:00"},
        {"ref_id": 5, "employee_id": "", "punch_type": "I", "punch_time": "2026-01-15 09:00:00"},
        {"ref_id": 6, "employee_id": "E", "punch_type": "O", "punch_time": "2026-01-16 00:30:00"},
        {"ref_id": 7, "employee_id": "F", "punch_type": "I"},
    ]
    log = table(spark, PUNCH)
    fresh = attendance.new_punches(table(spark, PUNCH, *rows), log, moment(AS_OF))
    assert sorted(r.ref_id for r in fresh.collect()) == [2, 3, 6]
    later = table(
        spark, PUNCH,
        {"ref_id": 9, "employee_id": "E", "punch_type": "O", "punch_time": "2026-01-15 19:00:00"},
        {"ref_id": 10, "employee_id": "E", "punch_type": "I", "punch_time": "2026-01-16 09:00:00"},
    )
    again = attendance.new_punches(later, fresh, moment(AS_OF))
    assert [r.ref_id for r in again.collect()] == [10]
    local = attendance.new_punches(
        table(spark, PUNCH, rows[2], {**rows[2], "ref_id": 8, "punch_time": "2026-01-15 19:00:00"}),
        log, moment(AS_OF), "Asia/Kolkata",
    )
    assert sorted(r.ref_id for r in local.collect()) == [3, 8]


def test_push_pending_and_job_status(spark):
    queue = spark.createDataFrame([("a",), ("b",), ("c",)], "ref_id string")
    attempts = spark.createDataFrame(
        [("a", 1, 500, None), ("a", 2, 200, None), ("b", 1, 404, None), ("b", 2, 200, None)],
        "ref_id string, attempt int, http_status int, body string",
    )
    outcomes = attendance.push_outcomes(queue, attempts)
    assert {r.ref_id: r.ok for r in outcomes.collect()} == {"a": True, "b": False, "c": False}
    [job] = attendance.job_row(outcomes, "J", "I", moment(AS_OF), moment(AS_OF)).collect()
    assert job.last_status == "CompletedWithErrors"
    [none] = attendance.job_row(
        outcomes.filter("ok"), "J", "I", moment(AS_OF), moment(AS_OF)
    ).collect()
    assert none.last_status == "Completed"


@pytest.mark.parametrize(
    "status, body, ok",
    [
        (200, '{"id":1}', True),
        (204, None, True),
        (200, "", True),
        (200, "not json, errorCode", True),
        (200, '{"success":false}', False),
        (200, '{"success":"false"}', True),
        (200, '{"Success": false}', False),
        (200, '{"SUCCESS": false}', True),
        (200, '{"status":"error"}', False),
        (200, '{"Status":"error"}', False),
        (200, '{"status":"Error"}', True),
        (200, '[{"success":true},{"success":false}]', False),
        (200, '[{"success":true},{"Success":false}]', True),
        (200, '{"errorCode":null}', False),
        (200, '{"a":{"ErrorMessage":"x"}}', False),
        (200, '{"text":"errorcode"}', False),
        (404, '{"success":true}', False),
        (None, None, False),
    ],
)
def test_classify_response(spark, status, body, ok):
    df = spark.createDataFrame([(status, body)], "http_status int, body string")
    assert delivery.classify_response(df).first().ok is ok


def test_retry_fold_policies(spark):
    log = spark.createDataFrame(
        [
            ("late", 1, 500, "a"), ("late", 2, 200, "b"), ("late", 3, 200, "c"),
            ("body", 1, 200, '{"success":false}'), ("body", 2, 200, "{}"),
            ("out", 1, 500, "x"), ("out", 2, 500, "y"), ("out", 3, 503, "z"), ("out", 4, 200, "w"),
            ("four", 1, 404, "n"), ("four", 2, 200, "ok"),
            ("short", 1, 500, "s"),
        ],
        "request string, attempt int, http_status int, body string",
    )
    crm = by(delivery.retry_fold(log, ["request"], 3, False, True), "request")
    assert (crm["late"]["ok"], crm["late"]["attempts_used"], crm["late"]["ignored_attempts"]) == (
        True, 2, 1)
    assert (crm["body"]["ok"], crm["body"]["attempts_used"]) == (False, 1)
    assert (crm["out"]["ok"], crm["out"]["exhausted"], crm["out"]["http_status"]) == (
        False, True, 503)
    assert crm["four"]["ok"] is True
    assert (crm["short"]["ok"], crm["short"]["exhausted"]) == (False, False)
    hr = by(delivery.retry_fold(log, ["request"], 3, True, False), "request")
    assert (hr["four"]["ok"], hr["four"]["attempts_used"]) == (False, 1)
    assert hr["body"]["ok"] is True
    [wait] = delivery.wait_report(
        delivery.retry_fold(log.filter("request = 'out'"), ["request"], 3, False, True), [], 1500, True
    ).collect()
    assert wait.wait_ms == 4500


def test_reconcile_every_requested_key(spark):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "record_key string")

    failed = spark.createDataFrame(
        [("c", "bad"), ("z", "not asked")], "record_key string, error_message string"
    )
    out = by(
        delivery.reconcile_missing(
            keys("a", "b", "c", "d", "e", "a"), keys("a", "b", "c", "e"), keys("a", "b", "c"), failed
        ),
        "record_key",
    )
    assert {k: (r["success"], r["error_message"]) for k, r in out.items()} == {
        "a": (True, None),
        "b": (True, None),
        "c": (False, "bad"),
        "d": (False, "Record not found in DB"),
        "e": (False, "Mapper produced no output"),
    }
    children = spark.createDataFrame([("a:1",), ("a:NA",), ("q:2",)], "child_key string")
    parents = by(delivery.reconcile_by_prefix(keys("a", "b"), children), "record_key")
    assert (parents["a"]["success"], parents["a"]["error_message"]) == (False, "Batch failed")
    assert parents["b"]["success"] and set(parents) == {"a", "b"}


def test_batches_of_401(spark):
    rows = spark.range(401).withColumn("k", F.col("id") % 3)
    batches = assign_batches(rows, ["k", "id"], 200)
    sizes = {r.batch_no: r["count"] for r in batches.groupBy("batch_no").count().collect()}
    assert sizes == {1: 200, 2: 200, 3: 1}
    assert [r.batch_no for r in batches.filter("batch_end").collect()] == [3]
    assert {r.record_range for r in batches.filter("batch_no = 3").collect()} == {"401-401"}
    plan = [tuple(r)[:3] for r in delivery_plan(rows, 200).orderBy("batch_no").collect()]
    assert plan == [(1, 200, "1-200"), (2, 200, "201-400"), (3, 1, "401-401")]
    assert delivery_plan(rows.filter("id < 0"), 200).count() == 0
    assert mark_end(rows, ["k", "id"]).filter("batch_end").first().id == 398


def test_outbox_round_trip(spark, tmp_path):
    docs = spark.range(230).select(F.col("id"), F.concat(F.lit("d"), "id").alias("name"))
    batches = assign_batches(docs, ["id"], 25)
    path = str(tmp_path / "outbox")
    outbox_write(batches, path, "pricelists", F.struct("name"), group_batches=4)
    back = spark.read.json(path)
    assert back.count() == 230 and back.filter("batch_end").count() == 1
    assert {r.batch_group for r in back.select("batch_group").distinct().collect()} == {0, 1, 2}


def test_status_upsert_keeps_time_and_clears_error(spark):
    store = spark.createDataFrame(
        [
            ("m", "k1", "Failed", datetime(2026, 1, 1), "err", datetime(2026, 1, 1)),
            ("m", "k2", "Pushed", datetime(2026, 1, 1), None, datetime(2026, 1, 1)),
            ("other", "k1", "Pushed", None, None, datetime(2026, 1, 1)),
        ],
        "master_type string, record_key string, push_status string, "
        "last_pushed_at timestamp_ntz, error_message string, updated_at timestamp_ntz",
    )
    keys = spark.createDataFrame([("k1",), ("k3",), ("k1",)], "record_key string")
    marked = by(state.mark_in_flight(store, keys, "m", moment(AS_OF)), "master_type", "record_key")
    assert len(marked) == 4
    k1 = marked["m", "k1"]
    assert k1["push_status"] == "Pushing" and k1["error_message"] is None
    assert k1["last_pushed_at"] == datetime(2026, 1, 1)
    assert marked["m", "k3"]["last_pushed_at"] is None
    assert marked["m", "k2"]["push_status"] == marked["other", "k1"]["push_status"] == "Pushed"
    results = spark.createDataFrame(
        [("k1", False, "x" * 3000)], "record_key string, success boolean, error_message string"
    )
    done = state.upsert_status(
        store, state.results_to_updates(results, "m", moment(AS_OF))
    )
    row = by(done, "master_type", "record_key")["m", "k1"]
    assert row["push_status"] == "Failed" and len(row["error_message"]) == 2000
    assert row["last_pushed_at"] == datetime(2026, 1, 15)


def test_json_helpers(spark):
    texts = [None, "null", "", "  ", "{bad", "[1", '{"k":1}', '[{"k":1},{"k":2}]', '"text"', "7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    sizes = df.select("i", F.size(json_array(F.col("t"), "struct<k:int>")).alias("n"))
    assert [r.n for r in sizes.orderBy("i").collect()] == [0, 0, 0, 0, 0, 0, 1, 2, 0, 0]
    both = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b")).alias("s"))
    [row] = both.select(
        json_text(F.col("s"), True).alias("kept"), json_text(F.col("s"), False).alias("dropped")
    ).collect()
    assert row.kept == '{"a":1,"b":null}' and row.dropped == '{"a":1}'


def test_scalar_expressions(spark):
    df = spark.createDataFrame(
        [(" tn", "in", "12", Decimal("1.005"), "x", None, "Grade A")],
        "state string, country string, digits string, amount decimal(10,3), word string, "
        "nothing string, grade string",
    )
    c = F.col
    [r] = df.select(
        choose.code_to_name(c("state"), STATE_NAMES).alias("state"),
        choose.code_to_name(c("country"), COUNTRY_NAMES).alias("country"),
        choose.code_to_name(c("word"), STATE_NAMES).alias("unknown"),
        choose.code_to_name(c("nothing"), STATE_NAMES).alias("missing"),
        numeric.digits_to_int(c("digits")).alias("number"),
        numeric.digits_to_int(c("word")).alias("no_number"),
        numeric.fixed2(c("amount")).alias("fixed"),
        numeric.fixed2(c("nothing").cast("decimal(5,2)")).alias("zero"),
        numeric.number_or_null(c("word")).alias("nan"),
        text.clean_grade(c("grade")).alias("grade"),
        text.composite_key(c("nothing"), c("nothing")).alias("key"),
        text.concat_blank(c("word"), c("nothing")).alias("blank"),
        text.concat_null(c("word"), c("nothing")).alias("null_"),
        text.truncate_text(F.lit("")).alias("no_text"),
        dates.date_text(c("word")).alias("no_date"),
        dates.iso_text(F.lit("2026-01-15 08:00:00.5")).alias("iso"),
    ).collect()
    assert (r.state, r.country, r.unknown, r.missing) == ("Tamil Nadu", "India", "x", None)
    assert (r.number, r.no_number, r.fixed, r.zero, r.nan) == (12, None, "1.01", "0.00", None)
    assert (r.grade, r.key, r.blank, r.null_, r.no_text) == (" A", "UNKNOWN:NA", "x", None, None)
    assert (r.no_date, r.iso) == (None, "2026-01-15T08:00:00")


def test_pages_files(spark, tmp_path):
    one = tmp_path / "in" / "complete"
    two = tmp_path / "in" / "broken"
    one.mkdir(parents=True)
    two.mkdir()
    (one / "1.json").write_text(
        '{"done": false, "nextRecordsUrl": "/n", "records": [\n'
        '{"Id": "a", "related": {"EmployeeId": "E"}, "AttendenceTime": "2026-01-15T09:00:00",\n'
        '"Type": "Check-In"},\n{"Id": "b", "related": null, "AttendenceTime": null}]}'
    )
    (one / "2.json").write_text('{"done": true, "records": []}')
    (two / "1.json").write_text('{"done": false, "nextRecordsUrl": "/n", "records": []}')
    pages = read_pages(spark, f"{tmp_path}/in/*")
    rows = by(page_records(pages), "ref_id")
    assert rows["a"]["employee_id"] == "E" and rows["b"]["employee_id"] is None
    assert rows["a"]["punch_time"] == datetime(2026, 1, 15, 9)
    [folder] = incomplete_extracts(pages).collect()
    assert folder.folder.endswith("/broken")


def test_page_clamps_and_depth(spark):
    rows = spark.range(1000)
    assert page_of(rows, ["id"], 0, 5).count() == 10
    assert page_of(rows, ["id"], 1, 5000).count() == 200
    assert page_of(rows, ["id"], 99, 200).count() == 0
    deep = spark.range(21000)
    ids = [r.id for r in far_page(deep, ["id"], 104, 200).collect()]
    assert ids == list(range(20600, 20800))
    [meta] = page_meta(rows.filter("id < 0"), 50, at_least_one=True).collect()
    assert tuple(meta) == (0, 1)


def test_rules_file_and_jdbc_options(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"excluded_brands": ["X"], "sub_brands": [["D", "S", "U_Dis1"]]}')
    rules = Rules.from_json(str(path))
    assert rules.excluded_brands == ("X",) and rules.sub_brands == (("D", "S", "U_Dis1"),)
    path.write_text('{"nope": 1}')
    with pytest.raises(ValueError):
        Rules.from_json(str(path))
    options = jdbc_options("jdbc:x", "T", "Id", (0, 100), 8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "100"


def test_day_of_punch_is_a_date(spark):
    row = spark.range(1).select(dates.local_day(moment("2026-01-15 20:00:00"), "Asia/Kolkata")).first()
    assert row[0] == date(2026, 1, 16)
