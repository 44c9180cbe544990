"""Business partners and their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import COUNTRY_NAMES, STATE_NAMES
from outledger.functions.choose import (
    blank_chain,
    by_column_name,
    code_to_name,
    flag,
    null_default,
)
from outledger.functions.numeric import fixed2
from outledger.functions.text import clean_grade, first_phone
from outledger.operators.filters import not_blank
from outledger.operators.joins import where_exists, with_dimension
from outledger.operators.nesting import (
    ChildList,
    constant_list,
    dimension_list,
    distinct_children,
    nest_lists,
)
from outledger.plans.items import Tables
from outledger.rules import Rules

_c = F.col

DISCOUNTS = [f"U_Dis{i}" for i in range(1, 12)]


def active_partners(t: Tables, rules: Rules) -> DataFrame:
    """Active customers with an area."""
    own = t["partners"].filter((_c("CardType") == rules.partner_type) & (_c("validFor") == "Y"))
    return not_blank(own, "U_AreaCode")


def discount_of(column_name: Column) -> Column:
    """Discount taken from the column that ``column_name`` names."""
    value = by_column_name(column_name, {d: _c(d) for d in DISCOUNTS})
    return value.cast("decimal(18,6)")


def category(rules: Rules) -> Column:
    """Dealer for some groups, blank for the others."""
    return F.when(_c("GroupCode").isin(*rules.dealer_groups), rules.dealer_name).otherwise("")


def phone() -> Column:
    """First usable phone number of a partner."""
    return first_phone(_c("Phone1"), _c("Phone2"), _c("Cellular"))


def partner_rows(t: Tables, rules: Rules) -> DataFrame:
    """Flat extract: one row per partner and sub-brand, with the discount of the sub-brand."""
    dimension = [
        {"DivisionCode": d, "SubBrandName": s, "DiscountColumn": c} for d, s, c in rules.sub_brands
    ]
    rows = with_dimension(active_partners(t, rules), dimension)
    return rows.select(
        _c("CardCode").alias("BPCode"),
        _c("CardName").alias("BPName"),
        category(rules).alias("BPCategory"),
        clean_grade(_c("U_Grade")).alias("GradeOfBP"),
        _c("U_AreaCode").alias("AreaCode"),
        "DivisionCode",
        _c("SubBrandName").alias("Brand"),
        discount_of(_c("DiscountColumn")).alias("DiscountPer"),
    )


def partner_addresses(t: Tables, partners: DataFrame) -> DataFrame:
    """Addresses of partners as flat rows, one per (id, type).

    Contacts do not take part: they only multiplied addresses that were folded again.
    """
    own = partners.select(
        "CardCode",
        "CardName",
        "DocEntry",
        "ShipToDef",
        phone().alias("phone"),
        "E_Mail",
        "U_GSTIN",
        "validFor",
    )
    city = _c("City")
    rows = t["addresses"].join(own, "CardCode").select(
        _c("CardCode").alias("BPCode"),
        F.concat(
            F.coalesce("DocEntry", F.lit(1)).cast("string"), _c("LineNum").cast("string")
        ).alias("BillShipID"),
        _c("AdresType").alias("Type"),
        "LineNum",
        _c("CardName").alias("DisplayName"),
        F.when(_c("AdresType") == "B", "OFFICE").otherwise("SHIP").alias("LocationName"),
        blank_chain(_c("Building"), city).alias("Line1"),
        blank_chain(_c("Block"), city).alias("Line2"),
        blank_chain(_c("Street"), city).alias("Line3"),
        F.when(_c("ShipToDef") == _c("Address"), 1).otherwise(0).alias("IsDefault"),
        "City",
        null_default(_c("County"), _c("Country")).alias("County"),
        "State",
        "Country",
        "ZipCode",
        "phone",
        "E_Mail",
        "U_GSTIN",
        flag(_c("validFor")).alias("IsActive"),
    )
    return distinct_children(rows, "BPCode", ["BillShipID", "Type"], ["LineNum", "Line1", "City"])


def address_struct() -> Column:
    """Nested address of a flat address row, names resolved and gaps filled."""

    def text(col: str) -> Column:
        return null_default(_c(col), F.lit("")).alias(col)

    return F.struct(
        text("Line1"),
        text("Line2"),
        text("Line3"),
        _c("IsDefault"),
        text("City"),
        text("County"),
        F.coalesce(code_to_name(_c("State"), STATE_NAMES), F.lit("")).alias("State"),
        F.coalesce(code_to_name(_c("Country"), COUNTRY_NAMES), F.lit("")).alias("Country"),
        text("ZipCode"),
        _c("phone").alias("PhoneNumber"),
        _c("phone").alias("MobileNumber"),
        null_default(_c("E_Mail"), F.lit("")).alias("Email"),
        null_default(_c("U_GSTIN"), F.lit("")).alias("GSTNo"),
        _c("IsActive"),
        F.lit("").alias("GstStatus"),
    )


# --- fixed values: notification switches of a contact -------------------------
CONTACT_SWITCHES = {
    "PaymentSMS": 0,
    "PaymentEmail": 0,
    "PaymentWhatsapp": 1,
    "OrderEmail": 1,
    "OrderSMS": 1,
    "OrderWhatsapp": 1,
    "InvoiceWhatsapp": 1,
    "InvoiceEmail": 0,
    "InvoiceSMS": 0,
    "PaymentRequestSMS": 0,
    "PaymentRequestEmail": 0,
    "PaymentrequestWhatsapp": 0,
    "OutstandingSMS": 0,
    "OutstandingEmail": 0,
    "OutstandingWhatsapp": 0,
    "PaycollectionWhatsapp": 0,
    "DistributorWhatsapp": 0,
}


def partner_contacts(t: Tables, partners: DataFrame, rules: Rules) -> DataFrame:
    """Contacts of partners, once per division, one per (person, division)."""
    divisions = sorted({d for d, _, _ in rules.sub_brands})
    rows = t["contacts"].join(partners.select("CardCode", phone().alias("phone")), "CardCode")
    each = with_dimension(rows, [{"DivisionCode": d} for d in divisions])
    shaped = each.select(
        _c("CardCode").alias("BPCode"),
        _c("CntctCode").alias("ContactPersonID"),
        _c("Name").alias("ContactPersonName"),
        null_default(_c("Position"), F.lit(rules.contact_role)).alias("Designation"),
        _c("phone").alias("MobileNum"),
        _c("phone").alias("WhatsAppNum"),
        _c("E_MailL").alias("EmailID"),
        flag(_c("Active")).alias("IsActive"),
        F.lit(0).alias("IsSendOverDueReminder"),
        "DivisionCode",
        *[F.lit(v).alias(k) for k, v in CONTACT_SWITCHES.items()],
    )
    return distinct_children(
        shaped, "BPCode", ["ContactPersonID", "DivisionCode"], ["ContactPersonName", "EmailID"]
    )


def partner_documents(
    t: Tables, rules: Rules, keys: DataFrame | None = None, part_rows: int = 10_000
) -> DataFrame:
    """One document per partner, in chunks."""
    partners = active_partners(t, rules)
    if keys is not None:
        partners = where_exists(
            partners, keys.select(_c("record_key").alias("CardCode")), "CardCode"
        )
    addresses = partner_addresses(t, partners).withColumn("Address", address_struct())
    contacts = partner_contacts(t, partners, rules)
    contact_fields = [c for c in contacts.columns if c != "BPCode"]
    lists = nest_lists(
        {
            "BillShipTo": ChildList(
                addresses,
                ["BillShipID", "Type", "DisplayName", "LocationName", "Address"],
                ["Type", "BillShipID"],
            ),
            "Map_BpContactDetails": ChildList(
                contacts, contact_fields, ["DivisionCode", "ContactPersonID"]
            ),
        },
        "BPCode",
        part_rows,
        sizes=_child_counts(t, rules),
    )
    heads = partners.withColumnRenamed("CardCode", "BPCode")
    docs = heads.join(lists, "BPCode", "left")
    brands = [{"SubBrandName": s, "DivisionCode": d} for d, s, _ in rules.sub_brands]
    columns = {(d, s): c for d, s, c in rules.sub_brands}

    def discount(entry: dict) -> Column:
        name = columns[entry["DivisionCode"], entry["SubBrandName"]]
        return F.coalesce(_c(name), F.lit(0)).cast("decimal(18,6)")

    def trade_discount(entry: dict) -> Column:
        return F.struct(
            F.lit(rules.discount_name).alias("DiscountName"),
            F.lit(entry["DivisionCode"]).alias("DivisionCode"),
            F.lit(entry["SubBrandName"]).alias("Brand"),
            discount(entry).alias("DiscountPer"),
            F.lit(rules.discount_from).alias("FromDate"),
            F.lit(rules.discount_to).alias("ToDate"),
        )

    zero = fixed2(F.lit(0))

    def list_or_empty(name: str) -> Column:
        return F.coalesce(_c(name), F.array().cast(docs.schema[name].dataType)).alias(name)

    return docs.select(
        "BPCode",
        F.coalesce("part_no", F.lit(0)).alias("part_no"),
        F.coalesce("parts", F.lit(1)).alias("parts"),
        _c("CardName").alias("BPName"),
        null_default(_c("Currency"), F.lit(rules.default_currency)).alias("DefaultCurrency"),
        flag(_c("validFor")).alias("IsActive"),
        F.lit(0).alias("AllowCreditLimit"),
        null_default(_c("CardFName"), _c("CardName")).alias("DisplayName"),
        category(rules).alias("BPCategory"),
        F.lit("").alias("BPGroupCode"),
        null_default(_c("U_showcode"), F.lit("")).alias("SR_BPCode"),
        clean_grade(_c("U_Grade")).alias("GradeOfBP"),
        F.lit("").alias("CustomerRemark"),
        zero.alias("Latitude"),
        zero.alias("Longitude"),
        _c("U_AreaCode").alias("AreaCode"),
        F.lit(False).alias("TwoYear"),
        list_or_empty("BillShipTo"),
        list_or_empty("Map_BpContactDetails"),
        F.array(*[trade_discount(e) for e in brands]).alias("Discount_BP_Division"),
        _division_list(rules).alias("MST_MAP_BP_Division"),
        F.array(
            *[
                F.struct(
                    F.lit(e["SubBrandName"]).alias("Brand"),
                    F.lit(e["DivisionCode"]).alias("DivisionCode"),
                )
                for e in brands
            ]
        ).alias("MST_MAP_BP_Brand"),
        dimension_list(brands, {"DiscountPer": discount}).alias("MST_Map_BP_SubBrand"),
    )


def _child_counts(t: Tables, rules: Rules) -> DataFrame:
    """Upper bound of contacts and addresses per partner, from the key columns alone."""
    divisions = len({d for d, _, _ in rules.sub_brands})
    contacts = t["contacts"].select("CardCode", F.lit(divisions).alias("weight"))
    addresses = t["addresses"].select("CardCode", F.lit(1).alias("weight"))
    return (
        contacts.unionByName(addresses)
        .groupBy(_c("CardCode").alias("BPCode"))
        .agg(F.sum("weight").alias("n"))
    )


def _division_list(rules: Rules) -> Column:
    """Per division settings of a partner; amounts are texts with two decimals."""
    zero = fixed2(F.lit(0))
    return F.concat(
        *[
            constant_list(
                MapDivisionID=F.coalesce(_c("UpdateTS"), F.lit("")),
                AutoApprovalCreditLimit=zero,
                AutoApprovalCreditLimitBal=zero,
                BPRemarks="",
                CreditLimit=zero,
                Destination=F.coalesce(_c("City"), F.lit("")),
                DiscountPer=zero,
                DivisionCode=division,
                ExcessPer=zero,
                Grade=F.replace(_c("U_Grade"), F.lit("Grade "), F.lit("")),
                IsActive=1,
                IsOrderAutoApproval=0,
                Outstandingdays=0,
                PriceLisCode=F.coalesce(_c("U_SalPriceCode"), F.lit("")),
                ShowLimit=0,
                TransporterName=rules.transporter,
            )
            for division in sorted({d for d, _, _ in rules.sub_brands})
        ]
    )
