"""Promotion schemes and their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import POLICY_FIELDS
from outledger.functions.choose import lookup
from outledger.functions.dates import iso_text, moment
from outledger.functions.numeric import to_decimal
from outledger.operators.filters import valid_at
from outledger.operators.joins import where_exists
from outledger.operators.nesting import ChildList, constant_list, nest_lists
from outledger.operators.ranking import first_by
from outledger.plans.items import Tables
from outledger.rules import Rules
from outledger.session import pin

_c = F.col

# Complete order of the lines of a scheme.
LINE_ORDER = ["LineId", "U_Qual", "U_bran", "U_Discunt", "U_Stat", "U_BillsQty", "U_OffersQty"]


def valid_schemes(t: Tables, as_of: str) -> DataFrame:
    """Schemes valid at the as-of time."""
    return valid_at(t["schemes"], "U_FrmDt", "U_ToDt", moment(as_of))


def lines_of(t: Tables, schemes: DataFrame) -> DataFrame:
    """The lines of the schemes."""
    return where_exists(t["scheme_lines"], schemes, "DocEntry")


def scheme_headers(
    t: Tables,
    schemes: DataFrame,
    rules: Rules,
    now: Column,
    number: str = "DocEntry",
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per scheme that has lines; discount kind and brand come from its first line."""
    lines = lines_of(t, schemes) if lines is None else lines
    first = first_by(lines, ["DocEntry"], LINE_ORDER).select("DocEntry", "U_Discunt", "U_bran")
    return schemes.join(first, "DocEntry").select(
        F.concat_ws("", "Object", _c(number).cast("string")).alias("PolicyNumber"),
        F.lit(1).alias("Revision"),
        _c("DocEntry").alias("PolicyID"),
        _c("Remark").alias("PolicyName"),
        lookup(F.rtrim("U_Discunt"), rules.saving_types).alias("SavingType"),
        _c("U_Discunt").alias("DiscountBasis"),
        F.lit("PG").alias("Applicability"),
        F.lit(1).alias("IsCustomerDefined"),
        F.lit(1).alias("IsActive"),
        lookup(F.rtrim("U_bran"), rules.brand_divisions).alias("DivisionCode"),
        iso_text(now).alias("FromDate"),
        F.lit(rules.scheme_end).alias("ToDate"),
        F.lit(0).alias("AllowDiscountForAllProducts"),
        F.lit(None).cast("double").alias("DiscountPer"),
    )


def scheme_states(t: Tables, schemes: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Distinct (PolicyID, StateCode): names of the states on the lines of a scheme."""
    lines = lines_of(t, schemes) if lines is None else lines
    codes = lines.select("DocEntry", _c("U_Stat").alias("Code")).distinct()
    return codes.join(t["states"], "Code").select(
        _c("DocEntry").alias("PolicyID"), _c("Name").alias("StateCode")
    ).distinct()


def group_styles(t: Tables) -> DataFrame:
    """Distinct (group, style) of the valid items."""
    return (
        t["items"]
        .filter("validFor = 'Y' and U_SubGrp4 is not null")
        .select(F.rtrim("U_SubGrp7").alias("U_Qual"), _c("U_SubGrp4").alias("StyleCode"))
        .distinct()
    )


def group_lines(lines: DataFrame) -> DataFrame:
    """The first line per group of a scheme."""
    return first_by(lines.withColumn("U_Qual", F.rtrim("U_Qual")), ["DocEntry", "U_Qual"], LINE_ORDER)


def scheme_group_counts(t: Tables, lines: DataFrame) -> DataFrame:
    """Rows of ``scheme_groups`` per scheme (PolicyID, n), without forming them."""
    styles = group_styles(t).groupBy("U_Qual").agg(F.count("*").alias("_styles"))
    groups = lines.select("DocEntry", F.rtrim("U_Qual").alias("U_Qual")).distinct()
    return groups.join(styles, "U_Qual").groupBy(_c("DocEntry").alias("PolicyID")).agg(
        F.sum("_styles").alias("n")
    )


def scheme_groups(t: Tables, schemes: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """First line per (group, style) of a scheme, with the alternates of the group.

    Items only contribute the styles of a group, so they are reduced to distinct
    (group, style) pairs first; lines are never multiplied by items.
    """
    styles = group_styles(t)
    per_group = group_lines(lines_of(t, schemes) if lines is None else lines)
    group = _c("U_Qual")
    return per_group.join(styles, "U_Qual").select(
        _c("DocEntry").alias("PolicyID"),
        F.concat(_c("DocEntry").cast("string"), _c("LineId").cast("string")).alias("MappingID"),
        group.alias("GroupCode"),
        "StyleCode",
        to_decimal(_c("U_BillsQty")).alias("MinOrderQty"),
        to_decimal(_c("U_OffersQty")).alias("FreeQty"),
        F.lit("S").alias("Applicability"),
        F.lit(1).alias("AllowMultiplyFreeQty"),
        to_decimal(_c("U_BillsQty")).alias("MaxAllowedFreeQty"),
        group.alias("GroupName"),
        F.lit(1).alias("IsActive"),
        F.lit(1).alias("MappingStatus"),
        constant_list(GroupName=group, StyleName=group, IsActive=0).alias("SC_ProdAlternate"),
    )


# Names of outgoing fields.
GROUP_FIELDS = [
    "MappingID",
    "GroupCode",
    "StyleCode",
    "MinOrderQty",
    "FreeQty",
    "Applicability",
    "AllowMultiplyFreeQty",
    "MaxAllowedFreeQty",
    "GroupName",
    "IsActive",
    "MappingStatus",
    "SC_ProdAlternate",
]


def scheme_partner_counts(t: Tables, schemes: DataFrame) -> DataFrame:
    """Partners reached by a scheme through the states of its lines.

    Only the count is needed downstream: the outgoing list is a constant. It comes
    from partners per state, so scheme x partner pairs are never formed.
    """
    billed = t["addresses"].filter("AdresType = 'B'").select("CardCode", "State")
    reach = (
        where_exists(billed, t["partners"], "CardCode")
        .distinct()
        .groupBy("State")
        .agg(F.count("*").alias("n"))
    )
    codes = where_exists(t["scheme_lines"], schemes, "DocEntry").select("DocEntry", "U_Stat")
    return (
        codes.distinct()
        .join(reach, _c("U_Stat") == _c("State"))
        .groupBy("DocEntry")
        .agg(F.sum("n").alias("partners"))
    )


def scheme_products(t: Tables, schemes: DataFrame) -> DataFrame:
    """By-key form: every item of the group of every line, with its alternates."""
    lines = where_exists(t["scheme_lines"], schemes, "DocEntry")
    lines = lines.withColumn("U_Qual", F.rtrim("U_Qual"))
    items = t["items"].select(
        F.rtrim("U_SubGrp7").alias("U_Qual"),
        _c("ItemCode").alias("ProductCode"),
        _c("U_Size").alias("SizeCode"),
        _c("U_SubGrp6").alias("ColorCode"),
        "validFor",
    )
    alternate = F.when(
        _c("validFor") == "Y",
        constant_list(
            ProductCode=_c("ProductCode"),
            SizeCode=_c("SizeCode"),
            ColorCode=_c("ColorCode"),
            IsActive=0,
        ),
    )
    return lines.join(items, "U_Qual").select(
        _c("DocEntry").alias("PolicyID"),
        "LineId",
        "ProductCode",
        "SizeCode",
        "ColorCode",
        to_decimal(_c("U_BillsQty")).alias("MinOrderQty"),
        to_decimal(_c("U_OffersQty")).alias("FreeQty"),
        F.lit("S").alias("Applicability"),
        _c("U_OffersQty").alias("AllowMultiplyFreeQty"),
        to_decimal(_c("U_BillsQty")).alias("MaxAllowedFreeQty"),
        F.lit(1).alias("IsActive"),
        F.lit(1).alias("MappingStatus"),
        alternate.alias("SC_ProdAlternate"),
    )


# Names of outgoing fields.
PRODUCT_FIELDS = [
    "ProductCode",
    "SizeCode",
    "ColorCode",
    "MinOrderQty",
    "FreeQty",
    "Applicability",
    "AllowMultiplyFreeQty",
    "MaxAllowedFreeQty",
    "IsActive",
    "MappingStatus",
    "SC_ProdAlternate",
]



def scheme_documents(
    t: Tables, schemes: DataFrame, rules: Rules, now: Column, part_rows: int = 10_000
) -> DataFrame:
    """One document per scheme, in chunks.

    The lines are stored once; headers, states and groups read them.
    """
    lines = pin(lines_of(t, schemes).select("DocEntry", *LINE_ORDER))
    headers = scheme_headers(t, schemes, rules, now, lines=lines)
    # The states of a scheme are bounded by the state dimension, so they stay whole
    # and repeat on every part.
    states = nest_lists(
        {"states": ChildList(scheme_states(t, schemes, lines), ["StateCode"], ["StateCode"])},
        "PolicyID",
        part_rows=None,
    ).select("PolicyID", "states")
    groups = nest_lists(
        {
            "groups": ChildList(
                scheme_groups(t, schemes, lines), GROUP_FIELDS, ["GroupCode", "StyleCode"]
            )
        },
        "PolicyID",
        part_rows,
        scheme_group_counts(t, lines),
    )
    docs = headers.join(states, "PolicyID", "left").join(groups, "PolicyID", "left")
    no_product = {"ProductCode": None, "SizeCode": None, "ColorCode": None}
    alternate = constant_list(**no_product, IsActive=0)
    mapping = constant_list(
        **no_product,
        MinOrderQty=F.lit(None).cast("decimal(10,2)"),
        FreeQty=F.lit(None).cast("decimal(10,2)"),
        Applicability=None,
        AllowMultiplyFreeQty=F.lit(None).cast("int"),
        MaxAllowedFreeQty=F.lit(None).cast("decimal(10,2)"),
        IsActive=F.lit(None).cast("int"),
        MappingStatus=F.lit(None).cast("int"),
        SC_ProdAlternate=alternate,
    )
    roles = F.array(*[F.struct(F.lit(r).alias("Role")) for r in rules.scheme_roles])
    policy = F.struct(
        "PolicyNumber",
        (_c("Revision") + 1).alias("Revision"),
        *POLICY_FIELDS,
        constant_list(BPCategory=rules.scheme_category).alias("SC_BpCategoryMapping"),
        _c("states").alias("StateMapping"),
        roles.alias("RoleMapping"),
        constant_list(BPCode=None).alias("SC_BpExclution"),
        constant_list(BPCode=None).alias("SC_BpInclution"),
        mapping.alias("SC_ProductMapping"),
        _c("groups").alias("SC_ProdGroupMapping"),
        alternate.alias("SC_ProdAlternate"),
        constant_list(GroupName=None, StyleCode=None, IsActive=0).alias("SC_ProdGroupAlternate"),
        constant_list(Brand=None, DiscountType=None, DiscountVal=None, IsActive=0).alias(
            "SC_Brand_Discount"
        ),
        constant_list(
            DivisionCode=None,
            GroupCode=None,
            GroupName=None,
            StyleCode=None,
            StyleName=None,
            DiscountType=None,
            DiscountVal=None,
            IsActive=0,
        ).alias("SC_ProdGroupDirectDiscount"),
        constant_list(**no_product, DiscountType=None, DiscountVal=None, IsActive=0).alias(
            "SC_ProductDirectDiscount"
        ),
    )
    return docs.select(
        "PolicyID",
        F.coalesce("part_no", F.lit(0)).alias("part_no"),
        F.coalesce("parts", F.lit(1)).alias("parts"),
        policy.alias("Policy"),
    )


def scheme_documents_by_key(
    t: Tables, keys: DataFrame, rules: Rules, start: str, end: str, part_rows: int = 10_000
) -> DataFrame:
    """Documents of wanted schemes: numbered by document, mapped by product, any validity."""
    wanted = keys.select(_c("record_key").cast("bigint").alias("DocEntry"))
    schemes = where_exists(t["schemes"], wanted, "DocEntry")
    headers = scheme_headers(t, schemes, rules, moment(start.replace("T", " ")), "DocNum")
    codes = where_exists(t["scheme_lines"].filter("U_Stat is not null"), schemes, "DocEntry")
    codes = codes.select(_c("DocEntry").alias("PolicyID"), _c("U_Stat").alias("StateCode"))
    states = nest_lists(
        {"StateMapping": ChildList(codes.distinct(), ["StateCode"], ["StateCode"])},
        "PolicyID",
        part_rows=None,
    ).select("PolicyID", "StateMapping")
    products = nest_lists(
        {
            "SC_ProductMapping": ChildList(
                scheme_products(t, schemes), PRODUCT_FIELDS, ["LineId", "ProductCode"]
            )
        },
        "PolicyID",
        part_rows,
    )
    return (
        headers.withColumn("Applicability", F.lit("P"))
        .withColumn("Revision", _c("Revision") + 1)
        .withColumn("ToDate", F.lit(end))
        .join(states, "PolicyID", "left")
        .join(products, "PolicyID", "left")
    )
