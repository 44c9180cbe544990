"""Nested documents, shown in flattened form."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.operators.nesting import (
    ChildList,
    constant_list,
    dimension_list,
    first_non_null,
    heads,
    json_array,
    nest_lists,
    none_if_empty,
    places,
    split_rejects,
)
from outledger.plans import items, partners, prices, receivables, schemes, stock
from outledger.queries.registry import query
from outledger.queries.sample_rules import AS_OF, RULES
from outledger.queries.views import erp, views

_c = F.col


@query(
    "nest_children",
    """select bp_id, bp_name, contact_name, row_number() over (partition by bp_id
    order by contact_name)-1 as pos, count(*) over (partition by bp_id) as n
    from si_partner join si_contact using (bp_id)""".replace(
        "count(*) over (partition by bp_id) as n",
        "cast(count(*) over (partition by bp_id) as int) as n",
    ).replace("row_number() over (partition by bp_id\n    order by contact_name)-1", "cast(row_number() over (partition by bp_id order by contact_name)-1 as int)"),
    "si_partner si_contact",
)
def nest_children(spark, folder):
    v = views(spark, folder)
    nested = nest_lists(
        {"contacts": ChildList(v("si_contact"), ["contact_name"], ["contact_name"])}, "bp_id"
    )
    sizes = nested.groupBy("bp_id").agg(F.sum(F.size("contacts")).cast("int").alias("n"))
    docs = v("si_partner").join(places(nested, "contacts"), "bp_id").join(sizes, "bp_id")
    return docs.select("bp_id", "bp_name", "n", "pos", "col.contact_name")


@query(
    "nest_empty_is_null",
    """select bp_id, count(addr_id)=0 as is_null, cast(nullif(count(addr_id),0) as int) as n
    from si_partner left join (select * from si_address where addr_type='S') using (bp_id)
    group by bp_id""",
    "si_partner si_address",
)
def nest_empty_is_null(spark, folder):
    v = views(spark, folder)
    ship = v("si_address").filter("addr_type = 'S'")
    nested = nest_lists({"ship": ChildList(ship, ["addr_id"], ["addr_id"])}, "bp_id")
    docs = v("si_partner").join(nested, "bp_id", "left")
    ship_to = none_if_empty(_c("ship"))
    return docs.select("bp_id", ship_to.isNull().alias("is_null"), F.size(ship_to).alias("n"))


@query(
    "nest_distinct",
    """select scheme_id, string_agg(state_id, ',' order by state_id) as states from
    (select distinct scheme_id, state_id from si_scheme_line) group by scheme_id""",
    "si_scheme_line",
)
def nest_distinct(spark, folder):
    pairs = views(spark, folder)("si_scheme_line").select("scheme_id", "state_id").distinct()
    nested = nest_lists(
        {"states": ChildList(pairs, ["state_id"], ["state_id"])}, "scheme_id", part_rows=None
    )
    ids = F.transform("states", lambda s: s["state_id"].cast("string"))
    return nested.select("scheme_id", F.array_join(ids, ",").alias("states"))


@query(
    "nest_two_level",
    """select scheme_id, grp, line_no, item_id, supp_id, cast(price as double) as price
    from si_scheme_line""",
    "si_scheme_line",
)
def nest_two_level(spark, folder):
    lines = views(spark, folder)("si_scheme_line").withColumn(
        "node", F.struct("scheme_id", "grp")
    )
    order = ["line_no", "item_id", "supp_id", "price"]
    inner = nest_lists({"lines": ChildList(lines, order, order)}, "node")
    groups = inner.select(
        _c("node.scheme_id").alias("scheme_id"), _c("node.grp").alias("grp"), "part_no", "lines"
    ).withColumnRenamed("part_no", "piece")
    outer = nest_lists(
        {"groups": ChildList(groups, ["grp", "lines"], ["grp", "piece"])}, "scheme_id"
    )
    return (
        outer.select("scheme_id", F.explode("groups").alias("g"))
        .select("scheme_id", "g.grp", F.explode("g.lines").alias("l"))
        .select("scheme_id", "grp", "l.line_no", "l.item_id", "l.supp_id", "l.price")
    )


@query(
    "nest_constant",
    """select scheme_id, 'DEALER' as category, null::varchar as brand, 0 as is_active,
    1 as elements from si_scheme""",
    "si_scheme",
)
def nest_constant(spark, folder):
    docs = views(spark, folder)("si_scheme").select(
        "scheme_id", constant_list(category="DEALER", brand=None, is_active=0).alias("list")
    )
    return docs.select("scheme_id", F.size("list").alias("elements"), F.explode("list").alias("e")).select(
        "scheme_id", "e.category", "e.brand", "e.is_active", "elements"
    )


@query(
    "dim_array",
    """select bp_id, division, sub_brand, cast(case src when 'd1' then coalesce(d1,0)
    when 'd2' then coalesce(d2,0) else coalesce(d3,0) end as double) as discount from si_partner
    cross join (values ('EAST','Shirts','d1'),('EAST','Knits','d3'),('WEST','Sets','d2'))
    t(division, sub_brand, src)""",
    "si_partner",
)
def dim_array(spark, folder):
    sources = {"Shirts": "d1", "Knits": "d3", "Sets": "d2"}
    dimension = [
        {"division": "EAST", "sub_brand": "Shirts"},
        {"division": "EAST", "sub_brand": "Knits"},
        {"division": "WEST", "sub_brand": "Sets"},
    ]

    def discount(entry):
        return F.coalesce(_c(sources[entry["sub_brand"]]), F.lit(0))

    docs = views(spark, folder)("si_partner").select(
        "bp_id", dimension_list(dimension, {"discount": discount}).alias("list")
    )
    return docs.select("bp_id", F.inline("list"))


_TAX_SQL = """case cast(cast({0} as decimal(18,2)) as varchar) when '12.00' then '18.00'
 else cast(cast({0} as decimal(18,2)) as varchar) end"""


@query(
    "item_document",
    f"""select ItemCode as code, ItemName as product_name, case when U_SubGrp1 like '%Brand#1%'
    then 'EAST' when U_SubGrp1 like '%Brand#2%' then 'WEST' end as division,
    rtrim(U_SubGrp6) as color_code, coalesce(U_SubGrp11,U_SubGrp6) as color_name,
    cast(coalesce(nullif(MinLevel,0),1) as double) as min_qty,
    cast(coalesce(nullif(MaxLevel,0),100000) as double) as max_qty,
    case when U_SubGrp13='Core item' then 1 else 0 end as is_core,
    concat_ws(',', case when U_taxrate is not null then 'Price < 2500='||
    {_TAX_SQL.format('U_taxrate')} end, 'Price >= 2500='||{_TAX_SQL.format('U_taxrate1000')})
    as taxes, 'General' as attribute, U_SubGrp3 as attribute_set, U_SubGrp1 as sub_brand,
    rtrim(U_SubGrp5) as default_size, U_SubGrp3 as grouping_name from erp_items""",
    "erp_items",
)
def item_document(spark, folder):
    t = erp(spark, folder)
    rows = t["items"].select(*items.item_columns(RULES, _c("ItemName")))
    docs = items.item_documents(rows, RULES)
    band = F.transform(
        _c("ProductTaxes")[0], lambda b: F.concat(b["EvalExpression"], F.lit("="), b["TaxPer"])
    )
    return docs.select("*", F.explode("ProductColors").alias("c")).select(
        _c("ProductCode").alias("code"),
        _c("Product.ProductName").alias("product_name"),
        _c("Product.DivisionCode").alias("division"),
        _c("c.ColorCode").alias("color_code"),
        _c("c.ColorName").alias("color_name"),
        _c("c.Min_Qty").alias("min_qty"),
        _c("c.Max_Qty").alias("max_qty"),
        _c("c.IsCoreColor").alias("is_core"),
        F.array_join(band, ",").alias("taxes"),
        _c("ProductAttributes")[0]["Attribute"]["AttributeName"].alias("attribute"),
        _c("ProductAttributes")[0]["AttributeSet"]["AttributeSetName"].alias("attribute_set"),
        _c("ProductSubBrands")[0]["SubBrandCode"].alias("sub_brand"),
        _c("ProductDefaults")[0]["SizeCode"].alias("default_size"),
        _c("ProductGroupGroupping")[0]["GroupingName"].alias("grouping_name"),
    )


@query(
    "price_document",
    """select cast(item_id as varchar) as code, book_id as price_list_id,
    cast(state_id as varchar) as list_code, cast(item_id as varchar) as shown_name,
    '2060-12-31T00:00:00' as effective_to, 1 as is_active, line_id as price_id,
    cast(price as double) as price, 0.0::double as mrp from si_price_b""",
    "si_price_b",
)
def price_document(spark, folder):
    none = F.lit(None).cast("string")
    rows = views(spark, folder)("si_price_b").select(
        _c("item_id").cast("string").alias("ProductCode"),
        _c("book_id").alias("PriceListID"),
        _c("state_id").cast("string").alias("SubBrandCode"),
        none.alias("BPProductName"),
        _c("state_id").cast("string").alias("PriceListCode"),
        none.alias("EffectiveFrom"),
        none.alias("EffectiveTo"),
        none.cast("int").alias("PriceListIsActive"),
        F.lit("Dealer").alias("BPCategory"),
        _c("price").alias("Price"),
        none.cast("decimal(12,2)").alias("MRP"),
        _c("line_id").alias("PriceID"),
        F.lit(1).alias("PriceIsActive"),
    )
    return flat_prices(prices.price_documents(rows, RULES, moment(AS_OF)))


def flat_prices(docs):
    """Price documents, one row per price."""
    return (
        docs.select(_c("ProductCode").alias("code"), F.explode("PriceList").alias("l"))
        .select("code", "l", F.explode("l.Prices").alias("p"))
        .select(
            "code",
            _c("l.PriceListID").alias("price_list_id"),
            _c("l.PriceLisCode").alias("list_code"),
            _c("l.BPProductName").alias("shown_name"),
            _c("l.EffectiveTo").alias("effective_to"),
            _c("l.IsActive").alias("is_active"),
            _c("p.PriceID").alias("price_id"),
            _c("p.Price").alias("price"),
            _c("p.MRP").alias("mrp"),
        )
    )


_FIRST_LINE_SQL = """first_line as (select * from (select *, row_number() over
 (partition by DocEntry order by LineId, U_Qual, U_bran, U_Discunt, U_Stat nulls first, U_BillsQty,
 U_OffersQty) as rn from erp_scheme_lines) where rn=1)"""


@query(
    "scheme_document",
    f"""with {_FIRST_LINE_SQL} select s.DocEntry as policy_id, Object||s.DocEntry
    as policy_number, 2 as revision, Remark as policy_name, case U_Discunt when 'Quantity'
    then 'SC' when 'Percentage' then 'DIS' end as saving_type, case when
    try_cast(substr(U_bran,7) as int) between 1 and 12 then 'EAST' when
    try_cast(substr(U_bran,7) as int) between 13 and 21 then 'WEST' end as division,
    '1998-06-30T00:00:00' as from_date, cast(nullif(coalesce(n,0),0) as int) as state_count, first_state,
    'RBM,SE' as roles, true as no_partner from erp_schemes s join first_line l
    on s.DocEntry=l.DocEntry left join (select DocEntry, count(distinct Name) as n,
    min(Name) as first_state from erp_scheme_lines join erp_states on U_Stat=Code
    group by DocEntry) c on c.DocEntry=s.DocEntry""",
    "erp_schemes erp_scheme_lines erp_states",
)
def scheme_document(spark, folder):
    t = erp(spark, folder)
    docs = schemes.scheme_documents(t, t["schemes"], RULES, moment(AS_OF))
    roles = F.transform("Policy.RoleMapping", lambda r: r["Role"])
    return heads(docs).select(
        _c("PolicyID").alias("policy_id"),
        _c("Policy.PolicyNumber").alias("policy_number"),
        _c("Policy.Revision").alias("revision"),
        _c("Policy.PolicyName").alias("policy_name"),
        _c("Policy.SavingType").alias("saving_type"),
        _c("Policy.DivisionCode").alias("division"),
        _c("Policy.FromDate").alias("from_date"),
        F.size("Policy.StateMapping").alias("state_count"),
        _c("Policy.StateMapping")[0]["StateCode"].alias("first_state"),
        F.array_join(roles, ",").alias("roles"),
        _c("Policy.SC_BpInclution")[0]["BPCode"].isNull().alias("no_partner"),
    )


_PHONE_SQL = """case when regexp_full_match(right(coalesce(Phone1,''),10),'[0-9]{10}')
 then right(Phone1,10) when regexp_full_match(right(coalesce(Phone2,''),10),'[0-9]{10}')
 then right(Phone2,10) when regexp_full_match(right(coalesce(Cellular,''),10),'[0-9]{10}')
 then right(Cellular,10) else '9999999999' end"""

_ACTIVE_SQL = "CardType='C' and validFor='Y' and rtrim(U_AreaCode)<>''"


@query(
    "partner_document",
    f"""select p.CardCode as bp_code, coalesce(Currency,'INR') as currency,
    coalesce(CardFName,CardName) as display_name, case when GroupCode in ('100','106')
    then 'Dealer' else '' end as category, case when coalesce(U_Grade,'') in ('','-') then 'C'
    else replace(U_Grade,'Grade','') end as grade, '0.00' as latitude, CntctCode as contact_id,
    division as contact_division, coalesce(Position,'proprietor') as designation,
    {_PHONE_SQL} as mobile, case when Active='Y' then 1 else 0 end as contact_active,
    cast((select count(*) from erp_addresses a where a.CardCode=p.CardCode) as int) as addresses,
    2 as divisions, cast(coalesce(U_Dis3,0) as double) as knits_discount
    from erp_partners p join erp_contacts c on c.CardCode=p.CardCode
    cross join (values ('EAST'),('WEST')) t(division) where {_ACTIVE_SQL}""",
    "erp_partners erp_contacts erp_addresses",
)
def partner_document(spark, folder):
    docs = partners.partner_documents(erp(spark, folder), RULES)
    return docs.select("*", F.explode("Map_BpContactDetails").alias("c")).select(
        _c("BPCode").alias("bp_code"),
        _c("DefaultCurrency").alias("currency"),
        _c("DisplayName").alias("display_name"),
        _c("BPCategory").alias("category"),
        _c("GradeOfBP").alias("grade"),
        _c("Latitude").alias("latitude"),
        _c("c.ContactPersonID").alias("contact_id"),
        _c("c.DivisionCode").alias("contact_division"),
        _c("c.Designation").alias("designation"),
        _c("c.MobileNum").alias("mobile"),
        _c("c.IsActive").alias("contact_active"),
        F.size("BillShipTo").alias("addresses"),
        F.size("MST_MAP_BP_Division").alias("divisions"),
        _c("MST_Map_BP_SubBrand")[1]["DiscountPer"].alias("knits_discount"),
    )


@query(
    "address_struct",
    f"""select a.CardCode as bp_code, cast(DocEntry as varchar)||LineNum as bill_ship_id,
    AdresType as type, case when AdresType='B' then 'OFFICE' else 'SHIP' end as location_name,
    coalesce(nullif(Building,''), a.City, '') as line1, coalesce(a.City,'') as line2,
    case when ShipToDef=Address then 1 else 0 end as is_default, coalesce(a.City,'') as city,
    coalesce(County, Country, '') as county, case upper(trim(State)) when 'TN' then 'Tamil Nadu'
    when 'KA' then 'Karnataka' else coalesce(State,'') end as state, case Country when 'IN'
    then 'India' else Country end as country, coalesce(ZipCode,'') as zip, {_PHONE_SQL} as phone,
    coalesce(E_Mail,'') as email from erp_addresses a join erp_partners p on a.CardCode=p.CardCode
    where {_ACTIVE_SQL}""",
    "erp_addresses erp_partners",
)
def address_struct(spark, folder):
    t = erp(spark, folder)
    rows = partners.partner_addresses(t, partners.active_partners(t, RULES))
    nested = rows.withColumn("a", partners.address_struct())
    return nested.select(
        _c("BPCode").alias("bp_code"),
        _c("BillShipID").alias("bill_ship_id"),
        _c("Type").alias("type"),
        _c("LocationName").alias("location_name"),
        _c("a.Line1").alias("line1"),
        _c("a.Line2").alias("line2"),
        _c("a.IsDefault").alias("is_default"),
        _c("a.City").alias("city"),
        _c("a.County").alias("county"),
        _c("a.State").alias("state"),
        _c("a.Country").alias("country"),
        _c("a.ZipCode").alias("zip"),
        _c("a.PhoneNumber").alias("phone"),
        _c("a.Email").alias("email"),
    )


@query(
    "safe_json_array",
    """select event_id, cast(case event_type when 'click' then 2 when 'view' then 1 else 0 end
    as int) as elements, case when event_type in ('click','view') then
    cast(json_extract(props,'$.k') as bigint) * case event_type when 'click' then 2 else 1 end
    else 0 end as total from events""",
)
def safe_json_array(spark, folder):
    items_of = json_array(_list_text(), "struct<k:bigint>")
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, x: acc + x["k"])
    return (
        views(spark, folder)("events")
        .select("event_id", items_of.alias("items"))
        .select("event_id", F.size("items").alias("elements"), total.alias("total"))
    )


@query(
    "json_rejects",
    """select case event_type when 'signup' then 'not JSON' else 'no list' end as reason,
    event_type, count(*) as n, min(event_id) as first_id from events
    where event_type in ('signup', 'purchase') group by 1, 2""",
)
def json_rejects(spark, folder):
    number = F.get_json_object("props", "$.k")  # JSON, but no list
    text = F.when(_c("event_type") == "purchase", number).otherwise(_list_text())
    rows = views(spark, folder)("events").withColumn("text", text)
    _, rejects = split_rejects(rows, ["event_id", "event_type"], "text", "struct<k:bigint>")
    return rejects.groupBy("reason", "event_type").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id")
    )


def _list_text():
    """Event properties as lists, objects, null, blank and broken text, by kind of event."""
    kind, props = _c("event_type"), _c("props")
    return (
        F.when(kind == "click", F.concat(F.lit(" ["), props, F.lit(","), props, F.lit("]")))
        .when(kind == "view", props)
        .when(kind == "error", "null")
        .when(kind == "signup", F.concat(F.lit("["), props, F.lit(", oops")))
        .when(kind == "purchase", "")
    )


@query(
    "stock_record",
    """select cast(DocEntry as varchar) as mapping_id, ItemCode as code,
    trunc(OnHand)::double as quantity, validFor='Y' as is_active, rtrim(U_SubGrp5) as size,
    case when MinLevel>OnHand then 'High Stock' else 'Low Stock' end as highlight,
    case when trunc(MinLevel)>trunc(OnHand) then 'Very few stock left' else 'Stock Available'
    end as message from erp_items join erp_stock using (ItemCode) where WhsCode='W0'
    and validFor='Y' and U_SubGrp1 not in ('Brand#3','Brand#7') and trunc(OnHand)>0""",
    "erp_items erp_stock",
)
def stock_record(spark, folder):
    return flat_stock(stock.stock_records(stock.stock_rows(erp(spark, folder), RULES)))


def flat_stock(records):
    """Stock records under short names."""
    return records.select(
        _c("ProductMappingId").alias("mapping_id"),
        _c("ProductCode").alias("code"),
        _c("StockQuantity").alias("quantity"),
        _c("IsActive").alias("is_active"),
        _c("Size").alias("size"),
        _c("StockHighlightMessageDetails").alias("highlight"),
        _c("StockMessage").alias("message"),
    )


OPEN_SQL = f"""open_rows as (select case when U_Brand like '%Brand#1%' then 'EAST' else 'WEST' end
 as division, U_Brand as brand, case j.TransType when '13' then 'AR Invoice' when '30'
 then 'Journal' end as doc_type, case when regexp_full_match(l.Ref1,'[0-9]+')
 then cast(l.Ref1 as bigint) end as invoice_no, strftime(DocDate,'%Y-%m-%d') as invoice_date,
 strftime(case when l.TransType in ('-2','30') then DueDate else RefDate end,
 '%Y-%m-%d %H:%M:%S.000') as due_date, ShortName as card_code, CardName as card_name,
 a.City as city, a.State as state, memo as remarks, cast(case when BalDueDeb>0 then
 date_diff('day', case when l.TransType in ('-2','30') then DueDate else RefDate end,
 timestamp '{AS_OF}') else 0 end as int) as overdue_days,
 cast(case when j.TransType='30' then Debit else coalesce(DocTotal,0) end as double) as value,
 cast(BalDueDeb as double) as balance, BalDueDeb from erp_journal_lines l
 join erp_journal j on j.TransId=l.TransId
 join erp_partners p on p.CardCode=l.ShortName and CardType='C'
 and GroupCode in (select GroupCode from erp_partner_groups)
 left join erp_invoices i on cast(i.DocNum as varchar)=l.Ref1 and i.CardCode=l.ShortName
 and i.TransId=l.TransId
 left join erp_addresses a on a.CardCode=l.ShortName and a.AdresType='B'
 where BalDueDeb<>0)"""
OPEN_VIEWS = (
    "erp_journal_lines erp_journal erp_partners erp_partner_groups erp_invoices erp_addresses"
)


@query(
    "receivable_record",
    f"with {OPEN_SQL} select * exclude (BalDueDeb) from open_rows",
    OPEN_VIEWS,
)
def receivable_record(spark, folder):
    rows = receivables.receivable_rows(erp(spark, folder), RULES, AS_OF)
    return flat_receivables(receivables.receivable_records(rows))


def flat_receivables(records):
    """Receivable records under short names."""
    names = {
        "division": "DivisionCode",
        "brand": "Brand",
        "doc_type": "DocType",
        "invoice_no": "InvoiceNo",
        "invoice_date": "InvoiceDate",
        "due_date": "DueDate",
        "card_code": "CardCode",
        "card_name": "CardName",
        "city": "City",
        "state": "STATE",
        "remarks": "DocumentRemarks",
        "overdue_days": "OverdueDays",
        "value": "DocumentValue",
        "balance": "BalanceToBePaid",
    }
    return records.select(*[_c(old).alias(new) for new, old in names.items()])


@query(
    "merge_first_wins",
    """select bp_id, arg_min(brand, (doc_date, doc_num)) filter (brand is not null) as first_brand,
    arg_min(doc_num, (doc_date, doc_num)) filter (brand is not null) as first_doc
    from si_invoice group by bp_id""",
    "si_invoice",
)
def merge_first_wins(spark, folder):
    order = ["doc_date", "doc_num"]
    branded = F.when(_c("brand").isNotNull(), _c("doc_num"))
    return views(spark, folder)("si_invoice").groupBy("bp_id").agg(
        first_non_null(_c("brand"), order).alias("first_brand"),
        first_non_null(branded, order).alias("first_doc"),
    )
