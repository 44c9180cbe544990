"""Scalar expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.fixed_values import STATE_NAMES, TAX_REMAP
from outledger.functions import choose, dates, numeric, text
from outledger.queries.registry import query
from outledger.queries.views import AS_OF, views

_c = F.col


def _names_sql() -> str:
    return ", ".join(f"('{k}','{v}')" for k, v in STATE_NAMES.items())


@query("null_default", "select bp_id, coalesce(area,'none') as area, coalesce(phone1,phone2,'') as phone from si_partner", "si_partner")
def null_default(spark, folder):
    return views(spark, folder)("si_partner").select(
        "bp_id",
        choose.null_default(_c("area"), F.lit("none")).alias("area"),
        choose.null_default(_c("phone1"), _c("phone2"), F.lit("")).alias("phone"),
    )


@query(
    "falsy_default",
    """select ItemCode as item_code, cast(case when MinLevel is null or MinLevel=0 then 1
    else MinLevel end as double) as min_qty,
    cast(case when MaxLevel is null or MaxLevel=0 then 100000 else MaxLevel end as double)
    as max_qty from erp_items""",
    "erp_items",
)
def falsy_default(spark, folder):
    return views(spark, folder)("erp_items").select(
        _c("ItemCode").alias("item_code"),
        choose.falsy_default(_c("MinLevel"), 1).alias("min_qty"),
        choose.falsy_default(_c("MaxLevel"), 100000).alias("max_qty"),
    )


@query(
    "blank_to_null_chain",
    """select CardCode as bp_code, LineNum as line_num,
    coalesce(nullif(rtrim(Building),''), City) as line1,
    coalesce(nullif(rtrim(Block),''), City) as line2 from erp_addresses""",
    "erp_addresses",
)
def blank_to_null_chain(spark, folder):
    return views(spark, folder)("erp_addresses").select(
        _c("CardCode").alias("bp_code"),
        _c("LineNum").alias("line_num"),
        choose.blank_chain(_c("Building"), _c("City")).alias("line1"),
        choose.blank_chain(_c("Block"), _c("City")).alias("line2"),
    )


@query(
    "rtrim_text",
    "select ItemCode as item_code, rtrim(U_SubGrp5) as size_code, length(rtrim(U_SubGrp6)) as n from erp_items".replace(
        "length(rtrim(U_SubGrp6))", "cast(length(rtrim(U_SubGrp6)) as int)"
    ),
    "erp_items",
)
def rtrim_text(spark, folder):
    return views(spark, folder)("erp_items").select(
        _c("ItemCode").alias("item_code"),
        F.rtrim("U_SubGrp5").alias("size_code"),
        F.length(F.rtrim("U_SubGrp6")).alias("n"),
    )


@query(
    "concat_null_empty",
    """select bp_id, concat(grp, area, cast(bp_id as varchar)) as blank_reading,
    grp||area||cast(bp_id as varchar) as null_reading from si_partner""",
    "si_partner",
)
def concat_null_empty(spark, folder):
    parts = [_c("grp"), _c("area"), _c("bp_id")]
    return views(spark, folder)("si_partner").select(
        "bp_id",
        text.concat_blank(*parts).alias("blank_reading"),
        text.concat_null(*parts).alias("null_reading"),
    )


@query(
    "replace_text",
    """select CardCode as bp_code, case when rtrim(coalesce(U_Grade,'')) in ('','-') then 'C'
    else replace(U_Grade,'Grade','') end as grade, replace(U_Grade,'Grade ','') as short_grade
    from erp_partners""",
    "erp_partners",
)
def replace_text(spark, folder):
    return views(spark, folder)("erp_partners").select(
        _c("CardCode").alias("bp_code"),
        text.clean_grade(_c("U_Grade")).alias("grade"),
        F.replace(_c("U_Grade"), F.lit("Grade "), F.lit("")).alias("short_grade"),
    )


@query(
    "first_valid_phone",
    """select bp_id, case when regexp_full_match(right(coalesce(phone1,''),10),'[0-9]{10}')
    then right(phone1,10) when regexp_full_match(right(coalesce(phone2,''),10),'[0-9]{10}')
    then right(phone2,10) else '9999999999' end as phone from si_partner""",
    "si_partner",
)
def first_valid_phone(spark, folder):
    return views(spark, folder)("si_partner").select(
        "bp_id", text.first_phone(_c("phone1"), _c("phone2")).alias("phone")
    )


@query(
    "digits_to_int",
    """select trans_id, line_no, item_id, case when regexp_full_match(ref1,'[0-9]+')
    then cast(ref1 as bigint) end as invoice_no from si_journal_line""",
    "si_journal_line",
)
def digits_to_int(spark, folder):
    return views(spark, folder)("si_journal_line").select(
        "trans_id", "line_no", "item_id", numeric.digits_to_int(_c("ref1")).alias("invoice_no")
    )


@query(
    "trunc_int",
    """select l_orderkey, l_linenumber, l_partkey, cast(trunc(l_extendedprice) as int) as whole
    from lineitem""",
)
def trunc_int(spark, folder):
    return views(spark, folder)("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numeric.trunc_int(_c("l_extendedprice")).alias("whole"),
    )


@query(
    "to_decimal",
    """select trans_id, line_no, item_id,
    cast(cast(balance as decimal(10,1)) as double) as rounded from si_journal_line""",
    "si_journal_line",
)
def to_decimal(spark, folder):
    return views(spark, folder)("si_journal_line").select(
        "trans_id", "line_no", "item_id", numeric.to_decimal(_c("balance"), 10, 1).alias("rounded")
    )


@query(
    "days_overdue",
    f"""select trans_id, line_no, item_id, cast(case when balance>0
    then date_diff('day', due_date, timestamp '{AS_OF}') else 0 end as int) as overdue
    from si_journal_line""",
    "si_journal_line",
)
def days_overdue(spark, folder):
    late = dates.days_overdue(_c("balance"), _c("due_date"), dates.moment(AS_OF))
    return views(spark, folder)("si_journal_line").select(
        "trans_id", "line_no", "item_id", late.alias("overdue")
    )


@query(
    "effective_due_date",
    """select trans_id, line_no, item_id, cast(case when trans_type in ('-2','30') then due_date
    else ref_date end as date) as due from si_journal_line join si_journal using (trans_id)""",
    "si_journal_line si_journal",
)
def effective_due_date(spark, folder):
    v = views(spark, folder)
    joined = v("si_journal_line").join(v("si_journal"), "trans_id")
    due = dates.effective_due(_c("trans_type"), _c("due_date"), _c("ref_date"))
    return joined.select("trans_id", "line_no", "item_id", F.to_date(due).alias("due"))


@query(
    "format_date",
    """select ref_id, strftime(punch_time,'%Y-%m-%d') as day,
    strftime(punch_time,'%Y-%m-%dT%H:%M:%S') as iso,
    strftime(punch_time,'%Y-%m-%d %H:%M:%S.')||lpad(cast(millisecond(punch_time)%1000 as varchar),3,'0')
    as millis, null::varchar as unparsable from si_punch""",
    "si_punch",
)
def format_date(spark, folder):
    ts = _c("punch_time")
    return views(spark, folder)("si_punch").select(
        "ref_id",
        dates.date_text(ts).alias("day"),
        dates.iso_text(ts).alias("iso"),
        dates.millis_text(ts).alias("millis"),
        dates.date_text(_c("punch_type")).alias("unparsable"),
    )


@query(
    "format_fixed2",
    """select CardCode as bp_code, cast(cast(coalesce(U_Dis3,0) as decimal(18,2)) as varchar)
    as dis3, cast(cast(U_Dis1 as decimal(18,2)) as varchar) as dis1 from erp_partners""",
    "erp_partners",
)
def format_fixed2(spark, folder):
    return views(spark, folder)("erp_partners").select(
        _c("CardCode").alias("bp_code"),
        numeric.fixed2(_c("U_Dis3")).alias("dis3"),
        numeric.fixed2(_c("U_Dis1")).alias("dis1"),
    )


@query(
    "tax_remap",
    """select ItemCode as item_code, case cast(cast(U_taxrate as decimal(18,2)) as varchar)
    when '12.00' then '18.00' else cast(cast(U_taxrate as decimal(18,2)) as varchar) end as tax
    from erp_items""",
    "erp_items",
)
def tax_remap(spark, folder):
    return views(spark, folder)("erp_items").select(
        _c("ItemCode").alias("item_code"), numeric.tax_text(_c("U_taxrate"), TAX_REMAP).alias("tax")
    )


@query(
    "code_to_name",
    f"""select CardCode as bp_code, LineNum as line_num, case when State<>''
    then coalesce(name, State) end as state_name, coalesce(case when State<>''
    then coalesce(name, State) end, '') as shown from erp_addresses
    left join (values {_names_sql()}) t(code, name) on upper(trim(State))=code""",
    "erp_addresses",
)
def code_to_name(spark, folder):
    name = choose.code_to_name(_c("State"), STATE_NAMES)
    return views(spark, folder)("erp_addresses").select(
        _c("CardCode").alias("bp_code"),
        _c("LineNum").alias("line_num"),
        name.alias("state_name"),
        F.coalesce(name, F.lit("")).alias("shown"),
    )


@query(
    "pick_column_by_name",
    """select bp_id, k as dim_name, cast(cast(case k when 'd1' then coalesce(d1,0)
    when 'd2' then coalesce(d2,0) when 'd3' then coalesce(d3,0) else 0 end as decimal(18,6))
    as double) as discount from si_partner cross join (values ('d1'),('d2'),('d3'),('d9')) t(k)""",
    "si_partner",
)
def pick_column_by_name(spark, folder):
    from outledger.operators.joins import with_dimension

    partners = views(spark, folder)("si_partner")
    rows = with_dimension(partners, [{"dim_name": n} for n in ("d1", "d2", "d3", "d9")])
    value = choose.by_column_name(_c("dim_name"), {n: _c(n) for n in ("d1", "d2", "d3")})
    return rows.select("bp_id", "dim_name", value.cast("decimal(18,6)").alias("discount"))


@query(
    "stock_messages",
    """select item_id, whs, case when min_level>on_hand then 'High Stock' else 'Low Stock' end
    as highlight, case when min_level>trunc(on_hand) then 'Very few stock left'
    else 'Stock Available' end as message from si_stock join si_item using (item_id)""",
    "si_stock si_item",
)
def stock_messages(spark, folder):
    v = views(spark, folder)
    highlight, message = choose.stock_labels(_c("min_level"), _c("on_hand"))
    return v("si_stock").join(v("si_item"), "item_id").select(
        "item_id", "whs", highlight.alias("highlight"), message.alias("message")
    )


@query(
    "to_number_or_null",
    """select bp_id, try_cast(nullif(phone1,'') as double) as phone_number,
    try_cast(nullif(area,'') as double) as area_number from si_partner""",
    "si_partner",
)
def to_number_or_null(spark, folder):
    return views(spark, folder)("si_partner").select(
        "bp_id",
        numeric.number_or_null(_c("phone1")).alias("phone_number"),
        numeric.number_or_null(_c("area")).alias("area_number"),
    )


@query(
    "truncate_text",
    """select seq, nullif(left(repeat(error||';', 300), 2000),'') as error_message
    from si_status_event""",
    "si_status_event",
)
def truncate_text(spark, folder):
    long_text = F.repeat(F.concat("error", F.lit(";")), F.lit(300))
    return views(spark, folder)("si_status_event").select(
        "seq", text.truncate_text(long_text).alias("error_message")
    )


@query(
    "composite_text_key",
    """select ref_id, coalesce(cast(emp_id as varchar),'UNKNOWN')||':'||ref_id as child_key,
    coalesce(cast(emp_id as varchar),'UNKNOWN') as parent_key from si_punch""",
    "si_punch",
)
def composite_text_key(spark, folder):
    keyed = views(spark, folder)("si_punch").withColumn(
        "child_key", text.composite_key(_c("emp_id"), _c("ref_id"))
    )
    return keyed.select("ref_id", "child_key", text.parent_of(_c("child_key")).alias("parent_key"))


@query(
    "local_day",
    """select ref_id, cast(punch_time as date) as raw_day,
    cast(punch_time + interval '5 hours 30 minutes' as date) as business_day from si_punch""",
    "si_punch",
)
def local_day(spark, folder):
    return views(spark, folder)("si_punch").select(
        "ref_id",
        dates.local_day(_c("punch_time")).alias("raw_day"),
        dates.local_day(_c("punch_time"), "Asia/Kolkata").alias("business_day"),
    )
