"""Business-shaped views over the test tables.

Each view is one SELECT that means the same in Spark and in the checking
database; names in braces are the tables and views it reads. Doubles are cast to decimal before
any arithmetic, as rounding the result of double arithmetic differs between engines.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from outledger.sources.schemas import TEST
from outledger.sources.tables import scan

AS_OF = "1998-06-30 00:00:00"

# name: (what it reads, SELECT)
VIEWS: dict[str, tuple[str, str]] = {
    "si_item": (
        "part",
        """select p_partkey as item_id, p_name as item_name, p_brand as brand, p_type as grp,
        split_part(p_name,' ',1) as style, p_size as size, p_size*10 as min_level,
        case when p_partkey%17=0 then 'N' else 'Y' end as valid, p_retailprice as list_price
        from {part}""",
    ),
    "si_stock": (
        "lineitem",
        """select l_partkey as item_id, l_suppkey%3 as whs,
        sum(cast(l_quantity as decimal(12,2))) as on_hand from {lineitem} group by 1, 2""",
    ),
    "si_price_a": (
        "lineitem supplier",
        """select l_partkey as item_id, s_nationkey as state_id, l_orderkey as book_id,
        l_linenumber as line_id, cast(l_extendedprice as decimal(12,2)) as price,
        l_shipdate as valid_from, l_shipdate + interval 365 day as valid_to, l_discount as disc,
        l_suppkey as supp_id
        from {lineitem} join {supplier} on l_suppkey=s_suppkey""",
    ),
    "si_price_b": (
        "part nation",
        """select p_partkey as item_id, n_nationkey as state_id, cast(-1 as bigint) as book_id,
        n_nationkey as line_id, cast(p_retailprice as decimal(12,2)) as price
        from {part} join {nation} on n_nationkey%5=p_partkey%5""",
    ),
    "si_partner": (
        "customer",
        """select c_custkey as bp_id, c_name as bp_name, c_mktsegment as grp,
        case when c_custkey%7=0 then '' when c_custkey%11=0 then null
        else 'A'||cast(c_nationkey as string) end as area, c_nationkey as state_id,
        cast(cast(c_acctbal as decimal(12,2))*cast(0.01 as decimal(4,2)) as decimal(12,2)) as d1,
        cast(cast(c_acctbal as decimal(12,2))*cast(0.005 as decimal(6,3)) as decimal(12,2)) as d2,
        case when c_custkey%2=0 then cast(1 as decimal(12,2)) end as d3,
        case c_custkey%4 when 0 then '12345'
        when 1 then '+91'||lpad(cast(c_custkey as string),10,'7') when 2 then null
        else '98x7654321' end as phone1,
        case when c_custkey%3=0 then lpad(cast(c_custkey as string),10,'8') end as phone2
        from {customer}""",
    ),
    "si_address": (
        "customer nation region",
        """select c_custkey as bp_id, 'B' as addr_type, c_custkey*10+1 as addr_id, n_name as city,
        case when c_custkey%5=0 then null else r_name end as state
        from {customer} join {nation} on c_nationkey=n_nationkey
        join {region} on n_regionkey=r_regionkey
        union all
        select c_custkey, case when c_custkey%3=0 then 'T' else 'S' end, c_custkey*10+2, n_name,
        case when c_custkey%5=0 then null else r_name end
        from {customer} join {nation} on c_nationkey=n_nationkey
        join {region} on n_regionkey=r_regionkey""",
    ),
    "si_contact": (
        "orders",
        """select distinct o_custkey as bp_id, o_orderpriority as contact_name
        from {orders}""",
    ),
    "si_journal": (
        "orders",
        """select o_orderkey as trans_id, o_custkey as bp_id, o_orderdate as ref_date,
        case o_orderstatus when 'F' then '13' when 'O' then '30' else '-2' end as trans_type
        from {orders}""",
    ),
    "si_journal_line": (
        "lineitem",
        """select l_orderkey as trans_id, l_linenumber as line_no,
        case when l_returnflag='R' then cast(0 as decimal(12,2)) else
        cast(cast(l_extendedprice as decimal(12,2))*(1-cast(l_discount as decimal(4,2)))
        as decimal(12,2)) end as balance, l_shipdate as due_date,
        case when l_linenumber=7 then 'x'||cast(l_orderkey as string)
        else cast(l_orderkey as string) end as ref1, l_partkey as item_id, l_suppkey as supp_id,
        cast(l_extendedprice as decimal(12,2)) as debit
        from {lineitem}""",
    ),
    "si_invoice": (
        "orders",
        """select o_orderkey as doc_num, o_custkey as bp_id, o_orderkey as trans_id,
        o_orderdate as doc_date, cast(o_totalprice as decimal(12,2)) as doc_total,
        case when o_orderkey%3=0 then null
        else 'Brand#'||cast(o_orderkey%25 as string)||'  ' end as brand, o_orderstatus as doc_status
        from {orders}""",
    ),
    "si_scheme": (
        "orders",
        """select o_orderkey as scheme_id, o_orderdate as from_date,
        o_orderdate+interval 90 day as to_date,
        case when o_orderkey%2=0 then 'Quantity' else 'Percentage' end as basis, o_orderpriority as priority
        from {orders}""",
    ),
    "si_scheme_line": (
        "lineitem part supplier",
        """select l_orderkey as scheme_id, l_linenumber as line_no, p_type as grp,
        p_brand as brand, split_part(p_name,' ',1) as style,
        l_partkey as item_id, l_quantity as min_qty, l_tax*100 as free_qty,
        s_nationkey as state_id, l_suppkey as supp_id,
        cast(l_extendedprice as decimal(12,2)) as price
        from {lineitem} join {part} on l_partkey=p_partkey
        join {supplier} on l_suppkey=s_suppkey""",
    ),
    "si_punch": (
        "events",
        """select event_id as ref_id, case when user_id%13=0 then null else user_id end as emp_id,
        case when event_type in ('click','signup') then 'I' else 'O' end as punch_type,
        ts as punch_time from {events}""",
    ),
    "si_status_event": (
        "events",
        """select user_id as record_key, ts, event_id as seq,
        case when event_type in ('purchase','click') then 'Pushed' when event_type='error'
        then 'Failed' else 'Pushing' end as status,
        case when event_type='error' then props end as error from {events}""",
    ),
    "si_response": (
        "events",
        """select cast(floor(event_id/3) as bigint) as request_id,
        cast(event_id%3+1 as int) as attempt,
        case event_type when 'error' then 500 when 'signup' then 404 when 'view' then 429
        else 200 end as http_status,
        case when value<10 then '{{"success":false}}' when value>80 then '{{"errorCode":"E1"}}'
        else props end as body,
        cast(ts as date) as run_day, user_id as record_key, event_id as seq
        from {events}""",
    ),
    # One record-status row per key, as the event log leaves it.
    "si_status": (
        "si_status_event",
        """select cast(record_key as string) as record_key,
        max_by(status, seq) as push_status,
        max(case when status in ('Pushed','Failed') then ts end) as last_pushed_at,
        nullif(max_by(coalesce(error,''), seq), '') as error_message,
        max(ts) as updated_at
        from {si_status_event} group by record_key""",
    ),
    "si_punch_log": (
        "events",
        """select event_id as id, cast(event_id as string) as ref_id,
        cast(user_id as string) as employee_id,
        case when event_type in ('click','signup') then 'I' else 'O' end as punch_type,
        ts as punch_time, ts + interval 1 hour as capture_time,
        case when value<30 then 'Pending' when value<60 then 'Failed' else 'Pushed' end
        as push_status from {events}""",
    ),
    # Delivery batches of five datasets, one per reply.
    "si_batch": (
        "events",
        """select case event_type when 'click' then 'products' when 'view' then 'pricelists'
        when 'purchase' then 'schemes' when 'signup' then 'businesspartners'
        else 'outstanding' end as sync_type, event_id as batch_no,
        value<70 and event_type<>'error' as ok, cast(event_id%50+1 as bigint) as size
        from {events}""",
    ),
    # ---- ERP-shaped tables, for the dataset plans -------------------------------
    "erp_items": (
        "part",
        """select cast(p_partkey as string) as ItemCode, p_name as ItemName,
        case when p_partkey%17=0 then 'N' else 'Y' end as validFor, p_size as ItmsGrpCod,
        p_partkey as DocEntry, p_brand as U_SubGrp1, p_type as U_SubGrp3,
        split_part(p_name,' ',1) as U_SubGrp4, cast(p_size as string)||'  ' as U_SubGrp5,
        split_part(p_name,' ',2)||' ' as U_SubGrp6, p_type as U_SubGrp7,
        case when p_size%2=0 then upper(split_part(p_name,' ',2)) end as U_SubGrp11,
        case when p_size<10 then 'Core item' end as U_SubGrp13,
        cast(null as string) as U_SubGrp17, cast(p_size as string) as U_Size,
        'EA' as SalPackMsr, cast(p_size as decimal(18,6)) as SalPackUn,
        p_brand||'/'||cast(p_size as string) as U_HSNCODE,
        cast(p_size*10 as decimal(18,6)) as MinLevel,
        cast(p_size%5*100 as decimal(18,6)) as MaxLevel,
        cast(case p_size%3 when 0 then 12 when 1 then 5 end as decimal(18,6)) as U_taxrate,
        cast(18 as decimal(18,6)) as U_taxrate1000
        from {part}""",
    ),
    "erp_item_groups": ("part", "select distinct p_size as ItmsGrpCod from {part}"),
    "erp_stock": (
        "si_stock",
        """select cast(item_id as string) as ItemCode, 'W'||cast(whs as string) as WhsCode,
        cast(on_hand as decimal(18,6)) as OnHand from {si_stock}""",
    ),
    "erp_size_books": (
        "orders",
        """select o_orderkey as DocEntry, 'ALL' as U_SubGroup3, o_orderdate as U_ValidFrom,
        o_orderdate + interval 365 day as U_ValidTo from {orders}""",
    ),
    "erp_size_book_lines": (
        "lineitem part",
        """select DocEntry, LineId, p_brand as U_SubGroup1,
        split_part(p_name,' ',1) as U_SubGroup4, p_type as U_SubGroup7
        from (select l_orderkey as DocEntry, l_linenumber as LineId, min(l_partkey) as pk
        from {lineitem} group by l_orderkey, l_linenumber) x join {part} on pk=p_partkey""",
    ),
    "erp_size_book_states": (
        "lineitem supplier",
        """select l_orderkey as DocEntry, cast(s_nationkey as string) as U_Code,
        case when l_discount>=0.05 then 'Y' else 'N' end as U_Selected
        from {lineitem} join {supplier} on l_suppkey=s_suppkey""",
    ),
    "erp_size_book_prices": (
        "lineitem part",
        """select l_orderkey as DocEntry, l_linenumber as U_UniqID,
        cast(p_size as string)||'  ' as U_Size,
        cast(case when l_returnflag='R' then 0 else l_extendedprice end as decimal(18,6))
        as U_SelPrice, cast(l_extendedprice as decimal(18,6)) as U_MRP
        from {lineitem} join {part} on l_partkey=p_partkey""",
    ),
    "erp_item_books": (
        "part",
        "select p_partkey as DocEntry, cast(p_partkey as string) as U_ItemCode from {part}",
    ),
    "erp_item_book_lines": (
        "part",
        """select p_partkey as DocEntry, 1 as LineId, p_brand as U_Brand, 'N' as U_Lock,
        'C1-'||cast(p_partkey as string) as U_CatalgCode from {part}
        union all
        select p_partkey, 2, p_brand, case when p_size%3=0 then 'Y' else 'N' end,
        'C2-'||cast(p_partkey as string) from {part}""",
    ),
    "erp_item_book_prices": (
        "si_price_b",
        """select item_id as DocEntry, line_id as LineId, state_id%2+1 as U_RowId,
        cast(state_id as string) as U_State,
        cast(case when state_id=3 then 0 else price end as decimal(18,6)) as U_SelPrice,
        cast(price+10 as decimal(18,6)) as U_MRP from {si_price_b}""",
    ),
    "erp_schemes": (
        "si_scheme",
        """select scheme_id as DocEntry, scheme_id+7000000 as DocNum, 'SCH' as Object,
        'Scheme '||cast(scheme_id as string) as Remark, from_date as U_FrmDt, to_date as U_ToDt
        from {si_scheme}""",
    ),
    "erp_scheme_lines": (
        "si_scheme_line",
        """select scheme_id as DocEntry, line_no as LineId,
        case when scheme_id%2=0 then 'Quantity' else 'Percentage' end as U_Discunt,
        brand as U_bran, case when state_id=7 then null else cast(state_id as string) end as U_Stat,
        grp as U_Qual, cast(min_qty as decimal(18,6)) as U_BillsQty,
        cast(cast(free_qty as int) as decimal(18,6)) as U_OffersQty from {si_scheme_line}""",
    ),
    "erp_states": (
        "nation",
        "select cast(n_nationkey as string) as Code, n_name as Name from {nation}",
    ),
    "erp_partners": (
        "si_partner customer",
        """select cast(bp_id as string) as CardCode, bp_name as CardName,
        case when bp_id%5=0 then null else upper(bp_name) end as CardFName,
        case when c_acctbal<0 then 'S' else 'C' end as CardType,
        case when state_id=24 then 'N' else 'Y' end as validFor,
        case grp when 'BUILDING' then '100' when 'MACHINERY' then '106' else '101' end as GroupCode,
        case when state_id%2=0 then 'INR' end as Currency,
        'City '||cast(state_id as string) as City, bp_id as DocEntry,
        'S'||cast(bp_id as string) as ShipToDef, phone1 as Phone1, phone2 as Phone2,
        case when bp_id%10=3 then lpad(cast(bp_id as string),10,'6') end as Cellular,
        case when state_id<20 then bp_name||'@x' end as E_Mail, cast(bp_id as string) as UpdateTS,
        area as U_AreaCode,
        case state_id%4 when 0 then 'Grade A' when 1 then '-' when 2 then null else 'B' end
        as U_Grade, cast(null as string) as U_GSTIN, 'R'||cast(state_id as string) as U_showcode,
        cast(null as string) as U_SalPriceCode,
        cast(d1 as decimal(18,6)) as U_Dis1, cast(d2 as decimal(18,6)) as U_Dis2,
        cast(d3 as decimal(18,6)) as U_Dis3, cast(null as decimal(18,6)) as U_Dis4,
        cast(null as decimal(18,6)) as U_Dis5, cast(null as decimal(18,6)) as U_Dis6,
        cast(7 as decimal(18,6)) as U_Dis7, cast(null as decimal(18,6)) as U_Dis8,
        cast(9 as decimal(18,6)) as U_Dis9, cast(10 as decimal(18,6)) as U_Dis10,
        cast(11 as decimal(18,6)) as U_Dis11
        from {si_partner} join {customer} on bp_id=c_custkey""",
    ),
    "erp_addresses": (
        "si_address",
        """select cast(bp_id as string) as CardCode, cast(addr_id%10 as int) as LineNum,
        addr_type as AdresType,
        addr_type||cast(bp_id as string) as Address,
        case when bp_id%2=0 then '' else 'Building '||cast(bp_id as string) end as Building,
        cast(null as string) as Block, 'Street '||cast(bp_id%100 as string) as Street,
        city as City, cast(null as string) as County,
        case state when 'AFRICA' then ' tn' when 'AMERICA' then 'KA' when 'ASIA' then 'XX'
        when 'EUROPE' then '' end as State,
        case when addr_type='B' then 'IN' else 'ZZ' end as Country,
        cast(600000+bp_id%1000 as string) as ZipCode from {si_address}""",
    ),
    "erp_contacts": (
        "si_contact",
        """select cast(bp_id as string) as CardCode,
        bp_id*10+cast(substr(contact_name,1,1) as bigint) as CntctCode, contact_name as Name,
        case when contact_name='1-URGENT' then 'owner' end as Position,
        cast(null as string) as E_MailL,
        case when contact_name='5-LOW' then 'N' else 'Y' end as Active from {si_contact}""",
    ),
    "erp_partner_groups": (
        "customer",
        """select distinct case c_mktsegment when 'BUILDING' then '100' when 'MACHINERY' then '106'
        else '101' end as GroupCode, 'Group' as GroupName from {customer}""",
    ),
    "erp_journal": (
        "si_journal",
        """select trans_id as TransId, ref_date as RefDate,
        'Memo '||cast(trans_id as string) as memo, trans_type as TransType from {si_journal}""",
    ),
    "erp_journal_lines": (
        "si_journal_line si_journal",
        """select l.trans_id as TransId, cast(bp_id as string) as ShortName,
        cast(debit as decimal(18,6)) as Debit, cast(balance as decimal(18,6)) as BalDueDeb,
        ref1 as Ref1, due_date as DueDate, trans_type as TransType
        from {si_journal_line} l join {si_journal} j on l.trans_id=j.trans_id""",
    ),
    "erp_invoices": (
        "si_invoice",
        """select doc_num as DocNum, doc_num+5 as DocEntry, doc_date as DocDate,
        cast(doc_total as decimal(18,6)) as DocTotal, cast(bp_id as string) as CardCode,
        brand as U_Brand, trans_id as TransId from {si_invoice}""",
    ),
}

# The same views as plain SQL text, for the checking side.
SQL_VIEWS = {
    name: (
        " ".join(u for u in uses.split() if u in VIEWS),
        body.format(**{u: u for u in uses.split()}),
    )
    for name, (uses, body) in VIEWS.items()
}

ERP_TABLES = [name.removeprefix("erp_") for name in VIEWS if name.startswith("erp_")]


def views(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Access by name to the test tables and the views over them."""
    known: dict[str, DataFrame] = {}

    def build(name: str) -> DataFrame:
        if name in TEST:
            return scan(spark, folder, name, TEST)
        uses, body = VIEWS[name]
        return spark.sql(body, **{u: get(u) for u in uses.split()})

    def get(name: str) -> DataFrame:
        if name not in known:
            known[name] = build(name)
        return known[name]

    return get


class ErpTables(Mapping):
    """The ERP-shaped tables by role, each defined when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._get = views(spark, folder)

    def __getitem__(self, role: str) -> DataFrame:
        if role not in ERP_TABLES:
            raise KeyError(role)
        return self._get(f"erp_{role}")

    def __iter__(self) -> Iterator[str]:
        return iter(ERP_TABLES)

    def __len__(self) -> int:
        return len(ERP_TABLES)


def erp(spark: SparkSession, folder: str, **instead: DataFrame) -> Mapping[str, DataFrame]:
    """All ERP-shaped tables by role, some of them replaced."""
    return ChainMap(instead, ErpTables(spark, folder))
