"""Whole datasets: extracts, worklists, attendance and the run board."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.fixed_values import BATCH_SIZES
from outledger.functions.dates import moment
from outledger.operators.nesting import heads
from outledger.operators.filters import FilterSpec
from outledger.operators.state import pending_queue
from outledger.plans import (
    attendance,
    dashboard,
    images,
    items,
    partners,
    prices,
    receivables,
    schemes,
    stock,
    worklists,
)
from outledger.queries.q_nesting import (
    _ACTIVE_SQL,
    _FIRST_LINE_SQL,
    _PHONE_SQL,
    OPEN_SQL,
    OPEN_VIEWS,
    flat_prices,
    flat_receivables,
    flat_stock,
)
from outledger.queries.registry import query
from outledger.queries.sample_rules import AS_OF, RULES
from outledger.queries.views import erp, views
from outledger.session import pin
from outledger.sources.schemas import BOARD, PUNCH_LOG

_c = F.col

_SELLABLE = "validFor='Y' and U_SubGrp1 not in ('Brand#3','Brand#7')"
_BOOKS_SQL = f"""(select DocEntry, LineId, U_SubGroup1, U_SubGroup4, U_SubGroup7, U_Size,
 U_SelPrice, U_MRP, U_Code from erp_size_books join erp_size_book_lines using (DocEntry)
 join (select *, U_UniqID as LineId from erp_size_book_prices) using (DocEntry, LineId)
 join erp_size_book_states using (DocEntry) where U_Selected='Y'
 and timestamp '{AS_OF}' between U_ValidFrom and U_ValidTo)"""
_BOOK_VIEWS = "erp_size_books erp_size_book_lines erp_size_book_prices erp_size_book_states"


@query(
    "pipe_items",
    f"""select ItemCode as code, case when U_SubGrp1='Brand#4' then U_CatalgCode else ItemName end
    as product_name, U_SubGrp1 as brand, rtrim(U_SubGrp6) as color_code, cast(coalesce(
    nullif(MaxLevel,0),100000) as double) as max_qty, U_SubGrp7 as default_group
    from erp_items left join (select U_ItemCode, arg_max(U_CatalgCode, LineId) as U_CatalgCode
    from erp_item_books join erp_item_book_lines using (DocEntry) where U_Lock='N' group by 1)
    on U_ItemCode=ItemCode where {_SELLABLE} and (exists (select 1 from {_BOOKS_SQL} b where
    U_SubGroup7=U_SubGrp7 and U_SubGroup4=U_SubGrp4 and U_SubGroup1=U_SubGrp1
    and rtrim(b.U_Size)=rtrim(U_SubGrp5)) or ItemCode in (select U_ItemCode from erp_item_books
    join erp_item_book_prices using (DocEntry) where U_SelPrice>0))""",
    f"erp_items erp_item_books erp_item_book_lines erp_item_book_prices {_BOOK_VIEWS}",
)
def pipe_items(spark, folder):
    t = erp(spark, folder)
    # The extract is stored once; the document step reads it several times.
    rows = pin(items.item_rows(t, RULES, AS_OF))
    docs = items.item_documents(rows, RULES)
    return docs.select("*", F.explode("ProductColors").alias("c")).select(
        _c("ProductCode").alias("code"),
        _c("Product.ProductName").alias("product_name"),
        _c("Product.Brand").alias("brand"),
        _c("c.ColorCode").alias("color_code"),
        _c("c.Max_Qty").alias("max_qty"),
        _c("ProductDefaults")[0]["GroupCode"].alias("default_group"),
    )


@query(
    "pipe_prices",
    f"""with cand as (select ItemCode, U_Code as state, b.DocEntry, b.LineId, U_SelPrice as price,
    U_MRP as mrp, case when U_SubGrp1='Brand#4' then null else ItemName end as shown, 1 as prio,
    null as cat from erp_items join {_BOOKS_SQL} b on U_SubGroup7=U_SubGrp7
    and U_SubGroup4=U_SubGrp4 and U_SubGroup1=U_SubGrp1 and rtrim(b.U_Size)=rtrim(U_SubGrp5)
    where U_SelPrice>0 and U_MRP>0 and {_SELLABLE} union all select ItemCode, U_State,
    p.DocEntry, p.LineId, U_SelPrice, U_MRP, case when U_SubGrp1='Brand#4' then U_CatalgCode
    else ItemName end, 2, U_CatalgCode from erp_items join erp_item_books k on U_ItemCode=ItemCode
    join erp_item_book_prices p on p.DocEntry=k.DocEntry join erp_item_book_lines l
    on l.DocEntry=p.DocEntry and l.LineId=p.U_RowId where U_Lock='N' and U_SelPrice>0 and U_MRP>0
    and validFor='Y' and U_Brand not in ('Brand#3','Brand#7'))
    select ItemCode as code, DocEntry as price_list_id, state as list_code,
    coalesce(shown, ItemCode) as shown_name, '2060-12-31T00:00:00' as effective_to,
    1 as is_active, LineId as price_id, cast(price as double) as price, cast(mrp as double) as mrp
    from (select *, row_number() over (partition by ItemCode, state order by prio, DocEntry,
    LineId, price, mrp, cat) as rn from cand) where rn=1""",
    f"erp_items erp_item_books erp_item_book_lines erp_item_book_prices {_BOOK_VIEWS}",
)
def pipe_prices(spark, folder):
    t = erp(spark, folder)
    # An item has one price per state, so its lists are bounded by the state dimension and
    # need no parts. The rows are read once and stay in the partitions of their item.
    rows = prices.price_rows(t, RULES, AS_OF)
    return flat_prices(prices.price_documents(rows, RULES, moment(AS_OF), part_rows=None))


@query(
    "pipe_images",
    """select ItemCode as "skuCode", U_SubGrp6 as "ColorCode", '' as "fileName",
    '' as "Description", '' as "base64Data" from erp_items where U_SubGrp7='ECONOMY'""",
    "erp_items",
)
def pipe_images(spark, folder):
    return images.image_rows(erp(spark, folder), RULES)


@query(
    "pipe_schemes",
    f"""with {_FIRST_LINE_SQL}, valid as (select * from erp_schemes where timestamp '{AS_OF}'
    between U_FrmDt and U_ToDt), per_group as (select * from (select l.*, row_number() over
    (partition by DocEntry, U_Qual order by LineId, U_Qual, U_bran, U_Discunt, U_Stat nulls first, U_BillsQty,
    U_OffersQty) as rn from erp_scheme_lines l) where rn=1)
    select v.DocEntry as policy_id, Object||v.DocEntry as policy_number, case f.U_Discunt
    when 'Quantity' then 'SC' else 'DIS' end as saving_type,
    v.DocEntry||''||g.LineId as mapping_id, g.U_Qual as group_code, s.style as style_code,
    cast(g.U_BillsQty as double) as min_order_qty, cast(g.U_OffersQty as double) as free_qty
    from valid v join first_line f on f.DocEntry=v.DocEntry join per_group g
    on g.DocEntry=v.DocEntry join (select distinct U_SubGrp7 as grp, U_SubGrp4 as style
    from erp_items where validFor='Y') s on s.grp=g.U_Qual""",
    "erp_schemes erp_scheme_lines erp_items",
)
def pipe_schemes(spark, folder):
    t = erp(spark, folder)
    docs = schemes.scheme_documents(t, schemes.valid_schemes(t, AS_OF), RULES, moment(AS_OF))
    return docs.select(
        "Policy", F.explode("Policy.SC_ProdGroupMapping").alias("g")
    ).select(
        _c("Policy.PolicyID").alias("policy_id"),
        _c("Policy.PolicyNumber").alias("policy_number"),
        _c("Policy.SavingType").alias("saving_type"),
        _c("g.MappingID").alias("mapping_id"),
        _c("g.GroupCode").alias("group_code"),
        _c("g.StyleCode").alias("style_code"),
        _c("g.MinOrderQty").alias("min_order_qty"),
        _c("g.FreeQty").alias("free_qty"),
    )


@query(
    "scheme_reach",
    f"""select DocEntry as policy_id, cast(count(*) as bigint) as partners from (select distinct
    l.DocEntry, bp_id from erp_schemes s join erp_scheme_lines l on l.DocEntry=s.DocEntry
    join si_partner on cast(state_id as varchar)=l.U_Stat where timestamp '{AS_OF}'
    between U_FrmDt and U_ToDt) group by 1""",
    "erp_schemes erp_scheme_lines si_partner",
)
def scheme_reach(spark, folder):
    # Billing addresses in the state coding of the scheme lines.
    billing = views(spark, folder)("si_partner").select(
        _c("bp_id").cast("string").alias("CardCode"),
        F.lit("B").alias("AdresType"),
        _c("state_id").cast("string").alias("State"),
    )
    t = erp(spark, folder, addresses=billing)
    counts = schemes.scheme_partner_counts(t, schemes.valid_schemes(t, AS_OF))
    return counts.select(_c("DocEntry").alias("policy_id"), "partners")


@query(
    "pipe_partners",
    f"""select CardCode as bp_code, case when GroupCode in ('100','106') then 'Dealer' else '' end
    as category, division, sub_brand, cast(case col when 'U_Dis7' then 7 when 'U_Dis3'
    then coalesce(U_Dis3,0) when 'U_Dis1' then U_Dis1 when 'U_Dis9' then 9 else 0 end as double)
    as discount, {_PHONE_SQL} as phone from erp_partners cross join (values
    ('EAST','Shirts','U_Dis7'),('EAST','Knits','U_Dis3'),('WEST','Sets','U_Dis1'),
    ('WEST','Kids','U_Dis9'),('WEST','Misc','U_Dis4')) t(division, sub_brand, col)
    where {_ACTIVE_SQL} and CardCode in (select CardCode from erp_addresses)""",
    "erp_partners erp_addresses",
)
def pipe_partners(spark, folder):
    docs = heads(partners.partner_documents(erp(spark, folder), RULES))
    return (
        docs.filter(F.size("BillShipTo") > 0)
        .select("BPCode", "BPCategory", "BillShipTo", F.explode("MST_Map_BP_SubBrand").alias("s"))
        .select(
            _c("BPCode").alias("bp_code"),
            _c("BPCategory").alias("category"),
            _c("s.DivisionCode").alias("division"),
            _c("s.SubBrandName").alias("sub_brand"),
            _c("s.DiscountPer").alias("discount"),
            _c("BillShipTo")[0]["Address"]["PhoneNumber"].alias("phone"),
        )
    )


@query(
    "pipe_stock",
    f"""select cast(DocEntry as varchar) as mapping_id, ItemCode as code,
    trunc(OnHand)::double as quantity, true as is_active, rtrim(U_SubGrp5) as size,
    case when MinLevel>OnHand then 'High Stock' else 'Low Stock' end as highlight,
    case when trunc(MinLevel)>trunc(OnHand) then 'Very few stock left' else 'Stock Available'
    end as message, (row_number() over (order by ItemCode)-1)//200+1 as batch_no
    from erp_items join erp_stock using (ItemCode) where WhsCode='W0' and {_SELLABLE}
    and trunc(OnHand)>0""",
    "erp_items erp_stock",
)
def pipe_stock(spark, folder):
    from outledger.operators.batching import assign_batches

    records = flat_stock(stock.stock_records(stock.stock_rows(erp(spark, folder), RULES)))
    batches = assign_batches(records, ["code"], BATCH_SIZES["stockInventory"])
    return batches.select(*records.columns, "batch_no")


_RECORD_ORDER_SQL = """card_code nulls first, invoice_no nulls first, due_date nulls first,
 remarks nulls first, balance nulls first, value nulls first, city nulls first,
 state nulls first, brand nulls first, doc_type nulls first, overdue_days nulls first"""


@query(
    "pipe_receivables",
    f"""with {OPEN_SQL} select card_code, invoice_no, due_date, balance, value, division,
    (rn-1)//200+1 as batch_no, rn=n as batch_end from (select *, row_number() over
    (order by {_RECORD_ORDER_SQL}) as rn, count(*) over () as n from open_rows)""",
    OPEN_VIEWS,
)
def pipe_receivables(spark, folder):
    t = erp(spark, folder)
    records = receivables.receivable_records(receivables.receivable_rows(t, RULES, AS_OF))
    batches = receivables.receivable_batches(records, BATCH_SIZES["outstanding"])
    return batches.select(
        _c("CardCode").alias("card_code"),
        _c("InvoiceNo").alias("invoice_no"),
        _c("DueDate").alias("due_date"),
        _c("BalanceToBePaid").alias("balance"),
        _c("DocumentValue").alias("value"),
        _c("DivisionCode").alias("division"),
        "batch_no",
        _c("BatchEnd").alias("batch_end"),
    )


@query(
    "pipe_attendance",
    """with seen as (select emp_id, punch_type, cast(punch_time as date) as day from si_punch
    where punch_time<timestamp '2024-01-12' and emp_id is not null),
    best as (select emp_id, punch_type, cast(punch_time as date) as day,
    case when punch_type='I' then arg_min(ref_id,(punch_time, ref_id))
    else arg_max(ref_id,(punch_time, ref_id)) end as ref_id from si_punch
    where emp_id is not null group by 1, 2, 3)
    select cast(ref_id as varchar) as ref_id, cast(emp_id as varchar) as employee_id, punch_type,
    strftime(punch_time,'%Y-%m-%dT%H:%M:%S') as punch_iso, 'Pending' as push_status
    from best b join si_punch p using (ref_id, emp_id, punch_type) where not exists
    (select 1 from seen s where s.emp_id=b.emp_id and s.punch_type=b.punch_type and s.day=b.day)""",
    "si_punch",
)
def pipe_attendance(spark, folder):
    punches = views(spark, folder)("si_punch").select(
        _c("ref_id").cast("bigint").alias("ref_id"),
        _c("emp_id").cast("string").alias("employee_id"),
        "punch_type",
        "punch_time",
    )
    log = punches.filter("employee_id is not null").filter(
        _c("punch_time") < moment("2024-01-12 00:00:00")
    )
    fresh = attendance.new_punches(punches, log, moment("2024-01-31 00:00:00"))
    assert set(fresh.columns) == {f.split()[0] for f in PUNCH_LOG.split(", ")}
    waiting = [pending_queue(fresh, kind) for kind in ("I", "O")]
    queue = waiting[0].unionByName(waiting[1])
    records = attendance.punch_records(queue).select("ref_id", "PunchTime")
    return queue.join(records, "ref_id").select(
        _c("ref_id").cast("string").alias("ref_id"),
        "employee_id",
        "punch_type",
        _c("PunchTime").alias("punch_iso"),
        "push_status",
    )


@query(
    "pipe_dashboard",
    """select t as sync_type, n as display_name, coalesce(okb>0 or badb=0, false) as is_pushed,
    case when rt is not null then case when okb>0 or badb=0 then 'Success' else 'Failed' end end
    as last_status, total as total_records, good as success_count, bad as failed_count
    from (values ('products','Product Master'),('pricelists','Price Lists'),
    ('images','Product Images'),('schemes','Schemes / Promotions'),
    ('businesspartners','Business Partners'),('stockInventory','Stock Inventory'),
    ('outstanding','Outstanding / Receivables')) d(t,n) left join (select sync_type as rt,
    sum(size)::bigint as total, coalesce(sum(size) filter (ok),0)::bigint as good,
    coalesce(sum(size) filter (not ok),0)::bigint as bad, count(*) filter (ok) as okb,
    count(*) filter (not ok) as badb from si_batch group by 1) on rt=t""",
    "si_batch",
)
def pipe_dashboard(spark, folder):
    batches = views(spark, folder)("si_batch")
    board = spark.createDataFrame([], BOARD)
    finished = dashboard.board_after_runs(
        board, batches, moment("2024-02-01 00:00:00"), moment("2024-02-01 01:00:00")
    )
    return finished.select(
        "sync_type",
        "display_name",
        "is_pushed",
        "last_status",
        "total_records",
        "success_count",
        "failed_count",
    )


# ---- the same datasets for wanted keys -------------------------------------------

_WANTED = "(select record_key from si_status where push_status='Failed')"


def _failed_keys(spark, folder):
    return views(spark, folder)("si_status").filter("push_status = 'Failed'").select("record_key")


@query(
    "by_key_items",
    f"""select ItemCode as code, ItemName as product_name, rtrim(U_SubGrp6) as color_code,
    case when validFor='Y' then 1 else 0 end as is_active, U_SubGrp1 as brand from erp_items
    where ItemCode in {_WANTED}""",
    "erp_items si_status",
)
def by_key_items(spark, folder):
    keys = _failed_keys(spark, folder)
    docs = items.item_documents(items.item_rows_by_key(erp(spark, folder), RULES, keys), RULES)
    return docs.select("*", F.explode("ProductColors").alias("c")).select(
        _c("ProductCode").alias("code"),
        _c("Product.ProductName").alias("product_name"),
        _c("c.ColorCode").alias("color_code"),
        _c("Product.IsActive").alias("is_active"),
        _c("Product.Brand").alias("brand"),
    )


@query(
    "by_key_prices",
    f"""select U_ItemCode as code, p.DocEntry as price_list_id, U_State as list_code,
    min(U_Brand) as sub_brand, p.LineId as price_id, cast(min(U_SelPrice) as double) as price
    from erp_item_books b join erp_item_book_prices p on p.DocEntry=b.DocEntry
    join erp_item_book_lines l on l.DocEntry=b.DocEntry where U_SelPrice>0
    and U_Brand not in ('Brand#3','Brand#7') and U_ItemCode in {_WANTED} group by 1,2,3,5""",
    "erp_item_books erp_item_book_prices erp_item_book_lines si_status",
)
def by_key_prices(spark, folder):
    keys = _failed_keys(spark, folder)
    rows = prices.price_rows_by_key(erp(spark, folder), RULES, keys)
    docs = prices.price_documents(rows, RULES, moment(AS_OF))
    return (
        docs.select("ProductCode", F.explode("PriceList").alias("l"))
        .select("ProductCode", "l", F.explode("l.Prices").alias("p"))
        .select(
            _c("ProductCode").alias("code"),
            _c("l.PriceListID").alias("price_list_id"),
            _c("l.PriceLisCode").alias("list_code"),
            _c("l.SubBrandCode").alias("sub_brand"),
            _c("p.PriceID").alias("price_id"),
            _c("p.Price").alias("price"),
        )
    )


@query(
    "by_key_partners",
    f"""select CardCode as bp_code, CardName as name, U_AreaCode as area from erp_partners
    where {_ACTIVE_SQL} and CardCode in {_WANTED}""",
    "erp_partners si_status",
)
def by_key_partners(spark, folder):
    docs = partners.partner_documents(
        erp(spark, folder), RULES, keys=_failed_keys(spark, folder)
    )
    return heads(docs).select(
        _c("BPCode").alias("bp_code"), _c("BPName").alias("name"), _c("AreaCode").alias("area")
    )


@query(
    "by_key_stock",
    f"""select ItemCode as code, U_SubGrp13 as color_code, U_Size as size,
    cast(trunc(OnHand) as int) as quantity from erp_items join erp_stock using (ItemCode)
    where WhsCode='W0' and validFor='Y' and ItemCode in {_WANTED}""",
    "erp_items erp_stock si_status",
)
def by_key_stock(spark, folder):
    keys = _failed_keys(spark, folder)
    return stock.stock_rows_by_key(erp(spark, folder), RULES, keys).select(
        _c("ProductCode").alias("code"),
        _c("ColorCode").alias("color_code"),
        _c("Size").alias("size"),
        _c("StockQuantity").alias("quantity"),
    )


@query(
    "by_key_receivables",
    f"""with {OPEN_SQL} select card_code, card_name, state, doc_type, invoice_no, balance
    from open_rows where card_code in {_WANTED}""",
    f"{OPEN_VIEWS} si_status",
)
def by_key_receivables(spark, folder):
    keys = _failed_keys(spark, folder)
    rows = receivables.receivable_rows(erp(spark, folder), RULES, AS_OF, keys)
    return flat_receivables(receivables.receivable_records(rows)).select(
        "card_code", "card_name", "state", "doc_type", "invoice_no", "balance"
    )


# ---- worklists -------------------------------------------------------------------


def _worklist_sql(
    base: str, key: str, columns: str, where: str, order: str, page=1, limit=50, tracked=None
):
    """Page, totals and unfiltered status counts over a base relation."""
    tracked = tracked or f"select distinct {key} from base"
    return f"""with base as ({base}), st as (select base.*, coalesce(s.push_status,'Pending')
    as push_status from base left join si_status s on cast({key} as varchar)=s.record_key),
    hit as (select * from st where {where}),
    tr as (select coalesce(s.push_status,'Pending') as push_status from ({tracked}) k
    left join si_status s on cast(k.{key} as varchar)=s.record_key)
    select {columns}, push_status, (select count(*) from hit) as total_count,
    (select cast(ceil(count(*)/{limit}.0) as bigint) from hit) as total_pages,
    (select count(*) from tr where push_status='Pending') as n_pending,
    (select count(*) from tr where push_status='Pushing') as n_pushing,
    (select count(*) from tr where push_status='Pushed') as n_pushed,
    (select count(*) from tr where push_status='Failed') as n_failed
    from hit order by {order} limit {limit} offset {(page - 1) * limit}"""


_COUNTS = ["push_status", "total_count", "total_pages", "n_pending", "n_pushing", "n_pushed", "n_failed"]


def _worklist(spark, folder, dataset, columns, page=1, limit=50, **filters):
    v = views(spark, folder)
    status = v("si_status").withColumn("master_type", F.lit(dataset))
    shown = worklists.dataset_worklist(
        dataset, erp(spark, folder), RULES, status, FilterSpec(**filters), AS_OF, page, limit
    )
    return shown.select(*[_c(c).alias(a) for c, a in columns.items()], *_COUNTS)


_ITEM_BASE = f"""select ItemCode as code, ItemName as product_name, U_SubGrp1 as brand,
 U_SubGrp7 as group_code, case when U_SubGrp1 like '%Brand#1%' then 'EAST' when U_SubGrp1
 like '%Brand#2%' then 'WEST' end as division from erp_items where {_SELLABLE} and ItemCode in
 (select U_ItemCode from erp_item_books join erp_item_book_prices using (DocEntry)
 where U_SelPrice>0)"""


@query(
    "worklist_items",
    _worklist_sql(
        _ITEM_BASE,
        "code",
        "code, product_name, brand, group_code, division",
        "(code ilike '%1%' or product_name ilike '%1%') and division='EAST'",
        "code",
        page=2,
    ),
    "erp_items erp_item_books erp_item_book_prices si_status",
)
def worklist_items(spark, folder):
    columns = {
        "ProductCode": "code",
        "ProductName": "product_name",
        "Brand": "brand",
        "ProductGroupCode": "group_code",
        "DivisionCode": "division",
    }
    return _worklist(
        spark, folder, "products", columns, page=2, search="1", division="EAST"
    )


@query(
    "worklist_prices",
    _worklist_sql(
        """select ItemCode as code, U_Brand as brand, U_SubGrp7 as group_code,
        count(*) as price_entries, count(distinct U_State) as state_count,
        cast(min(U_SelPrice) as double) as min_price, cast(max(U_SelPrice) as double) as max_price
        from erp_items join erp_item_books k on U_ItemCode=ItemCode join erp_item_book_prices
        p on p.DocEntry=k.DocEntry join erp_item_book_lines l on l.DocEntry=k.DocEntry
        where U_SelPrice>0 and U_Brand not in ('Brand#3','Brand#7') group by 1,2,3""",
        "code",
        "code, brand, group_code, price_entries, state_count, min_price, max_price",
        "group_code='ECONOMY' and push_status='Pending'",
        "code, brand",
    ),
    "erp_items erp_item_books erp_item_book_prices erp_item_book_lines si_status",
)
def worklist_prices(spark, folder):
    columns = {
        "ProductCode": "code",
        "Brand": "brand",
        "ProductGroupCode": "group_code",
        "price_entries": "price_entries",
        "state_count": "state_count",
        "min_price": "min_price",
        "max_price": "max_price",
    }
    return _worklist(
        spark, folder, "pricelists", columns, group="ECONOMY", status="Pending"
    )


@query(
    "worklist_partners",
    _worklist_sql(
        f"""select CardCode as code, CardName as name, case when GroupCode in ('100','106')
        then 'Dealer' else '' end as category, case when coalesce(U_Grade,'') in ('','-')
        then 'C' else replace(U_Grade,'Grade','') end as grade,
        case when regexp_full_match(right(coalesce(Phone1,''),10),'[0-9]{{10}}')
        then right(Phone1,10) when regexp_full_match(right(coalesce(Phone2,''),10),'[0-9]{{10}}')
        then right(Phone2,10) else '' end as phone, (select City from erp_addresses a
        where a.CardCode=p.CardCode and AdresType='B' order by LineNum limit 1) as city
        from erp_partners p where {_ACTIVE_SQL}""",
        "code",
        "code, name, category, grade, phone, city",
        "code ilike '%#00000000%' or name ilike '%#00000000%'",
        "code",
        limit=20,
    ),
    "erp_partners erp_addresses si_status",
)
def worklist_partners(spark, folder):
    columns = {
        "BPCode": "code",
        "BPName": "name",
        "BPCategory": "category",
        "GradeOfBP": "grade",
        "Phone1": "phone",
        "City": "city",
    }
    return _worklist(
        spark, folder, "businesspartners", columns, limit=20, search="#00000000"
    )


@query(
    "worklist_schemes",
    _worklist_sql(
        """select s.DocEntry as policy_id, Object||DocNum as policy_number, max(case when U_bran
        like '%Brand#1%' then 'EAST' when U_bran like '%Brand#2%' then 'WEST' end) as division,
        max(U_Discunt) as basis, strftime(U_FrmDt,'%Y-%m-%d') as from_day,
        count(distinct LineId) as line_count from erp_schemes s join erp_scheme_lines l
        on l.DocEntry=s.DocEntry where U_FrmDt>=timestamp '1997-01-01'
        and U_ToDt<=timestamp '1998-12-31' group by s.DocEntry, Object, DocNum, U_FrmDt""",
        "policy_id",
        "policy_id, policy_number, division, basis, from_day, line_count",
        "policy_number ilike '%7000%'",
        "policy_id",
        tracked="""select DocEntry as policy_id from erp_schemes
        where U_FrmDt>=timestamp '1997-01-01' and U_ToDt<=timestamp '1998-12-31'""",
    ),
    "erp_schemes erp_scheme_lines si_status",
)
def worklist_schemes(spark, folder):
    columns = {
        "DocEntry": "policy_id",
        "PolicyNumber": "policy_number",
        "DivisionCode": "division",
        "DiscountBasis": "basis",
        "FromDate": "from_day",
        "LineCount": "line_count",
    }
    return _worklist(spark, folder, "schemes", columns, search="7000")


@query(
    "worklist_stock",
    _worklist_sql(
        """select ItemCode as code, ItemName as product_name, U_SubGrp4 as style,
        cast(trunc(sum(OnHand)) as bigint) as quantity from erp_items join erp_stock
        using (ItemCode) where WhsCode='W0' and validFor='Y' group by 1,2,3""",
        "code",
        "code, product_name, style, quantity",
        "(code ilike '%BOLT%' or product_name ilike '%BOLT%')",
        "code",
        page=2,
    ),
    "erp_items erp_stock si_status",
)
def worklist_stock(spark, folder):
    columns = {
        "ProductCode": "code",
        "ProductName": "product_name",
        "StyleCode": "style",
        "StockQuantity": "quantity",
    }
    return _worklist(spark, folder, "stockInventory", columns, page=2, search="BOLT")


@query(
    "worklist_receivables",
    _worklist_sql(
        f"""with {OPEN_SQL} select card_code, max(card_name) as card_name, max(city) as city,
        max(division) as division, count(*) as invoice_count,
        cast(sum(BalDueDeb) as double) as total_balance, max(overdue_days) as max_overdue
        from open_rows group by card_code""",
        "card_code",
        "card_code, card_name, city, division, invoice_count, total_balance, max_overdue",
        "push_status='Pending'",
        "card_code",
    ),
    f"{OPEN_VIEWS} si_status",
)
def worklist_receivables(spark, folder):
    columns = {
        "CardCode": "card_code",
        "CardName": "card_name",
        "City": "city",
        "DivisionCode": "division",
        "InvoiceCount": "invoice_count",
        "TotalBalance": "total_balance",
        "MaxOverdueDays": "max_overdue",
    }
    return _worklist(spark, folder, "outstanding", columns, status="Pending")


@query(
    "worklist_attendance",
    """with hit as (select * from si_punch_log where punch_type='I' and push_status='Failed'
    and cast(punch_time as date) between date '2024-01-05' and date '2024-01-20'
    and (employee_id ilike '%1%' or ref_id ilike '%1%'))
    select id, employee_id, push_status, (select count(*) from hit) as total_count,
    (select cast(ceil(count(*)/50.0) as bigint) from hit) as total_pages,
    (select count(*) from si_punch_log where push_status='Pending') as n_pending,
    (select count(*) from si_punch_log where push_status='Pushed') as n_pushed,
    (select count(*) from si_punch_log where push_status='Failed') as n_failed
    from hit order by id desc limit 50""",
    "si_punch_log",
)
def worklist_attendance(spark, folder):
    spec = FilterSpec(
        search="1", kind="I", status="Failed", date_from="2024-01-05", date_to="2024-01-20"
    )
    shown = worklists.attendance_worklist(views(spark, folder)("si_punch_log"), spec)
    return shown.select(
        "id",
        "employee_id",
        "push_status",
        "total_count",
        "total_pages",
        "n_pending",
        "n_pushed",
        "n_failed",
    )
