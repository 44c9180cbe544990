"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.operators import joins
from outledger.operators.filters import valid_at
from outledger.operators.skew import salted_join
from outledger.queries.registry import query
from outledger.queries.views import AS_OF, views

_c = F.col


@query(
    "inner_equi",
    """select trans_id, line_no, item_id, supp_id, trans_type, bp_name, cast(balance as double)
    as balance from si_journal_line join si_journal using (trans_id) join si_partner using (bp_id)
    join nation on state_id=n_nationkey""",
    "si_journal_line si_journal si_partner",
)
def inner_equi(spark, folder):
    v = views(spark, folder)
    headers = joins.inner(v("si_journal"), v("si_partner"), "bp_id")
    headers = headers.join(v("nation"), _c("state_id") == _c("n_nationkey"))
    return salted_join(v("si_journal_line"), headers, ["trans_id"]).select(
        "trans_id", "line_no", "item_id", "supp_id", "trans_type", "bp_name", "balance"
    )


@query(
    "left_outer",
    """select trans_id, trans_type, strftime(doc_date,'%Y-%m-%d %H:%M:%S') as doc_date, brand
    from si_journal left join si_invoice using (trans_id)""",
    "si_journal si_invoice",
)
def left_outer(spark, folder):
    v = views(spark, folder)
    detail = v("si_invoice").select("trans_id", "doc_date", "brand")
    return joins.left(v("si_journal"), detail, "trans_id").select(
        "trans_id", "trans_type", "doc_date", "brand"
    )


@query(
    "cross_dim",
    """select bp_id, division, sub_brand from si_partner cross join
    (values ('EAST','Shirts'),('EAST','Knits'),('WEST','Sets')) t(division, sub_brand)""",
    "si_partner",
)
def cross_dim(spark, folder):
    dimension = [
        {"division": "EAST", "sub_brand": "Shirts"},
        {"division": "EAST", "sub_brand": "Knits"},
        {"division": "WEST", "sub_brand": "Sets"},
    ]
    rows = joins.with_dimension(views(spark, folder)("si_partner"), dimension)
    return rows.select("bp_id", "division", "sub_brand")


@query(
    "exists_semi",
    """select item_id, brand from si_item i where exists
    (select 1 from si_price_b b where b.item_id=i.item_id and b.price>950)""",
    "si_item si_price_b",
)
def exists_semi(spark, folder):
    v = views(spark, folder)
    return joins.where_exists(v("si_item"), v("si_price_b").filter("price > 950"), "item_id").select(
        "item_id", "brand"
    )


@query(
    "exists_either",
    f"""select item_id, brand from si_item i where exists (select 1 from si_price_a a
    where a.item_id=i.item_id and timestamp '{AS_OF}' between valid_from and valid_to)
    or exists (select 1 from si_price_b b where b.item_id=i.item_id and b.price>950)""",
    "si_item si_price_a si_price_b",
)
def exists_either(spark, folder):
    v = views(spark, folder)
    current = valid_at(v("si_price_a"), "valid_from", "valid_to", moment(AS_OF))
    listed = v("si_price_b").filter("price > 950")
    found = joins.where_exists_any(
        v("si_item"), [(current, ["item_id"]), (listed, ["item_id"])]
    )
    return found.select("item_id", "brand")


@query(
    "in_subquery",
    f"""select bp_id, bp_name, state_id from si_partner where state_id in
    (select distinct state_id from si_scheme_line join si_scheme using (scheme_id)
    where timestamp '{AS_OF}' between from_date and to_date)""",
    "si_partner si_scheme si_scheme_line",
)
def in_subquery(spark, folder):
    v = views(spark, folder)
    valid = valid_at(v("si_scheme"), "from_date", "to_date", moment(AS_OF))
    lines = v("si_scheme_line").join(valid, "scheme_id")
    return joins.where_in(v("si_partner"), "state_id", lines, "state_id").select(
        "bp_id", "bp_name", "state_id"
    )


@query(
    "not_exists_insert",
    """select distinct emp_id, punch_type, cast(punch_time as date) as day from si_punch p
    where not exists
    (select 1 from si_punch l where l.emp_id=p.emp_id and l.punch_type=p.punch_type
    and cast(l.punch_time as date)=cast(p.punch_time as date)
    and l.punch_time<timestamp '2024-01-20')""",
    "si_punch",
)
def not_exists_insert(spark, folder):
    # A punch without a person matches none of the log, so all of them are new.
    punches = views(spark, folder)("si_punch").select(
        "emp_id", "punch_type", "punch_time", F.to_date("punch_time").alias("day")
    )
    key = ["emp_id", "punch_type", "day"]
    log = punches.filter(_c("punch_time") < moment("2024-01-20 00:00:00"))
    return joins.anti(punches, log, key).select(*key).distinct()


@query(
    "apply_top1",
    """select item_id, brand, book_id, cast(price as double) as price from si_item
    left join (select item_id, max_by(book_id, (valid_from, book_id, line_id, supp_id, price))
    as book_id, max_by(price, (valid_from, book_id, line_id, supp_id, price)) as price
    from si_price_a where disc<0.08 group by item_id) using (item_id)""",
    "si_item si_price_a",
)
def apply_top1(spark, folder):
    v = views(spark, folder)
    unlocked = v("si_price_a").filter("disc < 0.08")
    order = ["valid_from", "book_id", "line_id", "supp_id", "price"]
    return joins.latest_per_key(
        v("si_item").select("item_id", "brand"), unlocked, ["item_id"], order, ["book_id", "price"]
    )


@query(
    "scalar_top1",
    """select bp_id, bp_name, (select city from si_address a where a.bp_id=p.bp_id
    and addr_type='B' order by addr_id limit 1) as city from si_partner p""",
    "si_partner si_address",
)
def scalar_top1(spark, folder):
    v = views(spark, folder)
    billing = v("si_address").filter("addr_type = 'B'")
    return joins.first_per_key(
        v("si_partner").select("bp_id", "bp_name"), billing, ["bp_id"], ["addr_id"], ["city"]
    )


@query(
    "concat_key_join",
    """select i.item_id, l.LineId as line_id, l.DocEntry as doc_entry from si_item i
    join erp_size_book_lines l
    on concat(grp,style,brand)=concat(U_SubGroup7,U_SubGroup4,U_SubGroup1)""",
    "si_item erp_size_book_lines",
)
def concat_key_join(spark, folder):
    v = views(spark, folder)
    joined = joins.join_on_concat(
        v("si_item").select("item_id", "grp", "style", "brand"),
        v("erp_size_book_lines"),
        ["grp", "style", "brand"],
        ["U_SubGroup7", "U_SubGroup4", "U_SubGroup1"],
    )
    return joined.select(
        "item_id", _c("LineId").alias("line_id"), _c("DocEntry").alias("doc_entry")
    )


@query(
    "cast_key_join",
    """select l.trans_id, line_no, item_id, supp_id, doc_num from si_journal_line l
    join si_journal j on l.trans_id=j.trans_id join si_invoice i on cast(doc_num as varchar)=ref1
    and i.bp_id=j.bp_id and i.trans_id=l.trans_id""",
    "si_journal_line si_journal si_invoice",
)
def cast_key_join(spark, folder):
    v = views(spark, folder)
    invoices = joins.inner(v("si_invoice"), v("si_journal"), ["trans_id", "bp_id"]).select(
        "trans_id", joins.key_text(_c("doc_num")).alias("ref1"), "doc_num"
    )
    return salted_join(v("si_journal_line"), invoices, ["trans_id", "ref1"]).select(
        "trans_id", "line_no", "item_id", "supp_id", "doc_num"
    )


@query(
    "trimmed_key_join",
    """select doc_num, brand, remark from si_invoice join
    (select distinct brand as name, 'note '||brand as remark from si_item) on rtrim(brand)=name""",
    "si_invoice si_item",
)
def trimmed_key_join(spark, folder):
    v = views(spark, folder)
    notes = v("si_item").select(
        _c("brand").alias("name"), F.concat(F.lit("note "), "brand").alias("remark")
    )
    return v("si_invoice").join(
        notes.distinct(), joins.key_trimmed(_c("brand")) == _c("name")
    ).select("doc_num", "brand", "remark")


@query(
    "filtered_side_join",
    """select bp_id, addr_id, city from si_partner p
    left join si_address a using (bp_id) where addr_type='S'
    union all select bp_id, null, null from si_partner
    where bp_id not in (select bp_id from si_address where addr_type='S')""",
    "si_partner si_address",
)
def filtered_side_join(spark, folder):
    v = views(spark, folder)
    joined = joins.left(
        v("si_partner"), v("si_address"), "bp_id", only=_c("addr_type") == "S"
    )
    return joined.select("bp_id", "addr_id", "city")


@query(
    "fanout_join",
    """select DocEntry as doc_entry, count(*) as n, count(distinct U_State) as states,
    cast(max(U_SelPrice) as double) as max_price from erp_item_book_prices
    join erp_item_book_lines using (DocEntry) group by DocEntry""",
    "erp_item_book_prices erp_item_book_lines",
)
def fanout_join(spark, folder):
    # The header-level join multiplies prices by lines. As only counts and extremes
    # of it are wanted, both sides are reduced first and the counts multiplied.
    v = views(spark, folder)
    prices = v("erp_item_book_prices").groupBy("DocEntry").agg(
        F.count("*").alias("prices"),
        F.count_distinct("U_State").alias("states"),
        F.max("U_SelPrice").alias("max_price"),
    )
    lines = v("erp_item_book_lines").groupBy("DocEntry").agg(F.count("*").alias("lines"))
    return joins.inner(prices, lines, "DocEntry").select(
        _c("DocEntry").alias("doc_entry"),
        (_c("prices") * _c("lines")).alias("n"),
        "states",
        "max_price",
    )


@query(
    "key_difference",
    """select distinct bp_id from si_partner where bp_id not in
    (select record_key from si_status_event where status='Failed')""",
    "si_partner si_status_event",
)
def key_difference(spark, folder):
    v = views(spark, folder)
    failed = v("si_status_event").filter("status = 'Failed'")
    return joins.keys_minus(
        v("si_partner"), failed.select(_c("record_key").alias("bp_id")), "bp_id"
    )
