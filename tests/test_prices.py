"""The size-book ranking never forms prices x states."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from outledger.plans import prices
from outledger.queries.sample_rules import RULES
from outledger.session import pin
from outledger.sources.schemas import ERP


def test_states_meet_the_best_prices_only(spark):
    n, states = 10_000, 30

    def made(role, **values):
        rows = spark.range(values.pop("rows"))
        fields = T.StructType.fromDDL(ERP[role])
        return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    one, number = F.lit(1), F.col("id")
    t = {
        "size_books": made("size_books", rows=1, DocEntry=one,
                           U_ValidFrom=F.lit("2000-01-01 00:00:00"), U_ValidTo=F.lit("2099-01-01 00:00:00")),
        "size_book_prices": made("size_book_prices", rows=n, DocEntry=one, U_UniqID=number, LineId=number,
                                 U_SelPrice=number % 977 + 1, U_MRP=number + 1, U_Size=(number % 4).cast("string")),
        "size_book_lines": made("size_book_lines", rows=n, DocEntry=one, LineId=number, U_SubGroup7=F.lit("G"),
                                U_SubGroup4=F.lit("S"), U_SubGroup1=F.lit("B")),
        "size_book_states": made("size_book_states", rows=states, DocEntry=one, U_Selected=F.lit("Y"),
                                 U_Code=F.concat(F.lit("S"), number.cast("string"))),
    }
    t = {role: pin(df) for role, df in t.items()}
    best = prices.size_prices(t, RULES, "2024-01-01 00:00:00")
    rows = best.collect()
    assert len(rows) == 4 * states and {r.PriceID for r in rows} == {0, 1, 2, 3}
    # Rows that each join and window of the executed plan has made.
    made_rows = []

    def walk(node):
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined() and "Join" in node.nodeName():
            made_rows.append(metric.get().value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(best._jdf.queryExecution().executedPlan())
    assert made_rows and max(made_rows) <= n


def test_prices_of_other_than_valid_books_are_dropped_before_they_are_joined(spark):
    def made(role, rows, **values):
        fields = T.StructType.fromDDL(ERP[role])
        return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    rows = pin(spark.range(200).selectExpr("id", "if(id % 10 = 9, null, id % 10) as doc", "id % 4 as of"))
    sizes = pin(spark.range(4).selectExpr("id as of", "concat('S', id, ' ') as size"))
    joined, number, one = rows.join(sizes, "of"), F.col("id"), F.lit(1)
    # Grouped before it is joined, as lines may be.
    lines = rows.groupBy("doc", "id").agg(F.min("of").alias("of")).join(sizes, "of")
    doc = F.col("doc")
    t = {
        "size_books": made("size_books", spark.range(10), DocEntry=number, U_ValidTo=F.lit("2099-01-01 00:00:00"),
                           U_ValidFrom=F.when(number % 5 == 1, F.lit("2000-01-01 00:00:00")).otherwise(F.lit("2098-01-01 00:00:00"))),
        "size_book_prices": made("size_book_prices", joined, DocEntry=doc, U_UniqID=number, LineId=number,
                                 U_SelPrice=number + 1, U_MRP=number + 2, U_Size=F.col("size")),
        "size_book_lines": made("size_book_lines", lines, DocEntry=doc, LineId=number, U_SubGroup7=F.lit("G"),
                                U_SubGroup4=F.lit("S"), U_SubGroup1=F.lit("B")),
        "size_book_states": made("size_book_states", joined, DocEntry=doc, U_Selected=F.lit("Y"), U_Code=F.col("size")),
    }
    best = prices.size_prices(t, RULES, "2024-01-01 00:00:00")
    # Books 1 and 6 are valid. Their rows are 1, 11, 21.. and 6, 16, 26..: two sizes and two states each.
    got = {(r.size_key, r.SubBrandCode): (r.PriceListID, r.PriceID) for r in best.collect()}
    assert got == {
        ("S1", "S1 "): (1, 1), ("S1", "S3 "): (1, 1), ("S3", "S1 "): (1, 11), ("S3", "S3 "): (1, 11),
        ("S0", "S0 "): (6, 16), ("S0", "S2 "): (6, 16), ("S2", "S0 "): (6, 6), ("S2", "S2 "): (6, 6),
    }
    inner = []

    def walk(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join" and node.joinType().toString() == "Inner":
            inner.append(node)
        for child in children:
            walk(child)

    def has_semi(node):
        semi = node.nodeName() == "Join" and node.joinType().toString() == "LeftSemi"
        return semi or any(has_semi(node.children().apply(i)) for i in range(node.children().size()))

    walk(best._jdf.queryExecution().optimizedPlan())
    # Prices, lines and states are each tested below the join with their sizes.
    assert len(inner) == 5 and all(has_semi(join) for join in inner)


def test_documents_of_the_full_extract_shuffle_no_price_again(spark):
    fields = "ProductCode string, PriceListID bigint, SubBrandCode string, BPProductName string, PriceListCode string, " \
             "EffectiveFrom string, EffectiveTo string, PriceListIsActive int, BPCategory string, " \
             "Price decimal(18,6), MRP decimal(18,6), PriceID bigint, PriceIsActive int"
    rows = spark.createDataFrame(
        [(f"P{i % 7}" if i % 7 else None, i % 3, f"S{i}", None, None if i % 2 else f"C{i % 4}", None, None, 1, "D",
          None, None, i % 5 or None, None) for i in range(90)], fields,
    )
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    whole = prices.price_documents(pin(rows).repartition("ProductCode"), RULES, now, part_rows=None)
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    # The same lists as in chunks that hold one price, and all of them.
    parts = prices.price_documents(pin(rows), RULES, now, part_rows=1)

    def flat(docs):
        lists = docs.select("ProductCode", F.explode("PriceList").alias("l"))
        found = lists.select("ProductCode", "l.*", F.explode("l.Prices").alias("p")).drop("Prices")
        return sorted(map(str, found.collect()))

    assert flat(whole) == flat(parts) and len(flat(whole)) == len(
        {(i % 7, i % 3, None if i % 2 else i % 4, i % 5) for i in range(90)}
    )
