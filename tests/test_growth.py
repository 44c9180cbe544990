"""What grows with the tables: written rows of a product, and what one task holds."""

from itertools import groupby

from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.operators import joins
from outledger.plans import schemes
from outledger.queries.sample_rules import RULES
from outledger.session import pin
from outledger.sources.pages import linked_pages


def test_rows_of_a_concatenated_key_are_written_as_repeated_runs(spark):
    left = spark.createDataFrame([("K", str(i % 3), i) for i in range(60)], "a string, b string, i int").repartition(4)
    right = spark.createDataFrame([("K", str(i % 3), i) for i in range(90)], "x string, y string, j int").repartition(4)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as for sides too large to be sent
    try:
        rows = joins.join_on_concat(left, right, ["a", "b"], ["x", "y"]).select("i", "j", "b").collect()
    finally:
        spark.conf.set(threshold, before)
    assert sorted((r.i, r.j) for r in rows) == sorted((i, j) for i in range(60) for j in range(90) if i % 3 == j % 3)
    # A row of the larger side stands once, beside the same sequence as every other row of its key.
    runs = [(j, [r.i for r in run], key) for (j, key), run in groupby(rows, lambda r: (r.j, r.b))]
    assert len(runs) == 90
    assert len({(key, tuple(run)) for _, run, key in runs}) == 3


def test_pages_of_a_year_are_linked_without_meeting_in_one_task(spark):
    # Day, its parts: two years, a gap in the calendar, and punches without a day.
    days = [("2023-12-30", 2), ("2024-01-01", 3), ("2024-01-05", 1), ("2024-03-01", 2), (None, 2)]
    rows = [(d, part, n, [part]) for d, n in days for part in range(n)]
    pages = spark.createDataFrame(rows, "day string, part_no int, parts int, records array<int>").withColumn(
        "day", F.col("day").cast("date")
    )
    linked = linked_pages(pages, pages)
    assert {(r.url, r.next) for r in linked.collect()} == {
        ("/next/2023-12-30/0", "/next/2023-12-30/1"), ("/next/2023-12-30/1", None),
        ("/next/2024-01-01/0", "/next/2024-01-01/1"), ("/next/2024-01-01/1", "/next/2024-01-01/2"),
        ("/next/2024-01-01/2", "/next/2024-01-05/0"), ("/next/2024-01-05/0", "/next/2024-03-01/0"),
        ("/next/2024-03-01/0", "/next/2024-03-01/1"), ("/next/2024-03-01/1", None),
        ("/next/0", "/next/1"), ("/next/1", None),
    }
    # What is put in order per year holds no records.
    plan = [linked._jdf.queryExecution().optimizedPlan()]
    windows = []
    while plan:
        node = plan.pop()
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Window":
            windows.append(node.output().mkString(" "))
    assert len(windows) == 1 and "records" not in windows[0]


def test_lines_of_schemes_are_made_once_and_groups_counted_unformed(spark):
    line = "DocEntry bigint, LineId int, U_Qual string, U_bran string, U_Discunt string, U_Stat string, " \
           "U_BillsQty decimal(18,6), U_OffersQty decimal(18,6), made_by int"
    rows = [(d, i, f"G{i % 3}" + " " * (i % 2), "B", "Quantity", None, None, None, 1) for d in (1, 2, 9) for i in range(6)]
    made = pin(spark.createDataFrame(rows, line).repartition(1))
    items = spark.createDataFrame(
        [("Y", "G0", "s1"), ("Y", "G0 ", "s2"), ("Y", "G1", "s1"), ("N", "G2", "s1"), ("Y", "G2", None)],
        "validFor string, U_SubGrp7 string, U_SubGrp4 string",
    )
    wanted = spark.createDataFrame([(i, "S", str(i)) for i in (1, 2, 3)], "DocEntry bigint, Object string, Remark string")
    states = spark.createDataFrame([("1", "one")], "Code string, Name string")
    t = {"scheme_lines": made, "items": items, "states": states}
    counts = schemes.scheme_group_counts(t, schemes.lines_of(t, wanted)).collect()
    formed = schemes.scheme_groups(t, wanted).groupBy("PolicyID").count().collect()
    assert {tuple(r) for r in counts} == {tuple(r) for r in formed} == {(1, 3), (2, 3)}
    docs = schemes.scheme_documents(t, wanted, RULES, moment("2024-01-01 00:00:00"))
    assert {r.PolicyID: len(r.Policy.SC_ProdGroupMapping) for r in docs.collect()} == {1: 3, 2: 3}
    files = {f.rsplit("/", 2)[-2] for f in docs.inputFiles() if "pinned-" in f}
    assert made.pinned_at.rsplit("/", 1)[1] not in files and len(files) == 1
