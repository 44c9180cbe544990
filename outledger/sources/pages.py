"""Cursor-paged API extracts that were landed as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outledger.session import pin

#: ``url`` is the cursor a page was fetched by, stored with it when it is landed.
PAGE = (
    "url string, done boolean, nextRecordsUrl string, "
    "records array<struct<Id:string, related:struct<EmployeeId:string>, "
    "AttendenceTime:string, Type:string>>"
)


def read_pages(
    spark: SparkSession, path: str, schema: str = PAGE, page_per_file: bool = True
) -> DataFrame:
    """One row per page; a page is a file, or a line of one if landed as JSON lines."""
    return spark.read.schema(schema).option("multiLine", str(page_per_file)).json(path)


def page_records(pages: DataFrame) -> DataFrame:
    """The records of all pages, with the related field flattened."""
    record = pages.select(F.explode("records").alias("r"))
    return record.select(
        F.col("r.Id").alias("ref_id"),
        F.col("r.related.EmployeeId").alias("employee_id"),
        F.col("r.AttendenceTime").try_cast("timestamp_ntz").alias("punch_time"),
        F.col("r.Type").alias("type_name"),
    )


def incomplete_extracts(pages: DataFrame) -> DataFrame:
    """Folders whose extract does not end in exactly one final page."""
    return (
        pages.groupBy(folder_of(pages).alias("folder"))
        .agg(F.count_if(F.col("done")).alias("final_pages"))
        .filter(F.col("final_pages") != 1)
    )


def folder_of(pages: DataFrame) -> Column:
    """The landing folder of a page: one folder holds one extract."""
    return F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")


def linked_pages(pages: DataFrame, days: DataFrame) -> DataFrame:
    """``pages`` (day, part_no, parts, ...) with their cursor ``url`` and ``next``, that of the page after each.

    An extract is a year, in order of day and part; its last page has no next. Inside a day the next
    part is known, so only the calendar is put in order: pages of a year never meet in one task. The
    calendar, a row a day, is sent to the pages.
    """
    later = F.lead("day").over(Window.partitionBy(F.trunc("day", "year")).orderBy("day"))
    calendar = days.select("day").distinct().select(F.col("day").alias("_day"), later.alias("_later"))

    def cursor(day: Column, part: Column) -> Column:
        return F.concat_ws("/", F.lit("/next"), day, part)

    day, part = F.col("day"), F.col("part_no")
    following = F.when(part + 1 < F.col("parts"), cursor(day, part + 1)).when(
        F.col("_later").isNotNull(), cursor(F.col("_later"), F.lit(0))
    )
    return (
        pages.join(F.broadcast(calendar), day.eqNullSafe(F.col("_day")), "left")
        .withColumns({"url": cursor(day, part), "next": following})
        .drop("_day", "_later")
    )


def chain_places(links: DataFrame) -> DataFrame:
    """``extract, url, steps, open``: how many pages follow a page, by list ranking.

    ``links`` holds ``extract, url, next`` with unique urls in an extract and null after the last page. A
    page's pointer jumps twice as far with every round, so rounds grow with the logarithm of the longest
    chain; every round is one join and is written. ``open`` marks pages that never reach an end: those of
    a cycle, and those that lead into one.
    """
    longest = links.groupBy("extract").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    known = links.select("extract", F.col("url").alias("next"), F.lit(True).alias("_there"))
    now = pin(
        links.join(known, ["extract", "next"], "left").select(
            "extract", "url", F.when(F.col("_there"), F.col("next")).alias("to"),
            F.when(F.col("_there"), 1).otherwise(0).cast("long").alias("steps"),
        )
    )
    for _ in range(longest.bit_length()):
        if now.where("to is not null").isEmpty():
            break
        then = now.select("extract", F.col("url").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        jumped = now.join(then, ["extract", "to"], "left")
        now = pin(
            jumped.select("extract", "url", F.col("_to").alias("to"),
                          (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"))
        )
    return now.select("extract", "url", "steps", F.col("to").isNotNull().alias("open"))


def chain_faults(pages: DataFrame, extract: Column) -> DataFrame:
    """``extract, fault, n``: why an extract is not one unbroken chain from its first to its final page.

    Faults: a page landed twice, a missing page that another one names, a page named by several (fork),
    more or fewer than one first page (named by none) or final page, an end without ``done``, and a cycle.
    An extract without a row here is complete.
    """
    rows = pages.select(
        extract.alias("extract"), F.col("url"), F.coalesce("done", F.lit(False)).alias("done"),
        F.when(~F.coalesce("done", F.lit(False)), F.col("nextRecordsUrl")).alias("next"),
    )
    links = pin(
        rows.groupBy("extract", "url").agg(
            F.count("*").alias("landed"), F.max("done").alias("done"), F.min("next").alias("next")
        )
    )
    named = links.where("next is not null").groupBy("extract", F.col("next").alias("url")).agg(F.count("*").alias("by"))
    both = links.join(named, ["extract", "url"], "full").select(
        "extract", "landed", "done", "next", F.coalesce("by", F.lit(0)).alias("by")
    )
    there = F.col("landed").isNotNull()
    counted = both.groupBy("extract").agg(
        F.sum(F.col("landed") - 1).alias("repeated page"),
        F.count_if(~there).alias("missing page"),
        F.count_if(F.col("by") > 1).alias("fork"),
        F.count_if(there & (F.col("by") == 0)).alias("first"),
        F.count_if(F.col("done")).alias("final"),
        F.count_if(there & ~F.col("done") & F.col("next").isNull()).alias("open end"),
    )
    round_ = chain_places(links.select("extract", "url", "next")).groupBy("extract").agg(F.count_if("open").alias("cycle"))
    faults = counted.join(round_, "extract").select(
        "extract",
        F.explode(F.array(
            *[F.struct(F.lit(f).alias("fault"), F.col(f).alias("n"), F.lit(0).alias("ok"))
              for f in ("repeated page", "missing page", "fork", "open end", "cycle")],
            *[F.struct(F.lit(f"{f} pages").alias("fault"), F.col(f).alias("n"), F.lit(1).alias("ok"))
              for f in ("first", "final")],
        )).alias("f"),
    )
    return faults.where("f.n <> f.ok").select("extract", "f.fault", "f.n")
