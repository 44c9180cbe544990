"""Record status in key-hash buckets: writes replace only the buckets they touch.

Each dataset is a part, and each part is cut into a fixed number of buckets by the hash of the record
key. A commit table names the current folder and the status counts of every bucket. An upsert reads
and rewrites the buckets that its keys fall into, whatever the rest of the table holds; files in use are
never overwritten, and a failed write leaves the previous version current. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.operators import state
from outledger.session import pin, unpin
from outledger.sources.schemas import RECORD_STATUS

BUCKETS = 256


class StatusStore:
    """The record-status table of all datasets.

    ``buckets`` is fixed with the first write: choose it so that a dataset divided by it is a few
    hundred megabytes, which one task can rewrite.
    """

    COMMITS = (
        "version bigint, part string, bucket int, buckets int, folder string, counts map<string,bigint>"
    )
    CHANGES = "master_type string, record_key string, old_status string, new_status string"
    KEY = ("master_type", "record_key")

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        written = self._table("commits", self.COMMITS).select("buckets").first()
        if written is not None:
            self.buckets = written["buckets"]

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def bucket(self, key: str = "record_key"):
        """The bucket of a record key."""
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def current(self) -> DataFrame:
        """Folder and counts of every bucket: parts x buckets rows, read from commits only."""
        latest = F.max_by(F.struct("folder", "counts"), "version").alias("_last")
        commits = self._table("commits", self.COMMITS).groupBy("part", "bucket").agg(latest)
        return commits.select("part", "bucket", "_last.folder", "_last.counts")

    def version(self) -> int:
        """Number of the current version, 0 before the first."""
        return self._table("commits", self.COMMITS).agg(F.max("version")).first()[0] or 0

    def folders(self, part: str | None = None, buckets: Iterable[int] | None = None) -> dict[tuple[str, int], str]:
        """The current folder of the wanted buckets."""
        rows = self.current() if part is None else self.current().where(F.col("part") == part)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(list(buckets)))
        return {(r["part"], r["bucket"]): r["folder"] for r in rows.collect()}

    def read(self, part: str | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The current state of one part or of all, or only of some buckets."""
        folders = sorted(set(self.folders(part, buckets).values()))
        if not folders:
            return self.spark.createDataFrame([], RECORD_STATUS)
        paths = [f"{self.path}/{folder}" for folder in folders]
        return self.spark.read.schema(RECORD_STATUS).parquet(*paths)

    def lookup(self, keys: DataFrame, part: str) -> DataFrame:
        """States of the given record keys: only their buckets are read."""
        wanted = pin(keys.select("record_key").distinct())
        rows = self.read(part, self._hit(wanted))
        return rows.join(wanted, "record_key", "left_semi").select(*rows.columns)

    def _hit(self, keys: DataFrame) -> list[int]:
        return [r["b"] for r in keys.select(self.bucket().alias("b")).distinct().collect()]

    def upsert(self, updates: DataFrame, part: str) -> int:
        """Apply updates (at most one per key) of one part: later push times survive null ones.

        Only the buckets of the updated keys are read and written. The counts of a bucket go on from
        its old ones: for each touched key -1 for its old status and +1 for the new one.
        """
        updates = pin(updates.where(F.col("master_type") == part))
        hit = self._hit(updates)
        version = self.version() + 1
        if not hit:
            unpin(updates)
            return version - 1
        old = self.read(part, hit)
        folder = f"v{version:08d}"
        following = state.upsert_status(old, updates).withColumn("bucket", self.bucket())
        (
            following.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
            .parquet(f"{self.path}/{folder}")
        )
        before = old.select("record_key", F.col("push_status").alias("old_status"))
        changes = updates.select(*self.KEY, F.col("push_status").alias("new_status")).join(before, "record_key", "left")
        changes = changes.select("master_type", "record_key", "old_status", "new_status")
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/version={version}")
        deltas = self.deltas(self.changes(version)).groupBy("bucket").agg(
            F.map_from_entries(F.collect_list(F.struct("push_status", "n"))).alias("delta")
        )
        known = self.current().where((F.col("part") == part) & F.col("bucket").isin(hit)).select("bucket", "counts")
        joined = deltas.join(known, "bucket", "left")
        none = F.create_map().cast("map<string,bigint>")
        summed = F.map_zip_with(
            F.coalesce("counts", none), "delta", lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        )
        joined.select(
            F.lit(version).cast("bigint").alias("version"), F.lit(part).alias("part"), "bucket",
            F.lit(self.buckets).alias("buckets"),
            F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string")).alias("folder"),
            summed.alias("counts"),
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        unpin(updates)
        return version

    def deltas(self, changes: DataFrame) -> DataFrame:
        """``bucket, push_status, n``: what changed keys add to and take from each count."""
        moves = F.array(
            F.struct(F.col("old_status").alias("push_status"), F.lit(-1).alias("d")),
            F.struct(F.col("new_status").alias("push_status"), F.lit(1).alias("d")),
        )
        rows = changes.select(self.bucket().alias("bucket"), F.inline(moves))
        return rows.where("push_status is not null").groupBy("bucket", "push_status").agg(F.sum("d").alias("n"))

    def changes(self, version: int) -> DataFrame:
        """The keys that one version touched, with their old and new status."""
        return self.spark.read.schema(self.CHANGES).parquet(f"{self.path}/changes/version={version}")

    def changes_after(self, version: int) -> DataFrame:
        """The same for all committed versions after one."""
        paths = [f"{self.path}/changes/version={v}" for v in range(version + 1, self.version() + 1)]
        if not paths:
            return self.spark.createDataFrame([], self.CHANGES)
        return self.spark.read.schema(self.CHANGES).parquet(*paths)

    def mark_in_flight(self, keys: DataFrame, part: str, now) -> int:
        """Set every given key to pushing; its last push time stays, its error goes."""
        return self.upsert(state.in_flight_updates(keys, part, now), part)

    def store_results(self, updates: DataFrame, part: str, order: str) -> int:
        """Many results at once, later ones win; equal to applying them one by one."""
        return self.upsert(state.folded_results(updates, order), part)

    def status_counts(self, part: str) -> DataFrame:
        """``push_status, n`` of one part, from the commits: no status row is read."""
        rows = self.current().where(F.col("part") == part).select(F.explode("counts").alias("push_status", "n"))
        return rows.groupBy("push_status").agg(F.sum("n").alias("n")).where("n > 0")
