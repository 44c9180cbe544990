"""Delivery runs over selected or filtered records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.operators.batching import assign_batches, outbox_write
from outledger.operators.delivery import reconcile_missing
from outledger.operators.filters import FilterSpec, apply_filters
from outledger.operators.state import results_to_updates
from outledger.operators.status_store import StatusStore
from outledger.session import pin

_c = F.col


def freeze_keys(records: DataFrame, spec: FilterSpec, key: str) -> DataFrame:
    """The keys of all matching records, written once before any status changes.

    Paging through a filter whose status changes with every page would skip
    records; a frozen key set cannot.
    """
    matching = apply_filters(records, spec)
    return pin(matching.select(_c(key).cast("string").alias("record_key")).distinct())


class PushRun:
    """A delivery run: mark, extract, map, write the outbox, then reconcile replies.

    ``extract`` turns keys into rows, ``document`` rows into documents; both name
    the record key column. The transport between ``send`` and ``finish`` is not
    part of this package: it reads the outbox and writes a response log.
    """

    def __init__(
        self,
        master: str,
        store: StatusStore,
        extract: Callable[[DataFrame], DataFrame],
        document: Callable[[DataFrame], DataFrame],
        row_key: str,
        document_key: str,
        batch_size: int,
    ):
        self.master, self.store = master, store
        self.extract, self.document = extract, document
        self.row_key, self.document_key = row_key, document_key
        self.batch_size = batch_size

    def send(self, keys: DataFrame, outbox: str, now: Column) -> DataFrame:
        """Mark keys as in flight and write their documents; returns the batches.

        The keys, the fetched keys and the batch of each document are written beside the outbox, so
        replies are judged against what was sent, also by a new process and whatever the source
        holds by then. A failure after the marking sets all keys of the run to failed.
        """
        facts = facts_of(outbox)
        keys.select("record_key").distinct().write.parquet(f"{facts}/keys")
        keys = self._fact(outbox, "keys")
        self.store.mark_in_flight(keys, self.master, now)
        try:
            rows = pin(self.extract(keys))
            fetched = rows.select(_c(self.row_key).cast("string").alias("record_key")).distinct()
            fetched.write.parquet(f"{facts}/fetched")
            documents = self.document(rows)
            keyed = documents.withColumn("record_key", _c(self.document_key).cast("string"))
            order = [c for c in ("record_key", "part_no") if c in keyed.columns]
            batches = assign_batches(keyed, order, self.batch_size)
            content = F.struct(*documents.columns)
            outbox_write(batches, outbox, self.master, content)
            batches.select("record_key", "batch_no").write.parquet(f"{facts}/batches")
        except Exception as error:
            self.abort(outbox, str(error), now)
            raise
        return self._fact(outbox, "batches")

    def finish(self, outbox: str, replies: DataFrame, now: Column) -> DataFrame:
        """Fold replies per batch (batch_no, ok, error_message) into record states."""
        mapped = self._fact(outbox, "batches")
        failed = (
            mapped.join(replies.filter(~_c("ok")), "batch_no")
            .groupBy("record_key")
            .agg(F.max_by("error_message", "batch_no").alias("error_message"))
        )
        keys, fetched = self._fact(outbox, "keys"), self._fact(outbox, "fetched")
        results = reconcile_missing(keys, fetched, mapped, failed)
        updates = results_to_updates(results, self.master, now)
        self.store.upsert(updates, self.master)
        return results

    def abort(self, outbox: str, message: str, now: Column) -> None:
        """Set every key of the run to failed, with the message."""
        results = self._fact(outbox, "keys").select(
            "record_key", F.lit(False).alias("success"), F.lit(message).alias("error_message")
        )
        updates = results_to_updates(results, self.master, now)
        self.store.upsert(updates, self.master)

    def push_all(
        self, records: DataFrame, spec: FilterSpec, key: str, outbox: str, now: Column
    ) -> DataFrame:
        """Send every record that matches the filter now, over a frozen key set."""
        return self.send(freeze_keys(records, spec, key), outbox, now)

    def _fact(self, outbox: str, name: str) -> DataFrame:
        schema = "record_key string" + (", batch_no bigint" if name == "batches" else "")
        return self.store.spark.read.schema(schema).parquet(f"{facts_of(outbox)}/{name}")


def facts_of(outbox: str) -> str:
    """Folder of what a run sent, beside its outbox."""
    return f"{outbox.rstrip('/')}_run"
