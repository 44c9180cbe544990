"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page id, so a shard holds a range of pages in order. A task writes its
shard's records as gzip members, rolls to a new file once the compressed size passes ``roll_bytes``,
and computes headers and digests anew. Files get temporary names that no other attempt uses; a task
returns one manifest row per file. Only after all tasks have ended is the manifest written as a
table, the files it names are moved to their final names by a job over its rows, and the commit
marker is set. A retried or duplicate attempt leaves files that no manifest names.

Of records with equal payloads of at least ``min_bytes``, the one with the largest page id is a
response and the others are revisits that refer to it; all other records are responses.

Nulls: null html is an empty payload, null url an empty target, rows with a null page id sort first
and never become a response for others unless all are null. Equal page ids (repeated rows) stay
separate records; with equal payloads, one of them is the response. Archives hold any bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.llm.common import arrow_schema, encoded
from outledger.session import pin

DATE = "2000-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space
MANIFEST = (
    "shard int, part int, temporary string, name string, n_records long, n_bytes long, "
    "sha256 string"
)
RECORDS = (
    "file string, place long, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, also of one written as file:/folder."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri.removeprefix('file:')}"
    return pafs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'page/{page_id}/{ordinal}')}>"


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, ordinal, refers_to`` of ``page_id, url, html``.

    ``ordinal`` numbers rows of equal page id and payload. ``refers_to`` is the page id of the
    response for revisits, else null. Payload keys are grouped with map-side combine; only keys
    that occur more than once are joined back.
    """
    key = F.sha2(F.encode("html", "UTF-8"), 256)
    size = F.octet_length("html")
    keyed = pages.withColumn("key", key).withColumn("size", size)
    repeated = (
        keyed.where(F.col("size") >= min_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("key").alias("of_key"), "response")
    )
    joined = keyed.join(pin(repeated), F.col("key") == F.col("of_key"), "left")
    revisit = F.col("of_key").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select(
        "page_id", "url", "html", F.col("of_key").isNotNull().alias("repeated"),
        F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit"),
    )


def make_record(row: dict, ordinal: int) -> bytes:
    """One gzip member: WARC headers, HTTP headers and, for a response, the payload."""
    payload = encoded(row["html"])
    again = row["revisit"] or ordinal > 0 and row["repeated"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if again else http + payload
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'], ordinal)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["page_id"] is not None:
        headers.append(f"X-Page-ID: {row['page_id']}")
    if again:
        target = row["refers_to"] if row["revisit"] else row["page_id"]
        headers.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        headers.append(f"WARC-Refers-To: {record_id(target, 0)}")
        headers.append(f"X-Payload-Bytes: {len(payload)}")
        if target is not None:
            headers.append(f"X-Refers-To-Page: {target}")
    whole = "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, compresslevel=6, mtime=0)


class Shard:
    """Files of one task, rolled by compressed size."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.fs, self.root = store(uri)
        self.shard, self.roll, self.part = shard, roll_bytes, 0
        self.attempt, self.out, self.done = uuid.uuid4().hex, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.temporary = f"_temporary/{self.attempt}-{self.part:05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.n, self.size, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.n, self.size = self.n + 1, self.size + len(member)
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        name = f"pages-{self.shard:06d}-{self.part:05d}.warc.gz"
        self.done.append(
            (self.shard, self.part, self.temporary, name, self.n, self.size, self.sha.hexdigest())
        )
        self.out, self.part = None, self.part + 1


def write_archives(
    pages: DataFrame, uri: str, shards: int, roll_bytes: int = 256 << 20, min_bytes: int = 0
) -> DataFrame:
    """Write archives of ``page_id, url, html`` below the shared folder ``uri``; the manifest.

    A shard is one sorted range; a page id that very many rows share is bounded by its rows being
    dealt by payload as well.
    """
    from pyspark import TaskContext

    spark = pages.sparkSession
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    schema = arrow_schema(spark, MANIFEST)
    order = ["page_id", F.xxhash64("html"), "html", "url"]
    sorted_rows = (
        with_roles(chosen, min_bytes)
        .repartitionByRange(shards, "page_id", F.xxhash64("html"))
        .sortWithinPartitions(*order)
    )
    root_fs, root = store(uri)
    root_fs.create_dir(f"{root}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(uri, TaskContext.get().partitionId(), roll_bytes)
        last, ordinal = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                same = (row["page_id"], row["html"] or "")
                ordinal = ordinal + 1 if same == last else 0
                last = same
                shard.add(make_record(row, ordinal))
        shard.close()
        if shard.done:
            columns = [pa.array(x) for x in zip(*shard.done, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    manifest = pin(sorted_rows.mapInArrow(run, MANIFEST))
    manifest.write.parquet(f"{uri}/_manifest")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = store(uri)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{top}/{row['name']}"
                if fs.get_file_info(final).type == pafs.FileType.NotFound:  # else a retried task
                    fs.move(f"{top}/{row['temporary']}", final)
            yield batch

    moved = manifest.mapInArrow(move, MANIFEST).count()
    with root_fs.open_output_stream(f"{root}/_COMMITTED") as out:
        out.write(f"{moved}\n".encode())
    return manifest


def members(stream) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, read in pieces."""
    unzip, got = zlib.decompressobj(31), io.BytesIO()
    piece = stream.read(1 << 20)
    while piece:
        got.write(unzip.decompress(piece))
        if unzip.eof:
            yield got.getvalue()
            piece = unzip.unused_data or stream.read(1 << 20)
            unzip, got = zlib.decompressobj(31), io.BytesIO()
        else:
            piece = stream.read(1 << 20)
    if got.tell():
        raise ValueError("an archive ends inside a record")


def parse_record(record: bytes) -> dict:
    """Fields of one record; its block digest and, for responses, payload digest are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(h["Content-Length"])]
    if h["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {h['WARC-Record-ID']}")
    revisit = h["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    found = h["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else digest(payload)
    if h["WARC-Payload-Digest"] != f"sha1:{found}":
        raise ValueError(f"damaged payload {h['WARC-Record-ID']}")
    page, refers = h.get("X-Page-ID"), h.get("X-Refers-To-Page")
    return {
        "page_id": None if page is None else int(page),
        "url": h["WARC-Target-URI"],
        "record_type": h["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "payload_bytes": int(h["X-Payload-Bytes"]) if revisit else len(payload),
        "payload_digest": found,
        "payload": payload,
    }


def read_archives(spark: SparkSession, uri: str, with_payload: bool = True) -> DataFrame:
    """``RECORDS`` of the files that the manifest of ``uri`` names, one task per few files."""
    fs, root = store(uri)
    if fs.get_file_info(f"{root}/_COMMITTED").type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{uri} holds no committed archives")
    files = spark.read.parquet(f"{uri}/_manifest").select("name")
    schema = arrow_schema(spark, RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(uri)
        for batch in batches:
            for name in batch.to_pydict()["name"]:
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for place, record in enumerate(members(stream)):
                        row = {"file": name, "place": place} | parse_record(record)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(record)
                        if held > 16 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.repartition(max(files.count(), 1), "name").mapInArrow(run, RECORDS)
