"""WARC archives: pages written as records, and read back as a table of chunks."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payments_lake.llm.common import shared_folder, text_or_empty

CHUNK = 64 * 1024
SALTS = 16
LINE = b"\r\n"
# Named by the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date; a constant keeps archives reproducible

CHUNK_SCHEMA = (
    "record_id string, page_id bigint, record_type string, refers_to bigint, target_uri string,"
    " chunk_no bigint, chunk_bytes bigint, payload_bytes bigint, payload_digest string,"
    " is_last boolean, data binary"
)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, its SHA-1 in hex, and refers_to (null: the record is a response).

    Of equal payloads of at least ``min_bytes`` that with the largest page_id is the response. Only
    repeated digests are joined back; both sides are salted by page_id, so a payload that holds a
    third of the rows is spread over ``SALTS`` keys. Rows without a page_id refer to the largest of
    their group; rows that repeat the largest page_id are all responses.
    """
    keyed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        text_or_empty("html").alias("payload"),
    ).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    large = F.octet_length("payload") >= min_bytes
    keepers = (
        keyed.filter(large).groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    refers = large & ((F.col("page_id") < F.col("keeper")) | F.col("page_id").isNull())
    return salted.join(keepers, ["sha1", "salt"], "left").select(
        "page_id", "url", "payload", "sha1", F.when(refers, F.col("keeper")).alias("refers_to")
    )


def record_head(page_id, url, digest: str, size: int, refers_to) -> bytes:
    """The header lines of a record with its HTTP head, up to where the payload begins."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "about:blank"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("X-Payload-Length", str(size))]
    content = len(http) + (size if refers_to is None else 0)
    fields.append(("Content-Length", str(content)))
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return VERSION + LINE + lines + LINE + http


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Writes one archive per task below ``folder`` and returns the table of finished archives.

    Each record is a gzip member of its own; payloads are compressed chunk by chunk from the Arrow
    buffer. A task that is run again writes a new file, and only files of the returned table count,
    so archives of lost tasks are never read. Any folder that pyarrow can open may be given.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        records = 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                ids, urls, hashes, refers = (
                    batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "refers_to")
                )
                for i, payload in enumerate(batch.column("payload")):
                    body = memoryview(payload.as_buffer() or b"")
                    digest = base64.b32encode(bytes.fromhex(hashes[i])).decode()
                    packed = zlib.compressobj(4, zlib.DEFLATED, 31)
                    out.write(packed.compress(record_head(ids[i], urls[i], digest, len(body), refers[i])))
                    if refers[i] is None:
                        for at in range(0, len(body), chunk):
                            out.write(packed.compress(body[at : at + chunk]))
                    out.write(packed.compress(LINE + LINE) + packed.flush())
                    records += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64())], ["file", "records"]
        )

    spark = pages.sparkSession
    finished = f"{folder}/finished"
    with_revisits(pages, min_bytes).mapInArrow(write, "file string, records bigint").write.parquet(finished)
    return spark.read.schema("file string, records bigint").parquet(finished)


class Inflated:
    """Lines and blocks of a file of gzip members, holding one block at a time."""

    def __init__(self, raw, block: int) -> None:
        self.raw, self.block = raw, block
        self.gunzip, self.pending, self.have = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if self.gunzip.eof:
                self.pending = self.gunzip.unused_data
                self.gunzip = zlib.decompressobj(31)
            pending = self.pending or self.raw.read(self.block)
            if not pending:
                return False
            new = self.gunzip.decompress(pending, self.block)
            self.pending = self.gunzip.unconsumed_tail
            if new:
                self.have += new
                return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.have.find(LINE)) < 0:
            if not self._more():
                if self.have:
                    raise ValueError("the archive ends within a line")
                return None
        line, self.have = self.have[:end], self.have[end + 2 :]
        return line

    def take(self, most: int) -> bytes:
        """At least one byte and at most ``most`` of what follows."""
        if not self.have and not self._more():
            raise ValueError("the archive ends within a record")
        part, self.have = self.have[:most], self.have[most:]
        return part


def fields_of(stream: Inflated) -> dict[str, str]:
    fields = {}
    while line := stream.line():
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return fields


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def chunks_of(stream: Inflated, chunk: int) -> Iterator[tuple]:
    """Rows of CHUNK_SCHEMA. The digest is carried from chunk to chunk; at a response's last chunk
    it must equal the digest that the record states. A record holds one chunk in memory."""
    while (line := stream.line()) is not None:
        if not line:
            continue
        if line != VERSION:
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = fields_of(stream)
        left = int(fields["content-length"])
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        kind = fields["warc-type"]
        head = (fields["warc-record-id"], page_of(fields["warc-record-id"]), kind,
                page_of(fields.get("warc-refers-to")), fields.get("warc-target-uri"))
        if fields.get("content-type", "").startswith("application/http"):
            while line := stream.line():
                left -= len(line) + 2
            left -= 2
        if kind == "revisit":
            if left:
                raise ValueError("a revisit record with a payload")
            yield *head, 0, 0, int(fields["x-payload-length"]), stated, True, b""
            continue
        digest, number, size = hashlib.sha1(), 0, 0
        part = b""
        while True:
            while left and len(part) < chunk:
                new = stream.take(min(left, chunk - len(part)))
                part, left = part + new, left - len(new)
            digest.update(part)
            size += len(part)
            sofar = base64.b32encode(digest.digest()).decode()
            if not left and stated and sofar != stated:
                raise ValueError(f"{head[0]}: the payload doesn't have its stated digest")
            yield *head, number, len(part), size, sofar, not left, part
            if not left:
                break
            number, part = number + 1, b""


def read_chunks(
    spark: SparkSession, archives: DataFrame, chunk: int = CHUNK, with_data: bool = True
) -> DataFrame:
    """The records of the archives as rows of at most ``chunk`` payload bytes.

    Row (record_id, chunk_no) has the bytes, and the size and SHA-1 of the payload so far; the row
    with is_last has those of the whole payload. An empty payload has one empty chunk; a revisit
    has one too, with the size and digest it states. Files are spread over the tasks and streamed,
    so neither a file nor a record is ever held whole. ``with_data=False`` leaves data null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("target_uri", pa.string()), ("chunk_no", pa.int64()),
            ("chunk_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("is_last", pa.bool_()), ("data", pa.binary()),
        ])
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for files in batches:
            for name in files.column("file").to_pylist():
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_stream(path, compression=None) as raw:
                    for row in chunks_of(Inflated(raw, chunk), chunk):
                        rows.append(row if with_data else (*row[:-1], None))
                        held += len(row[-1]) * with_data + 200
                        if held >= 64 * chunk:
                            yield batch()
                            rows, held = [], 0
        if rows:
            yield batch()

    tasks = max(archives.count(), 1)
    return archives.select("file").repartition(tasks).mapInArrow(read, CHUNK_SCHEMA)


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as archives in the shared folder, reads these back, and returns per page:
    page_id, payload_bytes, payload_digest (base32 SHA-1), record_type, refers_to.

    A null html is an empty payload, a null or empty url becomes about:blank; repeated rows give a
    record each; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    archives = write_archives(pages, shared_folder(spark) + "/warc", min_bytes)
    return read_chunks(spark, archives, with_data=False).filter("is_last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
