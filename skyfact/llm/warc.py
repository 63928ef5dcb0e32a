"""WARC archives as a chunked record table.

The data source ``warc`` writes and reads folders of gzip members, one for each record.  Both ways a
record is a run of rows with its identifier and a chunk number.  Writer and reader hold a bounded batch
of chunks and carry the digest on from chunk to chunk: the writer refuses a record whose chunks don't
add up to the digest and length in its head, and the last row that the reader makes of a record has
both of the whole.  Before, where Spark cuts a page into rows, the page is one value of its table.

A task's archive becomes visible only when the job is committed, under a name of its own; the folder
then has ``_SUCCESS``, without which it isn't read, and what lost or repeated tasks wrote is deleted.
Folders are those of Spark's file systems: ``write_warc`` and ``read_warc`` resolve a path without a scheme,
or below a mount, on the driver.  Executors open what comes of it by Arrow, which knows local, HDFS,
S3, Google and Azure stores; any other scheme raises, as does a path without one in the format's options.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from skyfact.llm.shared import stored
from skyfact.session import scratch_dir

CHUNK_BYTES = 1 << 18
#: Payload in a batch on its way to the writer, at most
BATCH_BYTES = 1 << 24
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1

WRITTEN = "record_id string, chunk_no int, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, data binary"
READ = "archive string, record_no long, record_id string, chunk_no int, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, data binary, bytes_so_far long, digest_so_far string, last boolean"


#: Hadoop's names of stores, and Arrow's
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{path}: name the file system, for executors don't see each other's disks")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def resolved(spark: SparkSession, path: str, create: bool = False) -> str:
    """The folder as its file system names it, with a scheme; one that isn't there raises, if not to be created."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if create:
        system.mkdirs(place)
    return system.resolvePath(place).toString()


@dataclass
class _Wrote(WriterCommitMessage):
    name: str


def record_head(record_id: str, record_type: str, uri: str | None, refers_to: str | None, payload_bytes: int, digest: str, date: str = DATE) -> bytes:
    """Everything of a record in front of its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    clean = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri or f"urn:{record_id}")
    lines = ["WARC/1.0", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}"]
    if record_type == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:{refers_to}>"]
    size = len(http) + (payload_bytes if record_type == "response" else 0)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        with where.open_output_stream(f"{root}/.{name}", compression=None) as out:
            record = None
            for batch in iterator:
                cols = {c: batch.column(c) for c in batch.schema.names}
                firsts = {c: cols[c].to_pylist() for c in cols if c != "data"}
                for i, data in enumerate(cols["data"]):
                    if firsts["chunk_no"][i] == 0:
                        if record:
                            record.close()
                        record = _Record(out, *[firsts[c][i] for c in _HEAD])
                    record.add(firsts["record_id"][i], firsts["chunk_no"][i], data.as_buffer() or b"")
            if record:
                record.close()
        return _Wrote(name)

    def _clean(self, where, root):
        for left in where.get_file_info(fs.FileSelector(root)):
            if left.base_name.startswith(".part-") and left.base_name.endswith(".warc.gz"):
                where.delete_file(left.path)

    def commit(self, messages):
        where, root = _open(self.path)
        for m in filter(None, messages):
            where.move(f"{root}/.{m.name}", f"{root}/{m.name}")
        self._clean(where, root)
        with where.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages):
        self._clean(*_open(self.path))


_HEAD = ("record_id", "record_type", "uri", "refers_to", "payload_bytes", "payload_digest")


class _Record:
    """One gzip member, written chunk by chunk; its digest runs along."""

    def __init__(self, out, record_id, record_type, uri, refers_to, payload_bytes, digest):
        self.out, self.id, self.response, self.stated, self.left, self.next = out, record_id, record_type == "response", digest, payload_bytes, 0
        self.digest = hashlib.sha1()
        self.packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out.write(self.packer.compress(record_head(record_id, record_type, uri, refers_to, payload_bytes, digest)))

    def add(self, record_id, chunk_no, data):
        if (record_id, chunk_no) != (self.id, self.next):
            raise ValueError(f"{record_id}: chunk {chunk_no} after {self.next - 1} of {self.id}")
        self.next += 1
        if self.response:
            self.digest.update(data)
            self.left -= len(data)
            self.out.write(self.packer.compress(data))

    def close(self):
        if self.response and (self.left or self.digest.hexdigest() != self.stated):
            raise ValueError(f"{self.id}: the chunks are not the payload that the head states")
        self.out.write(self.packer.compress(b"\r\n\r\n") + self.packer.flush())


@dataclass
class _Archive(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, path: str, chunk: int):
        self.path, self.chunk = path, chunk

    def partitions(self):
        where, root = _open(self.path)
        files = where.get_file_info(fs.FileSelector(root))
        if files and not any(f.base_name == "_SUCCESS" for f in files):
            raise ValueError(f"{self.path}: its writing did not end")
        return [_Archive(f.base_name) for f in sorted(files, key=lambda f: f.base_name) if f.base_name.endswith(".warc.gz") and not f.base_name.startswith(".")]

    def read(self, partition):
        if partition is None or not getattr(partition, "name", None):
            return
        where, root = _open(self.path)
        schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[k]) for n, k in (f.split() for f in READ.split(", "))])
        rows, held = [], 0
        with where.open_input_stream(f"{root}/{partition.name}", compression=None) as raw, gzip.open(io.BufferedReader(_Raw(raw), 1 << 16)) as stream:
            for row in records(stream, self.chunk):
                rows.append({"archive": partition.name, **row})
                held += len(row["data"])
                if held >= 4 << 20 or len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class _Raw(io.RawIOBase):
    """An Arrow stream as a Python one."""

    def __init__(self, stream):
        self.stream = stream

    def readable(self):
        return True

    def readinto(self, buffer):
        data = self.stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _header(stream) -> dict[str, str] | None:
    first = stream.readline()
    if not first:
        return None
    out = {"": first.strip().decode()}
    while (line := stream.readline().strip()) != b"":
        name, _, value = line.decode().partition(":")
        out[name.lower()] = value.strip()
    return out


def records(stream, chunk: int = CHUNK_BYTES):
    """Rows of all records of an unpacked archive, at most ``chunk`` bytes of payload in each; a record without payload has one."""
    no = 0
    while True:
        head = _header(stream)
        if head is None:
            return
        if not head[""].startswith("WARC/"):
            raise ValueError(f"record {no}: no WARC record begins here")
        left = int(head["content-length"])
        http = _header(stream)
        left -= 4 + len(http[""]) + sum(len(k) + len(v) + 4 for k, v in http.items() if k)
        named = lambda key: head[key][5:-1] if key in head else None  # noqa: E731  <urn:...>
        row = {
            "record_no": no, "record_id": named("warc-record-id"), "record_type": head["warc-type"], "uri": head.get("warc-target-uri"),
            "refers_to": named("warc-refers-to"), "payload_bytes": int(http["content-length"]), "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
        }
        digest, seen, k = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError(f"record {no}: cut off")
            digest.update(data)
            left, seen = left - len(data), seen + len(data)
            yield row | {"chunk_no": k, "data": data, "bytes_so_far": seen, "digest_so_far": digest.hexdigest(), "last": left == 0}
            k += 1
            if not left:
                break
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {no}: its length is wrong")
        no += 1


class WarcSource(DataSource):
    """Format ``warc``; options: path, chunk (bytes of payload in a row that is read)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return READ

    def reader(self, schema):
        return _Reader(self.options["path"], int(self.options.get("chunk", CHUNK_BYTES)))

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"])


def record_rows(pages: DataFrame, chunk: int = CHUNK_BYTES, least: int = LEAST_REVISIT) -> DataFrame:
    """(id, uri, html) -> rows for the writer.  Of equal payloads of at least ``least`` bytes the largest id
    has the response, and others revisit it; rows that repeat that id are responses too."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("id").cast("long").alias("id"), F.col("uri").cast("string").alias("uri"), payload.alias("payload"))
    key = [F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("long").alias("payload_bytes")]
    # the few payloads that come more than once, as a table whose size Spark knows when it plans the join
    often = stored(pages.select("id", *key).filter(F.col("payload_bytes") >= least).groupBy("sha").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("sha").alias("_sha"), "first"), "warc-repeats")
    rows = pages.select("*", *key, F.sha1("payload").alias("payload_digest")).join(often, F.col("sha") == F.col("_sha"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("page:"), F.coalesce(c.cast("string"), F.lit("null")))
    rows = rows.select(
        name(F.col("id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "uri",
        F.when(revisit, name(F.col("first"))).alias("refers_to"), "payload_bytes", "payload_digest", F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")).alias("body"),
    )
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("body") / chunk) - 1, F.lit(0)).cast("int"))
    return rows.withColumn("chunk_no", F.explode(cuts)).select(
        "record_id", "chunk_no", "record_type", "uri", "refers_to", "payload_bytes", "payload_digest", F.expr(f"substring(body, chunk_no * {chunk} + 1, {chunk})").alias("data")
    )


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def write_warc(pages: DataFrame, path: str, chunk: int = CHUNK_BYTES) -> None:
    """Write (id, uri, html) as WARC archives into a new folder, one for each partition.

    Null html is an empty payload; a null uri gives way to the record's name; null ids are named null.
    """
    spark = pages.sparkSession
    _registered(spark)
    rows, before = record_rows(pages, chunk), spark.conf.get(_ROWS_CONF)
    spark.conf.set(_ROWS_CONF, str(max(1, BATCH_BYTES // chunk)))
    try:
        rows.write.format("warc").mode("append").save(resolved(spark, path, create=True))
    finally:
        spark.conf.set(_ROWS_CONF, before)


def read_warc(spark: SparkSession, path: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The chunk rows of all archives of a folder: see READ.  An empty folder gives no rows, one whose writing did not end raises."""
    _registered(spark)
    return spark.read.format("warc").option("chunk", chunk).load(resolved(spark, path))


def archived(pages: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Write the pages to the shared folder, and read the record table back."""
    path = f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, chunk)
    return read_warc(pages.sparkSession, path, chunk)
