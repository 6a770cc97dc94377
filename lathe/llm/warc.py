"""WARC archives as a PySpark Python data source.

Writing: one record per row, each in a gzip member of its own whose extra
field ``sl`` tells its packed length (WARC 1.1, annex D), so a reader can step
over it. Tasks write files of bounded size beside the target; the commit moves
those of the attempts that counted, so a lost executor leaves nothing behind.

Reading: files are dealt to partitions by size. Predicates on ``record_type``,
``record_id``, ``target_uri`` and ``refers_to`` are pushed down. Of a record
the header is unpacked first; the payload is unpacked only if the predicates
hold and the requested schema has a payload, else the reader seeks past it.

Paths are opened with pyarrow's file systems, so any store it knows works.

Defined cases: a null payload is written as an empty one; null text fields are
left out and read as null; a file without records gives no rows; line breaks
in a header value become blanks; members without ``sl`` and plain ``.warc``
files are read too, streamed.
"""

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from ..session import fresh_dir

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length"}
PUSHED = ("record_id", "record_type", "target_uri", "refers_to")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a task begins a new file, and that a read partition holds.
FILE_BYTES = 64 << 20
#: Bytes read and unpacked at once while a header is sought.
LOOK = 4096
BLOCK_END = b"\r\n\r\n"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri(os.path.abspath(path.removeprefix("file:")))


def encode_record(row: dict) -> bytes:
    """Header, block and end of one record, unpacked."""
    kind, payload = row.get("record_type") or "response", row.get("payload") or b""
    block = b"" if kind == "revisit" else HTTP_HEAD + payload
    head = {FIELDS[k]: row.get(k) for k in FIELDS}
    head |= {"WARC-Type": kind, "Content-Type": "application/http;msgtype=response", "Content-Length": len(block)}
    if kind == "revisit":
        head["WARC-Profile"] = REVISIT
    lines = [f"{k}: {' '.join(str(v).splitlines())}" for k, v in head.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + BLOCK_END + block + BLOCK_END


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member with its packed and unpacked lengths in the extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(data) + z.flush()
    total = 24 + len(packed) + 8
    if total >= 1 << 32 or len(data) >= 1 << 32:
        return struct.pack("<4BI2B", 31, 139, 8, 0, 0, 0, 255) + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return struct.pack("<4BI2BH", 31, 139, 8, 4, 0, 0, 255, len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(data), len(data))


def parse_head(head: bytes) -> dict:
    names = {v.lower(): k for k, v in FIELDS.items()}
    out: dict = {"length": 0, "http": False}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        key, value = k.decode(errors="replace").strip().lower(), v.decode(errors="replace").strip()
        if key in names:
            out[names[key]] = value
        elif key == "content-length":
            out["length"] = int(value)
        elif key == "content-type":
            out["http"] = value.startswith("application/http")
    if "payload_bytes" in out:
        out["payload_bytes"] = int(out["payload_bytes"])
    return out


def read_member(f, wanted, payload: bool) -> Iterator[dict | None]:
    """Records of a gzip file; None for each one that is stepped over."""
    while start := f.read(24):
        packed = None
        if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
            packed = struct.unpack("<I", start[16:20])[0] - 24
        if packed is None:
            yield from read_stream(_Unzip(start, f), wanted, payload)
            return
        at, z, data = f.tell(), zlib.decompressobj(-15), b""
        body = f.read(min(packed, LOOK))
        while BLOCK_END not in data:
            part = z.decompress(body, LOOK)
            if not part and not body:
                raise ValueError("record without a header")
            data, body = data + part, z.unconsumed_tail or f.read(LOOK)
        head, _, rest = data.partition(BLOCK_END)
        record = parse_head(head)
        if not wanted(record):
            f.seek(at + packed)
            yield None
            continue
        if payload:
            left = f.read(max(0, at + packed - f.tell()))
            rest += z.decompress(body + left)
            record["payload"] = body_of(rest[: record["length"]], record)
        f.seek(at + packed)
        yield record


class _Unzip(io.RawIOBase):
    """Members of a gzip stream, one after another, as plain bytes."""

    def __init__(self, start: bytes, f):
        self.f, self.z, self.tail = f, zlib.decompressobj(31), start

    def readable(self):
        return True

    def readinto(self, buffer):
        while True:
            data = self.tail or self.f.read(1 << 16)
            if not data:
                return 0
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            out = self.z.decompress(data, len(buffer))
            self.tail = self.z.unconsumed_tail or self.z.unused_data
            if out:
                buffer[: len(out)] = out
                return len(out)


def read_stream(raw, wanted, payload: bool) -> Iterator[dict | None]:
    """Records of plain WARC bytes; steps over payloads that are not wanted."""
    f = io.BufferedReader(raw, 1 << 20)
    while line := f.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = [line]
        while (line := f.readline()).strip():
            head.append(line)
        record = parse_head(b"".join(head).strip().replace(b"\r\n", b"\n").replace(b"\n", b"\r\n"))
        keep = wanted(record)
        left = record["length"]
        if keep and payload:
            record["payload"] = body_of(f.read(left), record)
        elif f.seekable():
            f.seek(left, 1)
        else:
            while left > 0 and (part := f.read(min(left, 1 << 20))):
                left -= len(part)
        yield record if keep else None


def body_of(block: bytes, record: dict) -> bytes:
    return block.partition(BLOCK_END)[2] if record["http"] else block


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = schema.fieldNames()
        self.arrow = schema
        self.path = options["path"]
        self.tests: list[tuple[str, tuple | None]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if name not in PUSHED:
                yield f
            elif isinstance(f, IsNotNull):
                self.tests.append((name, None))
            else:
                self.tests.append((name, f.value if isinstance(f, In) else (f.value,)))

    def wanted(self, record: dict) -> bool:
        return all(record.get(k) is not None and (v is None or record[k] in v) for k, v in self.tests)

    def partitions(self):
        fs, root = open_fs(self.path)
        info = fs.get_file_info(pafs.FileSelector(root, recursive=False))
        found = [i for i in info if i.is_file and i.base_name.endswith((".warc", ".warc.gz")) and i.base_name[0] not in "._"]
        groups, held = [[]], 0
        for i in sorted(found, key=lambda i: i.path):
            if groups[-1] and held + i.size > FILE_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(i.path)
            held += i.size
        return [Files(g) for g in groups]

    def read(self, partition):
        fs, payload = open_fs(self.path)[0], "payload" in self.columns
        types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, types.get(c, pa.string())) for c in self.columns])
        rows, held = [], 0
        for path in partition.value:
            with fs.open_input_file(path) as f:
                records = read_member(f, self.wanted, payload) if path.endswith(".gz") else read_stream(f, self.wanted, payload)
                for r in records:
                    if r is None:
                        continue
                    rows.append({c: r.get(c) for c in self.columns})
                    held += len(r.get("payload") or b"") + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Written(WriterCommitMessage):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.job = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, root = open_fs(self.path)
        fs.create_dir(f"{root}/{self.job}")
        paths, f = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if f is None or f.tell() > FILE_BYTES:
                    if f:
                        f.close()
                    paths.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    f = fs.open_output_stream(f"{root}/{self.job}/{paths[-1]}", compression=None)
                f.write(member(encode_record(row)))
        if f:
            f.close()
        return Written(paths)

    def commit(self, messages):
        fs, root = open_fs(self.path)
        if self.overwrite:
            for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if i.is_file and i.base_name.endswith((".warc", ".warc.gz")):
                    fs.delete_file(i.path)
        for m in messages:
            for p in m.paths if m else []:
                fs.move(f"{root}/{self.job}/{p}", f"{root}/{p}")
        self.abort(messages)

    def abort(self, messages):
        fs, root = open_fs(self.path)
        fs.create_dir(f"{root}/{self.job}")
        fs.delete_dir(f"{root}/{self.job}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def write_warc(records: DataFrame, path: str) -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records of a folder; leave ``payload`` out of the schema to read headers only."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(schema).load(path)


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """Rows as WARC records; of equal payloads of ``least_bytes`` or more the
    smallest id is the response and the others revisit it."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("target_uri"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    again = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(again, "digest", "left").select(
        F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_bytes",
        F.when(revisit, F.lit(None).cast("binary")).otherwise(F.col("payload")).alias("payload"),
    )


def archive_pages(pages: DataFrame, id_col: str = "page_id", path: str | None = None, **columns) -> DataFrame:
    """Write the rows as archives and read them back: id, payload_bytes,
    payload_digest, record_type, refers_to. Lengths and digests of responses
    are taken from the payload that was read, those of revisits from headers."""
    spark = pages.sparkSession
    path = path or fresh_dir(spark, "warc")
    write_warc(archive_records(pages, id_col, **columns), path)
    head = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long"
    revisits = read_warc(spark, path, head).where("record_type = 'revisit'")
    revisits = revisits.select("record_id", "record_type", "refers_to", F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "payload_bytes")
    responses = read_warc(spark, path, "record_id string, record_type string, refers_to string, payload binary").where("record_type = 'response'")
    responses = responses.select("record_id", "record_type", "refers_to", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    kind = pages.schema[id_col].dataType.simpleString()

    def page(c):
        return F.regexp_extract(c, "^<urn:page:(.*)>$", 1).cast(kind)

    return responses.union(revisits).select(page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
