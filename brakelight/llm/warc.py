"""WARC archives: a parallel writer with revisit records, and a Python data source that reads headers first."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
                                    StringContains, StringEndsWith, StringStartsWith)

from .common import open_fs, text_or_empty

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = (T.StructType().add("file", "string").add("start", "long").add("end", "long").add("records", "long"))
#: column of the data source -> header field, for columns that are plain header text
_HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
            "warc_date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
SCHEMA = (T.StructType().add("record_id", "string").add("record_type", "string").add("target_uri", "string")
          .add("warc_date", "string").add("refers_to", "string").add("payload_digest", "string")
          .add("content_length", "long").add("payload_length", "long").add("payload", "binary")
          .add("file", "string").add("offset", "long"))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(record: bytes, level: int) -> bytes:
    """A gzip member holding one record; its ``sl`` extra field gives the compressed and the plain length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    extra = b"sl" + (8).to_bytes(2, "little")
    size = 10 + 2 + 12 + len(body) + 8
    extra += (size & 0xFFFFFFFF).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra + body
            + zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little"))


def _record(record_id: str, url: str | None, payload: bytes, refers: str | None, date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    if refers:
        head += [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2026-01-01T00:00:00Z",
               range_bytes: int = 32 << 20, level: int = 5, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``path`` (compressed record by record) and return the manifest.

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with the largest id becomes a response and
    the others revisit it; smaller payloads are all responses. Payloads are matched on length and SHA-256. Record
    ids are ``urn:page:<id>:<row>``, where row tells rows that repeat an id apart. Each task writes files of its own,
    named by its attempt; the manifest lists byte ranges of about ``range_bytes`` that begin at records, of the attempts
    that count. Null payloads are empty, null ids lose against any id, null addresses give no target; an
    empty table writes no records; further columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(payload_col).alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long"))
    # a payload below the limit matches nothing but itself
    rows = rows.withColumn("same", F.when(F.col("size") >= min_bytes, F.sha2("payload", 256))
                           .otherwise(F.concat(F.lit("row:"), F.col("row").cast("string"))))
    first = rows.groupBy("same", "size").agg(F.max(F.struct("id", "row")).alias("top"))
    keyed = rows.join(first, ["same", "size"]).select("id", "row", "url", "payload", "top.id", "top.row").toDF(
        "id", "row", "url", "payload", "top_id", "top_row")

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.warc.gz"
        sink, at, start, n, found = None, 0, 0, 0, []
        name_of = lambda i, r: f"urn:page:{'' if i is None else i}:{r}"
        for b in batches:
            if b.num_rows and sink is None:
                fs, local = open_fs(path)
                sink = fs.open_output_stream(f"{local}/{name}", compression=None)
            for k in range(b.num_rows):
                i, r, url, text, ti, tr = (c[k].as_py() for c in b.columns)
                data = _member(_record(name_of(i, r), url, (text or "").encode("utf-8", "surrogatepass"),
                                       None if r == tr else name_of(ti, tr), date), level)
                sink.write(data)
                at, n = at + len(data), n + 1
                if at - start >= range_bytes:
                    found.append((name, start, at, n))
                    start, n = at, 0
        if sink is not None:
            sink.close()
            if n:
                found.append((name, start, at, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), *[pa.array([x[j] for x in found], pa.int64()) for j in (1, 2, 3)]],
                names=_MANIFEST.names)

    fs, local = open_fs(path)
    fs.create_dir(local, recursive=True)
    keyed.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{path}/_manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int | None):
        self.file, self.start, self.end = file, start, end


class WarcDataSource(DataSource):
    """Reads WARC files (plain or compressed record by record): ``spark.read.format("warc").load(path)``.

    Options: ``path`` (a file or a folder) and ``verify`` (recompute the digest of decoded payloads). With a manifest
    in the folder each of its byte ranges is a partition, otherwise each file is. A schema given by the user may
    leave out columns; without ``payload`` no payload is decompressed beyond its headers.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns, self.options, self.tests = schema.names, options, []

    def pushFilters(self, filters):
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            if (column in _HEADERS or column in ("content_length",)) and isinstance(
                    f, (EqualTo, EqualNullSafe, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual,
                        StringStartsWith, StringEndsWith, StringContains, IsNotNull)):
                self.tests.append((column, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        fs, local = open_fs(self.options["path"])
        if fs.get_file_info(local).type == pafs.FileType.File:
            return [_Range(local, 0, None)]
        if fs.get_file_info(f"{local}/_manifest").type == pafs.FileType.Directory:
            rows = pq.read_table(f"{local}/_manifest", filesystem=fs).to_pylist()
            return [_Range(f"{local}/{r['file']}", r["start"], r["end"]) for r in rows]
        files = fs.get_file_info(pafs.FileSelector(local, recursive=True))
        return [_Range(f.path, 0, None) for f in files if re.search(r"\.warc(\.gz)?$", f.path)]

    def read(self, partition):
        fs, _ = open_fs(self.options["path"])
        verify = str(self.options.get("verify", "false")).lower() == "true"
        need_block = any(c in self.columns for c in ("payload", "payload_length")) or verify
        with fs.open_input_file(partition.file) as f:
            end = partition.end if partition.end is not None else f.size()
            at = partition.start
            while at < end:
                record = _open_record(f, at, end)
                if record is None:
                    break
                fields = record.fields
                if all(_passes(fields, t) for t in self.tests):
                    yield self._row(partition.file, at, record, fields, need_block, verify)
                at = record.next()

    def _row(self, file, at, record, fields, need_block, verify):
        payload, length = None, None
        if need_block:
            http, length = record.http()
            if ("payload" in self.columns or verify) and fields.get("warc-type") != "revisit":
                payload = record.payload()
                length = len(payload) if length is None else length
                said = fields.get("warc-payload-digest", "")
                if verify and said.startswith("sha1:") and said[5:] != sha1_base32(payload):
                    raise ValueError(f"{file}, offset {at}: the payload does not match its digest")
        values = {"content_length": int(fields.get("content-length", 0)), "payload_length": length,
                  "payload": payload, "file": file, "offset": at}
        return tuple(values[c] if c in values else fields.get(_HEADERS[c]) for c in self.columns)


def _passes(fields: dict, test) -> bool:
    column, kind, want = test
    got = fields.get(_HEADERS[column]) if column in _HEADERS else int(fields.get("content-length", 0))
    if kind == "EqualNullSafe":
        return got == want
    if got is None:
        return False
    return {"EqualTo": lambda: got == want, "In": lambda: got in want, "GreaterThan": lambda: got > want,
            "GreaterThanOrEqual": lambda: got >= want, "LessThan": lambda: got < want,
            "LessThanOrEqual": lambda: got <= want, "StringStartsWith": lambda: got.startswith(want),
            "StringEndsWith": lambda: got.endswith(want), "StringContains": lambda: want in got,
            "IsNotNull": lambda: True}[kind]()


class _Record:
    """One record: header fields are parsed at once, the block only on request."""

    STEP = 1 << 13

    def __init__(self, f, at: int, end: int, gzipped: bool):
        self.f, self.at, self.limit, self.gzipped = f, at, end, gzipped
        self.pos, self.data, self.done, self.skip = at, b"", False, None
        if gzipped:
            f.seek(at)
            head = f.read(24)
            if len(head) > 3 and head[3] & 4 and head[12:14] == b"sl":
                self.skip = int.from_bytes(head[16:20], "little")
            self.z = zlib.decompressobj(31)
        while b"\r\n\r\n" not in self.data and self._more():
            pass
        head, _, self.block = self.data.partition(b"\r\n\r\n")
        self.head_size = len(head) + 4
        self.fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            k, v = k.strip().lower(), v.strip()
            self.fields[k] = v[1:-1] if v.startswith("<") and v.endswith(">") else v
        self.length = int(self.fields.get("content-length", 0))

    def _more(self) -> bool:
        """Decode a little more; False at the end of the record (compressed) or of the range."""
        if self.done:
            return False
        if self.gzipped:
            raw = self.z.unconsumed_tail
            if not raw:
                self.f.seek(self.pos)
                raw = self.f.read(min(self.STEP, self.limit - self.pos))
                self.pos += len(raw)
                if not raw:
                    self.done = True
                    return False
            self.data += self.z.decompress(raw, 1 << 16)
            self.done = self.z.eof
            return True
        self.f.seek(self.pos)
        raw = self.f.read(self.STEP)
        self.pos += len(raw)
        self.data += raw
        self.done = not raw
        return bool(raw)

    def _read_block(self) -> bytes:
        want = self.head_size + self.length
        if self.gzipped:
            parts = [self.data]
            while not self.done:
                self.data = b""
                if not self._more():
                    break
                parts.append(self.data)
            self.data = b"".join(parts)
        elif len(self.data) < want:
            self.f.seek(self.pos)
            self.data += self.f.read(want - len(self.data))
            self.pos = self.at + len(self.data)
        return self.data[self.head_size:want]

    def http(self) -> tuple[bytes, int | None]:
        """(HTTP headers, their Content-Length) of the block, decoding no further than the blank line."""
        if "application/http" not in self.fields.get("content-type", ""):
            return b"", None
        while b"\r\n\r\n" not in self.data[self.head_size:] and len(self.data) < self.head_size + self.length:
            if not self._more():
                break
        head = self.data[self.head_size:self.head_size + self.length].partition(b"\r\n\r\n")[0]
        m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return head, int(m[1]) if m else None

    def payload(self) -> bytes:
        block = self._read_block()
        if "application/http" in self.fields.get("content-type", ""):
            return block.partition(b"\r\n\r\n")[2]
        return block

    def next(self) -> int:
        if not self.gzipped:
            return self.at + self.head_size + self.length + 4
        if self.skip:
            return self.at + self.skip
        while not self.done:  # no length field: run to the end of the member, keeping nothing
            self.data = b""
            if not self._more():
                break
        return self.pos - len(self.z.unused_data)


def _open_record(f, at: int, end: int) -> _Record | None:
    f.seek(at)
    magic = f.read(2)
    if len(magic) < 2:
        return None
    return _Record(f, at, end, magic == b"\x1f\x8b")


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, verify: bool = False) -> DataFrame:
    """The records of a file or folder; filters on header columns are pushed into the reader."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").option("verify", str(verify).lower())
    if columns:
        reader = reader.schema(T.StructType([SCHEMA[c] for c in columns]))
    return reader.load(path)


def page_of(record_id: Column) -> Column:
    """The page id in a record id of ``write_warc``; null where it was null."""
    digits = F.regexp_extract(record_id, r"^urn:page:(-?[0-9]*):", 1)
    return F.when(digits != "", digits.cast("long"))
