"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading. The driver lists the archives and deals them over partitions of about equal size. Conditions on
``record_type`` and the other header columns are pushed down (``spark.sql.python.filterPushdown.enabled``). A task parses the header
block of a record first; a record that a condition rejects, or whose payload nobody wants (option ``payload=false``), is skipped: a plain
archive by a seek, a compressed one by the skip lengths of its gzip member where they are given, else by inflating without keeping.

Writing. Every record is a gzip member of its own with skip lengths (extra field ``sl``: length of the deflated data and trailer, length of the
plain data). A task writes under fresh names; a manifest written at commit lists the files of successful tasks, and readers follow it, so files of failed
or repeated attempts are never seen. An archive without a manifest is read by its files ``*.warc`` and ``*.warc.gz``. A file closes at ``maxFileBytes``.

Any file system pyarrow knows by its URI will do; on a cluster the path must be one that all executors share.

Defined cases: a null payload is an empty one; a null address leaves the header out; line breaks in header values become blanks; a record without
a type is kept with a null type; a cut-off last record fails the read with the file's name; a folder without archives gives no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)

# Names of the header fields, by column.
FIELDS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "payload_length": "Payload-Length",
}
SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, " \
    "refers_to string, payload_length string, payload binary"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH = 4 << 20


def _place(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- writing

def _clean(value) -> str:
    return " ".join(str(value).splitlines())


def record(row: dict) -> bytes:
    """One record: header block, then the content block. A revisit has no payload of its own."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.get('payload_length') or len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if kind == "revisit" else payload)
    lines = ["WARC/1.1"] + [f"{name}: {_clean(row[c])}" for c, name in FIELDS.items() if row.get(c) is not None]
    if kind == "revisit":
        lines.append(f"WARC-Profile: {_REVISIT}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(plain: bytes, level: int) -> bytes:
    """A gzip member; skip lengths only while they fit their four bytes."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush() + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    if max(len(body), len(plain)) < 1 << 32:
        return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, len(body), len(plain)) + body
    return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.level, self.most = int(options.get("level", 1)), int(options.get("maxFileBytes", 256 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.most:
                    if out:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = member(record(row), self.level)
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return _Written(files)

    def commit(self, messages) -> None:
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        old = _manifests(fs, root) if self.overwrite else []
        files = [f for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for name in old:
            fs.delete_file(name)

    def abort(self, messages) -> None:
        fs, root = _place(self.path)
        for f in [f for m in messages if m for f in m.files]:
            fs.delete_file(f"{root}/{f}")


def _manifests(fs, root: str) -> list[str]:
    found = fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
    return [f.path for f in found if f.base_name.startswith("_manifest-")]


# ---------------------------------------------------------------- reading

class _Bytes:
    """Buffered reading with cheap skips over a file of any pyarrow file system."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def more(self, n: int) -> bool:
        got = self.file.read(max(n, 1 << 18))
        self.held += got
        return bool(got)

    def read(self, n: int) -> bytes:
        while len(self.held) < n and self.more(n - len(self.held)):
            pass
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (i := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more(1):
                return self.read(len(self.held))
        return self.read(i + len(mark))

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.file.seek(self.at + n)
            self.held = b""
        self.at += n

    def done(self) -> bool:
        return not self.held and not self.more(1)


def parse_header(block: bytes) -> dict[str, str]:
    """Names in lower case; a line that begins with white space continues the one before."""
    out, last = {}, None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def _payload(header: dict, block: bytes) -> bytes:
    if header.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _plain_records(src: _Bytes, wanted, body: bool, name: str):
    while not src.done():
        header = parse_header(src.until(b"\r\n\r\n"))
        n = int(header.get("content-length", 0))
        if not wanted(header):
            src.skip(n + 4)
        elif body:
            block = src.read(n)
            if len(block) < n:
                raise ValueError(f"cut-off record in {name}")
            src.skip(4)
            yield header, _payload(header, block)
        else:
            src.skip(n + 4)
            yield header, None


def _member_records(src: _Bytes, wanted, body: bool, name: str):
    while not src.done():
        head = src.read(10)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"not a gzip member in {name}")
        skip = None
        if head[3] & 4:
            extra = src.read(struct.unpack("<H", src.read(2))[0])
            while len(extra) >= 4:
                tag, n = struct.unpack("<2sH", extra[:4])
                if tag == b"sl" and n == 8:
                    skip = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n :]
        for flag in (8, 16):
            if head[3] & flag:
                src.until(b"\0")
        if head[3] & 2:
            src.read(2)
        begin, inflate, plain = src.at, zlib.decompressobj(-15), b""

        def feed(n: int) -> bytes:
            data = src.read(n)
            if not data:
                raise ValueError(f"cut-off record in {name}")
            out = inflate.decompress(data)
            if inflate.eof:
                back = len(inflate.unused_data)
                src.held, src.at = inflate.unused_data + src.held, src.at - back
            return out

        while b"\r\n\r\n" not in plain and not inflate.eof:
            plain += feed(1024)
        head_block, _, rest = plain.partition(b"\r\n\r\n")
        header = parse_header(head_block)
        keep = wanted(header)
        if keep and body:
            parts = [rest]
            while not inflate.eof:
                parts.append(feed(1 << 16))
            block = b"".join(parts)[: int(header.get("content-length", 0))]
        elif skip is not None and src.at < begin + skip:
            if begin + skip > src.size:
                raise ValueError(f"cut-off record in {name}")
            src.skip(begin + skip - src.at)
        else:
            while not inflate.eof:
                feed(1 << 16)
        if src.at < begin + (skip or 0) or skip is None:
            src.read(8)  # checksum and length
        if keep:
            yield header, _payload(header, block) if body else None


def _holds(f: Filter, get) -> bool | None:
    """Value of a pushed condition with SQL's three values."""
    if isinstance(f, Not):
        inner = _holds(f.child, get)
        return None if inner is None else not inner
    value = get(f.attribute[0])
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None:
        return None
    tests = {
        EqualTo: lambda: value == f.value, In: lambda: value in f.value, GreaterThan: lambda: value > f.value,
        GreaterThanOrEqual: lambda: value >= f.value, LessThan: lambda: value < f.value, LessThanOrEqual: lambda: value <= f.value,
        StringStartsWith: lambda: value.startswith(f.value), StringEndsWith: lambda: value.endswith(f.value),
        StringContains: lambda: f.value in value,
    }
    return tests[type(f)]()


_PUSHED = (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, IsNull, IsNotNull,
           StringStartsWith, StringEndsWith, StringContains)


def _can_push(f: Filter) -> bool:
    if isinstance(f, Not):
        return _can_push(f.child)
    if isinstance(f, In):
        return f.attribute[0] in FIELDS and None not in f.value
    return isinstance(f, _PUSHED) and len(f.attribute) == 1 and f.attribute[0] in FIELDS


@dataclass
class _Files(InputPartition):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.body = options["path"].rstrip("/"), options.get("payload", "true").lower() != "false"
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if _can_push(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = _place(self.path)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True, allow_not_found=True))
        sizes = {f.path: f.size for f in found if f.base_name.endswith((".warc", ".warc.gz"))}
        manifests = [f.path for f in found if f.base_name.startswith("_manifest-")]
        if manifests:
            listed = set()
            for m in manifests:
                with fs.open_input_stream(m) as src:
                    listed |= {f"{m.rpartition('/')[0]}/{f}" for f in json.loads(src.read())}
            sizes = {f: n for f, n in sizes.items() if f in listed}
        # Up to about 10,000 partitions of 8 to 512 MB.
        most = min(max(sum(sizes.values()) // 10_000, 8 << 20), 512 << 20)
        parts, size = [[]], 0
        for f in sorted(sizes):
            if parts[-1] and size + sizes[f] > most:
                parts.append([])
                size = 0
            parts[-1].append((f, sizes[f]))
            size += sizes[f]
        return [_Files(p) for p in parts]

    def read(self, partition: _Files):
        fs, _ = _place(self.path)
        names = [(c, n.lower()) for c, n in FIELDS.items()]

        def wanted(header: dict) -> bool:
            return all(_holds(f, lambda c: header.get(FIELDS[c].lower())) is True for f in self.filters)

        columns, size = [[] for _ in range(len(names) + 1)], 0
        for name, length in partition.files:
            with fs.open_input_file(name) as file:
                kind = _member_records if name.endswith(".gz") else _plain_records
                for header, payload in kind(_Bytes(file, length), wanted, self.body, name):
                    for out, (_, field) in zip(columns, names):
                        out.append(header.get(field))
                    columns[-1].append(payload)
                    size += len(payload or b"") + 500
                    if size >= _BATCH:
                        yield _batch(columns, names)
                        columns, size = [[] for _ in columns], 0
        if columns[0]:
            yield _batch(columns, names)


def _batch(columns, names) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.string()) for c in columns[:-1]] + [pa.array(columns[-1], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, [c for c, _ in names] + ["payload"])


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark


# ---------------------------------------------------------------- pages

def sha1_base32(payload) -> F.Column:
    """SHA-1 as upper-case base32: 40 hex digits in four groups of 40 bits, each eight signs."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A record per page. Of pages with equal payloads of ``min_bytes`` or more, those with the largest id are
    responses, the others revisits of it; ids that are all null make responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload"))).withColumn("size", F.octet_length("payload"))
    groups = (
        rows.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("head"), F.count("*").alias("c"))
        .where("c > 1 and head is not null").select("digest", "size", "head")
    )
    # A payload that a third of all pages share makes one large key; the join splits it.
    joined = rows.join(groups.hint("merge"), ["digest", "size"], "left")
    again = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(again, F.concat(F.lit("<urn:page:"), F.col("head").cast("string"), F.lit(">"))).alias("refers_to"),
        F.col("size").cast("string").alias("payload_length"), F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    register(pages.sparkSession)
    page_records(pages, min_bytes).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an archive: size and digest of responses from their payload, those of revisits from their header."""
    df = register(spark).read.format("warc").load(path)
    number = F.regexp_extract("record_id", r"^<urn:page:(-?\d+)>$", 1)
    other = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1)
    own = F.col("record_type") == "response"
    return df.select(
        F.when(number != "", number.cast("long")).alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length").cast("long")).alias("payload_bytes"),
        F.when(own, sha1_base32(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.when(other != "", other.cast("long")).alias("refers_to"),
    )
