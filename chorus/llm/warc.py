"""WARC archives as a Spark data source: planned by file, headers first, unwanted payloads never decoded.

``spark.read.format("chorus_warc")`` plans one partition per group of archive
files, evaluates predicates on record type and headers before it looks at a
block, and skips the block of a record that is not wanted (by a seek in plain
archives, by discarding in compressed ones). Writing is atomic: the files of
failed or repeated tasks are not named in the manifest, and only named files
are read.
"""

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from chorus.operators.scale import lookup, pin, work_dir

FORMAT = "chorus_warc"
MANIFEST = "_manifest.json"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 128 << 20
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20

SCHEMA = (
    "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_length bigint, headers map<string,string>, payload binary"
)
# Names of the WARC 1.1 standard.
HEADER_OF = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
VERSION = b"WARC/1.1"
GAP = b"\r\n\r\n"

_ARROW = pa.schema([
    *[(name, pa.string()) for name in HEADER_OF],
    ("payload_length", pa.int64()),
    ("headers", pa.map_(pa.string(), pa.string())),
    ("payload", pa.binary()),
])


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# ---- records to bytes ---------------------------------------------------------


def _clean(value: object) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in str(value))


def record_bytes(row: dict, date: str) -> bytes:
    """One record: WARC headers, then an HTTP head and, but for revisits, the payload."""
    payload = row.get("payload") or b""
    length = row.get("payload_length")
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload) if length is None else length}\r\n\r\n"
    ).encode()
    block = head + (b"" if row.get("warc_type") == "revisit" else payload)
    lines = [VERSION.decode()]
    for name, header in HEADER_OF.items():
        if row.get(name) is not None:
            lines.append(f"{header}: {_clean(row[name])}")
    lines += [
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + GAP + block + GAP


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str, packed: bool, file_bytes: int):
        self.path, self.date, self.packed, self.file_bytes = path, date, packed, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        files, out, size = [], None, 0

        def close() -> None:
            out.close()
            files.append((name, size))

        for batch in iterator:
            for row in batch.to_pylist():
                data = record_bytes(row, self.date)
                if self.packed:
                    press = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = press.compress(data) + press.flush()
                if out is not None and size + len(data) > self.file_bytes:
                    close()
                    out = None
                if out is None:
                    name, size = f"{uuid4().hex}.warc{'.gz' if self.packed else ''}", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                size += len(data)
        if out is not None:
            close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, base = _store(self.path)
        for name, _ in [f for m in messages if m is not None for f in m.files]:
            store.delete_file(f"{base}/{name}")


# ---- bytes to records ---------------------------------------------------------


class _Bytes:
    """A forward reader over plain bytes; skipping past the buffer is a seek."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.held, self.at = source, b"", 0

    def _more(self) -> bool:
        piece = self._read()
        self.held, self.at = self.held[self.at:] + piece, 0
        return bool(piece)

    def _read(self) -> bytes:
        return self.source.read(CHUNK)

    def upto(self, mark: bytes) -> bytes | None:
        """Bytes before the next ``mark``, which is passed over; None at the end of the file."""
        start = 0
        while (found := self.held.find(mark, self.at + start)) < 0:
            start = max(0, len(self.held) - self.at - len(mark) + 1)
            if not self._more():
                if self.held[self.at:].strip():
                    raise ValueError("an archive ends inside a record's headers")
                return None
        out = self.held[self.at:found]
        self.at = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        pieces, missing = [], n
        while missing > (here := len(self.held) - self.at):
            pieces.append(self.held[self.at:])
            missing -= here
            self.at = len(self.held)
            if not self._more():
                raise ValueError("an archive ends inside a record's block")
        pieces.append(self.held[self.at:self.at + missing])
        self.at += missing
        return b"".join(pieces)

    def skip(self, n: int) -> None:
        here = len(self.held) - self.at
        if n <= here:
            self.at += n
        else:
            self.held, self.at = b"", 0
            self._jump(n - here)

    def _jump(self, n: int) -> None:
        self.source.seek(self.source.tell() + n)


class _Unpacked(_Bytes):
    """The same over gzip members, one after another."""

    def __init__(self, source: pa.NativeFile):
        super().__init__(source)
        self.press, self.raw = zlib.decompressobj(31), b""

    def _read(self) -> bytes:
        while True:
            if self.press.eof:
                self.press = zlib.decompressobj(31)
            self.raw = self.raw or self.source.read(CHUNK)
            if not self.raw:
                return self.press.flush()
            out = self.press.decompress(self.raw, CHUNK)
            self.raw = self.press.unconsumed_tail or self.press.unused_data
            if out:
                return out

    def _jump(self, n: int) -> None:
        while n:
            piece = self._read()
            if not piece:
                raise ValueError("an archive ends inside a record's block")
            if len(piece) > n:
                self.held = piece[n:]
            n -= min(n, len(piece))


def _headers(raw: bytes) -> dict[str, str]:
    first, *lines = raw.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _header(headers: dict[str, str], column: str) -> str | None:
    return headers.get(HEADER_OF[column])


Test = Callable[[dict[str, str]], bool]


def pushed_test(wanted: Filter) -> Test | None:
    """The predicate as a test on headers alone, or None if headers cannot decide it."""
    path = getattr(wanted, "attribute", None)
    if not path or len(path) != 1 or path[0] not in HEADER_OF:
        return None
    column, value = path[0], getattr(wanted, "value", None)
    if isinstance(wanted, IsNull):
        return lambda h: _header(h, column) is None
    if isinstance(wanted, IsNotNull):
        return lambda h: _header(h, column) is not None
    if isinstance(wanted, EqualNullSafe):
        return lambda h: _header(h, column) == value
    if isinstance(wanted, In):
        return lambda h: (x := _header(h, column)) is not None and x in value
    compare = {
        EqualTo: str.__eq__, GreaterThan: str.__gt__, GreaterThanOrEqual: str.__ge__,
        LessThan: str.__lt__, LessThanOrEqual: str.__le__, StringStartsWith: str.startswith,
    }.get(type(wanted))
    if compare is None or not isinstance(value, str):
        return None
    if type(wanted) not in (EqualTo, StringStartsWith) and not value.isascii():
        return None  # Spark orders by bytes
    return lambda h: (x := _header(h, column)) is not None and bool(compare(x, value))


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads, self.wanted = path, payloads, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if pushed_test(f) is None:
                yield f
            else:
                self.wanted.append(f)

    def partitions(self) -> list[Files]:
        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{base}/{MANIFEST}") as f:
                files = json.loads(f.read())
        else:
            found = store.get_file_info(pafs.FileSelector(base, recursive=False))
            files = [(f.base_name, f.size) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        plan, held = [], PARTITION_BYTES
        for name, size in sorted(files):
            if held + size > PARTITION_BYTES:
                plan.append(Files([]))
                held = 0
            plan[-1].names.append(name)
            held += size
        return plan or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        tests = [pushed_test(f) for f in self.wanted]
        store, base = _store(self.path)
        rows, held = [], 0
        for name in partition.names:
            with store.open_input_file(f"{base}/{name}") as source:
                for row in self._records(_Unpacked(source) if name.endswith(".gz") else _Bytes(source), tests):
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def _records(self, data: _Bytes, tests: list[Test]) -> Iterator[dict]:
        while (raw := data.upto(GAP)) is not None:
            headers = _headers(raw)
            size = int(headers["Content-Length"])
            if not all(t(headers) for t in tests):
                data.skip(size + len(GAP))
                continue
            row = {name: _header(headers, name) for name in HEADER_OF}
            row |= {"headers": list(headers.items()), "payload": None, "payload_length": None}
            if headers.get("Content-Type", "").startswith("application/http"):
                head = data.upto(GAP)
                size -= len(head) + len(GAP)
                said = [x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                row["payload_length"] = int(said[0].split(b":")[1]) if said else size
            else:
                row["payload_length"] = size
            if self.payloads and row["warc_type"] != "revisit":
                row["payload"] = data.take(size)
            else:
                data.skip(size)
            data.skip(len(GAP))
            yield row


class WarcSource(DataSource):
    """Options: ``path``; reading: ``payloads`` (true); writing: ``date``, ``compression`` (none or gzip)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(
            self.options["path"],
            self.options.get("date", "1970-01-01T00:00:00Z"),
            self.options.get("compression", "none") == "gzip",
            int(self.options.get("filebytes", FILE_BYTES)),
        )


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write rows with any of the columns of :data:`SCHEMA` but ``headers`` to a new folder."""
    register(records.sparkSession)
    records.write.format(FORMAT).mode("append").option("compression", compression).save(path)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("payloads", str(payloads).lower()).load(path)


# ---- pages --------------------------------------------------------------------


def page_records(pages: DataFrame) -> DataFrame:
    """A record per page; equal payloads are stored once and referred to.

    ``pages`` needs ``page_id, url, html``; other columns are ignored, null html
    is an empty payload. Among pages with equal payloads of at least 100 bytes
    the smallest id responds and the others revisit it; rows repeating that id
    respond too. A page without id always responds. Payloads move only if the
    table of revisits is measured too large to broadcast.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    sized = pages.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key"), "page_id", "url",
        body.alias("payload"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("bigint").alias("size"),
    )
    narrow = pin(sized.filter(F.col("size") >= MIN_REVISIT_BYTES).select("key", "page_id", "digest"), "payloads")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
    first = pin(first.filter("pages > 1 AND first IS NOT NULL"), "first-payloads")
    revisits = lookup(narrow, first, ["digest"], load="pages").filter("page_id != first")
    revisits = pin(revisits.select("key", "digest", "first").distinct(), "revisits")
    joined = lookup(sized, revisits, ["key", "digest"], how="left")
    again = F.col("first").isNotNull()
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        F.concat(F.lit("<urn:page:"), F.col("key"), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.col("size").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_of(urn: str) -> Column:
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("bigint")


def pages_through_warc(pages: DataFrame, compression: str = "none") -> DataFrame:
    """Write pages as archives under the work folder and describe what reading them gives."""
    spark = pages.sparkSession
    path = f"{work_dir(spark)}/warc-{uuid4().hex}"
    write_warc(page_records(pages), path, compression)
    read = read_warc(spark, path)
    stored = F.col("payload").isNotNull()
    return read.select(
        page_of("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("bigint").alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        page_of("refers_to").alias("refers_to"),
    )
