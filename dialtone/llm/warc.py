"""Legacy archive converter: ARC files of version 1 and 2 to WARC.

An ARC file starts with a version block; its records have a one-line header
whose fields depend on the version and a body of the declared length. The
converter reads header and length, never a separator in the body, and writes
equivalent WARC/1.1 records: identifiers are name-based UUIDs of what the ARC
header says, so a task that runs twice writes the same; dates, types and
digests are synthesised from the header and the payload. Of records with equal
payloads (by SHA-1 and length, from ``revisit_bytes`` on) one stays a response
and the others become revisits that refer to it.

Archives are files of about ``archive_bytes`` of text (more only for one larger
record), written by Spark's text writer with gzip and read whole by Spark's
binary reader, so they can be in any store that Spark reaches. Only digests,
lengths and keys are shuffled before the rewriting, and the compressed archives once.

Defined cases: a null payload is empty; a null url or id is written as ``-``
and read back as null; repeated rows are records of their own; an empty table
gives no archives and an empty result; payloads may hold any bytes, header
lines of either format among them; damaged headers, records and archives are left
out of the conversion, which goes on behind them, and :func:`damaged` lists them.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone.llm.common import pieces, remove, scratch_path, stored

ARC_V1 = "URL IP-address Archive-date Content-type Archive-length"
ARC_V2 = ("URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
          "Filename Archive-length")
_SPACE = {ord(c): f"%{ord(c):02X}" for c in " \t\n\v\f\r%"}


# ---- ARC ------------------------------------------------------------------

def arc_version_block(name: str, date: str, version: int) -> bytes:
    fields = ARC_V1 if version == 1 else ARC_V2
    body = f"{version} 0 dialtone\n{fields}\n\n".encode()
    head = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return f"{' '.join(head)} {len(body)}\n".encode() + body


def arc_record(url: str, date: str, body: bytes, version: int, name: str = "-", offset: int = 0) -> bytes:
    head = [url, "0.0.0.0", date, "text/html"]
    if version == 2:
        head += ["200", hashlib.sha1(body).hexdigest(), "-", str(offset), name]
    return f"{' '.join(head)} {len(body)}\n".encode() + body + b"\n"


#: Where a record header may begin: a line with a scheme, a date and a length.
_HEADER = re.compile(rb"\n(?=[A-Za-z][A-Za-z0-9+.-]*:[^\n]* \d{8,14} [^\n]* \d+\r?\n)")


def read_arc(data: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header fields, body) of every record after the version block.

    A header with more fields than the file declares has spaces in its URL. What
    can't be read is one item with the only field ``damage``, the reason, and the
    bytes up to the next line that looks like a header, from which reading goes on. A
    file without a version block has the fields of version 2 or 1 by their number.
    """
    at, names = 0, None
    while at < len(data):
        if data[at] in b"\r\n":  # the line that separates records
            at += 1
            continue
        end = data.find(b"\n", at)
        values = data[at:end].decode("utf-8", "surrogateescape").rstrip("\r").split(" ") if end >= 0 else []
        start, fault = end + 1, None
        if end < 0:
            fault = "a header without end"
        elif not (values[-1].isascii() and values[-1].isdigit()):
            fault = "a header without length"
        elif start + int(values[-1]) > len(data):
            fault = f"a record of {values[-1]} bytes, of which {len(data) - start} are left"
        else:
            stop = start + int(values[-1])
            if values[0].startswith("filedesc:"):
                declared = (data[start:stop].decode("utf-8", "replace").split("\n") + [""])[1].split()
                names = declared if declared[:1] == ["URL"] and declared[-1:] == ["Archive-length"] else None
                at = stop
                continue
            own = names or (ARC_V2 if len(values) >= 10 else ARC_V1).split(" ")
            more = len(values) - len(own)
            if more >= 0:
                yield at, dict(zip(own, [" ".join(values[:more + 1]), *values[more + 1:]])), data[start:stop]
                at = stop
                continue
            fault = f"a header of {len(values)} fields, {len(own)} are declared"
        found = _HEADER.search(data, at)
        to = found.end() if found else len(data)
        yield at, {"damage": fault}, data[at:to]
        at = to


def inflate(content: bytes) -> tuple[bytes, str | None]:
    """(what the members of a gzip file hold, what is wrong with it)."""
    out, rest = [], content
    while rest:
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(rest))
            out.append(member.flush())
        except zlib.error as e:
            return b"".join(out), f"the compression is damaged: {e}"
        if not member.eof:
            return b"".join(out), "the compressed file is cut short"
        rest = member.unused_data
    return b"".join(out), None


def _records(content: bytes) -> Iterator[tuple[int, dict, bytes]]:
    data, fault = inflate(content)
    yield from read_arc(data)
    if fault:
        yield len(data), {"damage": fault}, b""


def damaged(spark: SparkSession, arc_paths: list[str]) -> DataFrame:
    """(path, at, n_bytes, damage): what :func:`convert` can't read of the ARC archives under ``arc_paths``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(path, at, len(body), f["damage"]) for at, f, body in _records(content.as_py()) if "damage" in f]
                columns = list(zip(*rows)) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
                    columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["path", "at", "n_bytes", "damage"])

    return read_archives(spark, *arc_paths).mapInArrow(run, "path string, at bigint, n_bytes bigint, damage string")


def write_arc(pages: DataFrame, path: str, version: int = 1, archive_bytes: int = 4 << 20,
              date: str = "20240101000000", id_col: str = "page_id", url_col: str = "url",
              body_col: str = "html") -> None:
    """Write rows as ARC archives under ``path``; the id travels as an HTTP header."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{uuid.uuid4().hex}.arc"
        parts, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "body"):
                for key, url, html in zip(*(c.to_pylist() for c in piece.columns)):
                    if not parts:
                        parts = [arc_version_block(name, date, version)]
                        size = len(parts[0])
                    body = (html or "").encode()
                    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            f"X-Record-Key: {'-' if key is None else key}\r\n"
                            f"Content-Length: {len(body)}\r\n\r\n").encode()
                    where = "-" if url is None else (url.translate(_SPACE) or "%00")
                    parts.append(arc_record(where, date, head + body, version, name, size))
                    size += len(parts[-1])
                    if size >= archive_bytes:
                        yield _one(b"".join(parts))
                        parts, size = [], 0
        if parts:
            yield _one(b"".join(parts))

    rows = pages.select(F.col(id_col).cast("string").alias("key"), F.col(url_col).alias("url"),
                        F.col(body_col).alias("body"))
    _write_archives(rows.mapInArrow(archives, "archive binary"), path)


def _one(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], type=pa.binary())], names=["archive"])


def _write_archives(archives: DataFrame, path: str) -> None:
    """One gzip file for each row; the text writer ends it with a line feed, which readers skip."""
    (archives.select(F.col("archive").cast("string").alias("value")).write
     .option("compression", "gzip").option("maxRecordsPerFile", 1).text(path))


def read_archives(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, content) of the archives under ``paths``, content as it is stored."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(list(paths))
            .select("path", "content"))


# ---- HTTP -----------------------------------------------------------------

def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(status line and headers, payload) of an HTTP response."""
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if end >= 0 else (b"", block)


def http_header(head: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


# ---- WARC -----------------------------------------------------------------

def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def warc_date(arc_date: str) -> str:
    """An ARC date of 8, 12 or 14 digits as WARC writes it."""
    d = (arc_date + "00000000000000")[:14] if arc_date.isdigit() and len(arc_date) >= 8 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(named fields, block) of every record."""
    at = 0
    while True:
        while at < len(data) and data[at] in b"\r\n":
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(fields["Content-Length"])
        if stop > len(data):
            raise ValueError(f"WARC record at byte {at} is cut short")
        yield fields, data[end + 4:stop]
        at = stop


def convert(spark: SparkSession, arc_paths: list[str], warc_path: str, revisit_bytes: int = 1000) -> None:
    """Rewrite the ARC archives under ``arc_paths`` as WARC archives under ``warc_path``.

    Of equal payloads the record with the largest key is the response (numeric
    keys compare as numbers), ties go to the largest record id.
    """
    facts = stored(read_archives(spark, *arc_paths).mapInArrow(
        _arc_facts, "path string, at bigint, key string, record string, date string, url string, "
                    "sha1 binary, size bigint"), "arc-facts")
    large = facts.where(F.col("size") >= revisit_bytes)
    rank = F.struct(F.expr("try_cast(key as decimal(38, 0))").alias("number"), F.col("key"), F.col("record"))
    best = (large.groupBy("sha1", "size")
            .agg(F.max(rank).alias("best"), F.max_by(F.struct("record", "date", "url"), rank).alias("to"),
                 F.count("*").alias("n")).where("n > 1").select("sha1", "size", "to"))
    revisits = (large.join(best, ["sha1", "size"]).where("record <> to.record")
                .groupBy("path").agg(F.collect_list(F.struct("at", "to")).alias("revisits")))
    both = read_archives(spark, *arc_paths).join(revisits, "path", "left")
    done = both.select("path", "content", "revisits").mapInArrow(_rewrite, "archive binary")
    _write_archives(done, warc_path)
    remove(facts)


def _identity(path: str, at: int, fields: dict) -> str:
    return record_id(path.rsplit("/", 1)[-1], str(at), fields["URL"], fields.get("Archive-date", "-"))


def _arc_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "at", "key", "record", "date", "url", "sha1", "size"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for at, fields, body in _records(content.as_py()):
                if "damage" in fields:
                    continue
                head, payload = split_http(body)
                rows.append((path, at, http_header(head, b"X-Record-Key") or "-", _identity(path, at, fields),
                             warc_date(fields.get("Archive-date", "-")), fields["URL"],
                             hashlib.sha1(payload).digest(), len(payload)))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content, found in zip(batch.column(0).to_pylist(), batch.column(1),
                                        batch.column(2).to_pylist()):
            refers = {x["at"]: x["to"] for x in found or ()}
            name = path.rsplit("/", 1)[-1]
            info = f"software: dialtone\r\nformat: WARC File Format 1.1\r\nconverted-from: {name}\r\n".encode()
            parts = [warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, "warcinfo")),
                                  ("WARC-Date", "1970-01-01T00:00:00Z"),
                                  ("Content-Type", "application/warc-fields")], info)]
            for at, fields, body in _records(content.as_py()):
                if "damage" in fields:
                    continue
                head, payload = split_http(body)
                to = refers.get(at)
                block = head if to else body
                digest = hashlib.sha1(payload).hexdigest()
                own = [("WARC-Type", "revisit" if to else "response"),
                       ("WARC-Record-ID", _identity(path, at, fields)),
                       ("WARC-Date", warc_date(fields.get("Archive-date", "-"))), ("WARC-Target-URI", fields["URL"]),
                       ("WARC-IP-Address", fields.get("IP-address", "0.0.0.0")),
                       ("WARC-Payload-Digest", f"sha1:{digest}"),
                       ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
                       ("Content-Type", "application/http; msgtype=response")]
                if to:
                    own += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("WARC-Refers-To", to["record"]), ("WARC-Refers-To-Date", to["date"]),
                            ("WARC-Refers-To-Target-URI", to["url"])]
                parts.append(warc_record(own, block))
            yield _one(b"".join(parts))


def read_warc_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit under ``path``: (record_id, type, key, url, date, payload_bytes,
    payload_digest, refers_to_record, intact).

    ``payload_bytes`` of a revisit is the length that its HTTP header declares;
    ``intact``: block and payload have the digests that the record names.
    """
    return read_archives(spark, path).mapInArrow(
        _warc_facts, "record_id string, type string, key string, url string, date string, "
                     "payload_bytes bigint, payload_digest string, refers_to_record string, intact boolean")


def _warc_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "type", "key", "url", "date", "payload_bytes", "payload_digest",
             "refers_to_record", "intact"]
    types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.string(), pa.bool_()]
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for fields, block in read_warc(gzip.decompress(content.as_py())):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                digest = hashlib.sha1(payload).hexdigest() if kind == "response" else named
                size = len(payload) if kind == "response" else int(http_header(head, b"Content-Length"))
                key, url = http_header(head, b"X-Record-Key"), fields["WARC-Target-URI"]
                intact = digest == named and (
                    fields["WARC-Block-Digest"] == f"sha1:{hashlib.sha1(block).hexdigest()}")
                rows.append((fields["WARC-Record-ID"], kind, None if key == "-" else key,
                             None if url == "-" else _plain(url), fields["WARC-Date"], size, digest,
                             fields.get("WARC-Refers-To"), intact))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


def _plain(url: str) -> str:
    """Undo what :func:`write_arc` does to a url, which can't hold white space in an ARC header."""
    if url == "%00":
        return ""
    for c, code in sorted(_SPACE.items()):
        if c != ord("%"):
            url = url.replace(code, chr(c))
    return url.replace("%25", "%")


def through_archives(pages: DataFrame, id_col: str = "page_id", revisit_bytes: int = 1000) -> DataFrame:
    """Write ARC archives of both versions in the shared folder, convert them, read the WARC archives back."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    half = F.coalesce(F.pmod(F.xxhash64(id_col), F.lit(2)), F.lit(0))
    for version in (1, 2):
        write_arc(pages.where(half == version - 1), f"{arc}/v{version}", version, id_col=id_col)
    convert(spark, [f"{arc}/v1", f"{arc}/v2"], warc, revisit_bytes)
    return read_warc_archives(spark, warc)
