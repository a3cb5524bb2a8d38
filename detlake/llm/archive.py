"""Web archives: a converter from the legacy ARC format, a WARC writer and a WARC reader.

ARC streams open with a version block, whose second line names the version and
whose third the fields of the header lines that follow: five in version 1, ten
in version 2.  Every record is a header line and as many bytes as it declares.
The converter walks a stream by these lengths alone and synthesises what WARC
asks for: record identifiers (from what the record is), ISO timestamps, types
and SHA-1 digests in base 32.  Blocks are HTTP responses whose body is the
payload (of a revisit, the head alone), and every archive opens with a warcinfo
record.

Archives are written and read by Spark's text source with the record terminator
as line separator, so they live wherever Spark can write, one file a partition;
the reader reassembles records from ``Content-Length`` and holds one at a time.

Payloads: null counts as empty, lone surrogates are kept.  A null url becomes
``urn:page:<id>``.  Among records with equal payloads the least id is the
response; rows that repeat that id and payload are responses too; null ids come
last and are never referred to.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch_path, small

END = b"\r\n\r\n"
#: Fixed values of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Digests that are broadcast, at most, because many pages have them.
MOST_OFTEN = 100_000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    mime: str
    status: str | None
    payload: bytes


def version_block(version: int, name: str = "legacy.arc", date: str = "19990101000000") -> bytes:
    """The first record of an ARC stream."""
    body = f"{version} 0 detlake\n{ARC_FIELDS[version]}\n".encode()
    more = "200 - - 0 " + name + " " if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(body)}\n".encode() + body + b"\n"


def arc_record(record: ArcRecord, version: int) -> bytes:
    """One record of an ARC stream, with its closing line feed."""
    more = f"{record.status or '-'} - - 0 - " if version == 2 else ""
    return f"{record.url} {record.ip} {record.date} {record.mime} {more}{len(record.payload)}\n".encode() + record.payload + b"\n"


def parse_arc(chunks: Iterable[bytes]) -> Iterator[ArcRecord]:
    """Records of ARC streams that follow one another, given as chunks cut anywhere."""
    buf, version, source = bytearray(), None, iter(chunks)

    def more() -> bool:
        for chunk in source:
            buf.extend(chunk)
            return True
        return False

    while True:
        while b"\n" not in buf and more():
            pass
        if not buf.strip(b"\n"):
            if more():
                continue
            return
        if buf[:1] == b"\n":  # between records
            del buf[:1]
            continue
        line, _, rest = bytes(buf).partition(b"\n") if len(buf) < 65536 else (bytes(buf[: buf.index(b"\n")]), b"", b"")
        fields = line.decode("utf-8", "replace").split(" ")
        if not fields[-1].isdigit():
            raise ValueError(f"no length in ARC header {line[:80]!r}")
        start, size = len(line) + 1, int(fields[-1])
        while len(buf) < start + size and more():
            pass
        if len(buf) < start + size:
            raise ValueError(f"ARC record ends after {len(buf) - start} of {size} bytes")
        payload = bytes(buf[start : start + size])
        del buf[: start + size]
        if fields[0].startswith("filedesc:"):
            version = int(payload.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version}")
        elif version is None:
            raise ValueError("an ARC stream must begin with its version block")
        elif len(fields) != len(ARC_FIELDS[version].split(" ")):
            raise ValueError(f"{len(fields)} fields in a header of ARC version {version}")
        else:
            yield ArcRecord(*fields[:4], fields[4] if version == 2 else None, payload)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(arc_date: str) -> str:
    """``19990102030405`` (missing parts: least) as ``1999-01-02T03:04:05Z``."""
    d = arc_date + "00000101000000"[len(arc_date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_head(record: ArcRecord) -> bytes:
    """The head of the HTTP response a record stands for."""
    status = record.status if record.status and record.status.isdigit() else "200"
    return f"HTTP/1.1 {status} {'OK' if status == '200' else ''}\r\nContent-Type: {record.mime}\r\nContent-Length: {len(record.payload)}".encode() + END


def warc_info(part: int) -> bytes:
    """The record that opens an archive, without its terminator."""
    block = b"software: detlake\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('warcinfo', part)}", "WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def warc_record(record: ArcRecord, page_id: int | None, refers_to: int | None) -> bytes:
    """The WARC record of an ARC record, without its terminator."""
    digest = base32_sha1(record.payload)
    block = http_head(record) + (record.payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {iso_date(record.date)}", f"WARC-Target-URI: {record.url}",
        f"WARC-IP-Address: {record.ip}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"X-Payload-Length: {len(record.payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + END + block


def parse_warc(lines: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record, from what stands between terminators."""
    buf, head, need = bytearray(), None, 0
    for line in lines:
        buf.extend(line)
        buf.extend(END)
        while True:
            if head is None:
                while buf[:2] == b"\r\n":  # an archive whose last block ends in line ends has some to spare
                    del buf[:2]
                at = buf.find(END)
                if at < 0:
                    break
                rows = bytes(buf[:at]).decode("utf-8", "replace").split("\r\n")
                if not rows[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record at {rows[0][:60]!r}")
                head = {k.strip().lower(): v.strip() for k, _, v in (r.partition(":") for r in rows[1:])}
                need = int(head["content-length"])
                del buf[: at + len(END)]
            if len(buf) < need + len(END):
                break
            if buf[need : need + len(END)] != END:
                raise ValueError("a WARC record is longer than it declares")
            yield head, bytes(buf[:need])
            del buf[: need + len(END)]
            head = None
    if head is not None or buf.strip(b"\r\n"):
        raise ValueError("a WARC archive ends inside a record")


def payload_digest(payload: Column) -> Column:
    """Base 32 of the SHA-1: every five hexadecimal digits are four of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, arc_versions: tuple[int, ...] = (1, 2)) -> None:
    """Archive (page_id, url, payload) rows: as ARC streams, converted, with revisits for repeated payloads."""
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")))).alias("url"), F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", payload_digest(F.col("payload")))
    slim = cut(rows.where(F.length("payload") >= least_bytes).select("page_id", "digest"), "digests")
    first = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    first = cut(first, "repeated-digests")
    # digests with a hundred-thousandth of the pages or more: so many at most, and no other digest can fill a task
    often = F.col("n") * MOST_OFTEN >= slim.count()
    found = slim.join(F.broadcast(first.where(often).drop("n")), "digest", "left")
    rest = found.where("refers_to IS NULL").drop("refers_to").join(first.where(~often).drop("n"), "digest")
    found = found.where("refers_to IS NOT NULL").unionByName(rest)
    revisits = found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct()
    revisits = small(cut(revisits, "revisits"))
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")

    def run(batches):
        for n, batch in enumerate(batches):
            if n == 0:
                yield pa.RecordBatch.from_arrays([pa.array([warc_info(TaskContext.get().partitionId())], pa.binary())], ["value"])
            ids, urls, refs = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
            version = arc_versions[n % len(arc_versions)]

            def stream(batch=batch, urls=urls, version=version):
                yield version_block(version)
                for url, payload in zip(urls, batch.column("payload"), strict=True):
                    safe = quote(url, safe="!#$%&'()*+,/:;=?@[]~") or "-"
                    yield arc_record(ArcRecord(safe, "0.0.0.0", "20240101000000", "text/html", "200", payload.as_py()), version)

            out, size = [], 0
            for i, record in enumerate(parse_arc(stream())):
                out.append(warc_record(record, ids[i], refs[i]))
                size += len(out[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    made = joined.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "value binary")
    made.select(F.col("value").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


READ = "page_id long, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives under ``path``; a response's digest is checked against its payload."""
    lines = spark.read.option("lineSep", END.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    names = [x.split()[0] for x in READ.split(", ")]
    schema = READ if payloads else READ.rpartition(", ")[0]

    def run(batches):
        def line():
            for batch in batches:
                for x in batch.column("value"):
                    yield x.as_py()

        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        got, size = [], 0
        number = lambda x: None if x is None else int(x)

        def flush():
            cols = list(zip(*got, strict=True)) or [[] for _ in names]
            keep = len(names) - (not payloads)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:keep], types[:keep], strict=True)], names[:keep])

        for head, block in parse_warc(line()):
            if head["warc-type"] == "warcinfo":
                continue
            if head["content-type"].startswith("application/http"):
                block = block.partition(END)[2]
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            if head["warc-type"] == "response" and base32_sha1(block) != digest:
                raise ValueError(f"digest of {head['warc-record-id']} does not fit its payload")
            got.append((number(head.get("x-page-id")), head["warc-target-uri"], head["warc-date"], int(head["x-payload-length"]), digest, head["warc-type"], number(head.get("x-refers-to-page")), block if payloads else None))
            size += len(block) if payloads else 200
            if size > 8_000_000:
                yield flush()
                got, size = [], 0
        if got:
            yield flush()

    return lines.mapInArrow(run, schema)


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder and read their records back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages.select("page_id", "url", F.encode(F.col("html"), "UTF-8").alias("payload")), path, least_bytes)
    return read_warc(spark, path, payloads=False).drop("url", "date")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, i::INT * 5 + 1, 5))::INT >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN m USING (h)
"""
