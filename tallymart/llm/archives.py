"""Web archives: the legacy ARC format, its conversion to WARC, and reading both.

ARC records are a header line, the declared number of bytes and a line end. Version 1 lines have five
fields (URL, IP address, 14-digit date, content type, length), version 2 lines ten (result code,
checksum, location, offset and file name between type and length); which of them a file has stands in the block of its first
record, `filedesc://`. The converter parses each line by that version, takes exactly the declared
bytes, and synthesises for each record what WARC asks for: an identifier (from file, place and address, so
that a rerun gives the same and no two records share one), the date in ISO form, the type and the digests of block and payload. The version
block becomes a `warcinfo` record that the file's other records name; the IP address, the content type and what a version 2 line
says besides are kept. A block that begins with an HTTP status line is a `response`, any other a `resource` of the line's type. Of
records with equal payloads one is kept so and the others become `revisit` records of it, without payload.

Files are parsed twice: for a row of digests for each record, from which the decisions follow, and for the conversion. Decisions go
back to files by name and place of the record; no block is shuffled for them as long as they are few enough for a broadcast.

Defined cases: a null page is an empty payload; a null or unprintable URL is percent-encoded, null as `urn:null`.
Equal payloads are those with equal SHA-1 and length; the largest page identifier is the response; rows
repeated with that identifier are all responses. A null identifier is smaller than any other. Records of archives without page
identifiers are told apart by file and place, the last is kept. A header line may have blanks in URL and type; one that does not
fit its version raises ValueError, as where the next record begins is then unknown. An empty
table gives empty archives and results. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.llm.common import by_run, new_path, written

#: Fixed values of the two formats: fields of a version's header lines, and what a field may hold.
FIELDS = {1: ["url", "ip", "date", "mime", "length"], 2: ["url", "ip", "date", "mime", "status", "checksum", "location", "offset", "file", "length"]}
FORMS = {"url": r".*", "ip": r"\S+", "date": r"\d{14}", "mime": r".*", "status": r"\d+|-", "checksum": r"\S+", "location": r"\S+", "offset": r"\d+", "file": r"\S+", "length": r"\d+"}
LINES = {v: re.compile(" ".join(f"(?P<{n}>{FORMS[n]})" for n in names)) for v, names in FIELDS.items()}
HEAD = {1: b"1 0 tallymart\nURL IP-address Archive-date Content-type Archive-length\n", 2: b"2 0 tallymart\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"}
#: Fields of a version 2 line that WARC has no field for, and their names in the record's header.
KEPT = {"status": "ARC-Result-Code", "checksum": "ARC-Checksum", "location": "ARC-Location"}
EPOCH = datetime(2001, 1, 1, tzinfo=timezone.utc)
#: Files with decisions (some numbers and a URL for each revisit) that may be broadcast, by their revisits; beyond it the join shuffles.
BROADCAST_REVISITS = 100_000


@dataclass
class Record:
    url: str
    date: str
    mime: str
    block: bytes
    ip: str = "0.0.0.0"
    more: dict[str, str] = field(default_factory=dict)


def sha1(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_bytes(version: int, name: str, records: Iterator[tuple[str, str, str, bytes]]) -> bytes:
    """An ARC file of (url, 14-digit date, mime, block)."""
    out = bytearray()

    def add(url: str, date: str, mime: str, block: bytes) -> None:
        more = f" 200 - - {len(out)} {name}" if version == 2 else ""
        out.extend(f"{url} 0.0.0.0 {date} {mime}{more} {len(block)}\n".encode() + block + b"\n")

    add(f"filedesc://{name}", EPOCH.strftime("%Y%m%d%H%M%S"), "text/plain", HEAD[version])
    for r in records:
        add(*r)
    return bytes(out)


def arc_blocks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header line and block of each record. A length beyond the data raises ValueError."""
    at = 0
    while at < len(data):
        stop = data.find(b"\n", at)
        line = data[at:stop] if stop >= 0 else data[at:]
        digits = line.rpartition(b" ")[2]
        if stop < 0 or not digits.isdigit():
            raise ValueError(f"not a header line at byte {at}")
        block = data[stop + 1 : stop + 1 + int(digits)]
        if len(block) != int(digits):
            raise ValueError(f"the record at byte {at} declares {int(digits)} bytes and has {len(block)}")
        yield line, block
        at = stop + 1 + len(block)
        while data[at : at + 1] == b"\n":
            at += 1


def read_arc_bytes(data: bytes) -> Iterator[Record]:
    """Records of an ARC file; the first is the version block, whose first number says how the others' lines are made up."""
    version = 0
    for line, block in arc_blocks(data):
        if not version:
            version = int(block.split(b" ", 1)[0] or 0)
            if version not in LINES:
                raise ValueError(f"no such version: {block[:20]!r}")
        found = LINES[version].fullmatch(line.decode("utf-8", "surrogateescape"))
        if not found:
            raise ValueError(f"not a version {version} header line: {line[:200]!r}")
        x = found.groupdict()
        yield Record(x["url"], x["date"], x["mime"], block, x["ip"], {name: x[k] for k, name in KEPT.items() if x.get(k, "-") != "-"})


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload of a block; a block without a status line is all payload."""
    head, gap, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", b"")
    return (head + gap, payload) if gap else (b"", block)


def header(head: bytes, name: str) -> str | None:
    key = name.lower().encode() + b":"
    return next((line.split(b":", 1)[1].strip().decode() for line in head.split(b"\r\n") if line.lower().startswith(key)), None)


def iso(date: str) -> str:
    return datetime.strptime(date, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(file: str, place: int, r: Record) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file} {place} {r.date} {r.url}'.encode('utf-8', 'surrogateescape').decode('latin-1'))}>"


def warc_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Header and block without the two line ends that close a record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def info_record(file: str, r: Record) -> bytes:
    """The version block of an ARC file as the warcinfo of what comes from that file."""
    version = r.block.split(b"\n", 1)[0].decode("utf-8", "replace").strip()
    text = f"software: tallymart\r\nformat: WARC File Format 1.1\r\ndescription: converted from the ARC file {file}\r\narc-version-block: {version}\r\n"
    return warc_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(file, 0, r)), ("WARC-Date", iso(r.date)), ("WARC-Filename", file), ("Content-Type", "application/warc-fields")], text.encode())


def warc_record(file: str, place: int, r: Record, info: str, first: tuple[str, str, str] | None = None) -> bytes:
    """A record of an ARC file as WARC. first: URL, date and record identifier of the record with the same payload that this one revisits."""
    head, payload = payload_of(r.block)
    kind = "revisit" if first else "response" if head else "resource"
    out = [("WARC-Type", kind), ("WARC-Record-ID", record_id(file, place, r)), ("WARC-Warcinfo-ID", info), ("WARC-Date", iso(r.date)), ("WARC-Target-URI", r.url)]
    if r.ip != "0.0.0.0":
        out.append(("WARC-IP-Address", r.ip))
    if first:
        out.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        out += [("WARC-Refers-To", first[2]), ("WARC-Refers-To-Target-URI", first[0]), ("WARC-Refers-To-Date", iso(first[1]))]
    out += [("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Identified-Payload-Type", r.mime), *r.more.items()]
    out.append(("Content-Type", "application/http; msgtype=response" if head else r.mime))
    return warc_bytes(out, head if first else r.block)


def read_warc_bytes(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        size = int(head["content-length"])
        yield head, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} is longer than it declares")
        at += 4


def page_block(page_id: int | None, html: bytes) -> bytes:
    key = "" if page_id is None else str(page_id)
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\nX-Page: {key}\r\n\r\n".encode() + html


def pages_to_arc(pages: DataFrame, records: int = 500) -> DataFrame:
    """name, content: ARC files of at most `records` pages, versions 1 and 2 by turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for i in range(0, batch.num_rows, records):
                rows = zip(*(c.to_pylist() for c in batch.slice(i, records).columns), strict=True)
                name = f"part-{task}-{k}.arc"
                made = ((quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else "urn:null", (EPOCH + timedelta(seconds=(page or 0) % 10**8)).strftime("%Y%m%d%H%M%S"), "text/html", page_block(page, html or b"")) for page, url, html in rows)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_bytes(1 + k % 2, name, made)], pa.binary())], names=["name", "content"])
                k += 1

    light = pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("binary").alias("html"))
    return light.mapInArrow(run, "name string, content binary")


def batch_of(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values(), strict=True)], names=list(types))


INDEX = {"name": pa.string(), "place": pa.int32(), "page_id": pa.int64(), "tie": pa.string(), "digest": pa.string(), "payload_bytes": pa.int64(), "url": pa.string(), "date": pa.string(), "id": pa.string()}


def arc_index(files: DataFrame) -> DataFrame:
    """A row without payload for each record of ARC files (name, content). tie tells records without a page identifier apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for place, r in enumerate(read_arc_bytes(gunzipped(content.as_py()))):
                    if place:
                        head, payload = payload_of(r.block)
                        page = header(head, "X-Page")
                        rows.append((name, place, int(page) if page else None, f"{name} {place:09d}" if page is None else "", sha1(payload), len(payload), r.url.encode("utf-8", "surrogateescape").decode("utf-8", "replace"), r.date, record_id(name, place, r)))
                yield batch_of(rows, INDEX)

    return files.select("name", "content").mapInArrow(run, "name string, place int, page_id long, tie string, digest string, payload_bytes long, url string, date string, id string")


def gunzipped(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def arc_to_warc(files: DataFrame, least_bytes: int = 0) -> DataFrame:
    """files: name (unique), content. record (string of bytes): for each file a warcinfo and its records, those that repeat a payload as revisits.

    Which they are follows from an aggregation of digests, combined before the shuffle. It goes back by run, so a payload with very
    many copies is spread, and then as one list for each file.
    """
    index = written(arc_index(files).filter(F.col("payload_bytes") >= least_bytes).withColumn("run", F.spark_partition_id()), "arc-index")
    payload, own = ["digest", "payload_bytes"], F.struct("page_id", "tie")
    firsts = index.groupBy(*payload).agg(F.max(F.struct("page_id", "tie", "url", "date", "id")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = by_run(index.select("run", "name", "place", "page_id", "tie", *payload), payload, firsts).filter(own != F.struct("first.page_id", "first.tie"))
    by_file = written(again.groupBy("name").agg(F.collect_list(F.struct("place", "first.url", "first.date", "first.id")).alias("again")), "arc-revisits")
    revisits = by_file.agg(F.coalesce(F.sum(F.size("again")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                firsts, info, out, size = {x["place"]: (x["url"], x["date"], x["id"]) for x in found or ()}, "", [], 0
                for place, r in enumerate(read_arc_bytes(gunzipped(content.as_py()))):
                    info = info or record_id(name, 0, r)
                    out.append(warc_record(name, place, r, info, firsts.get(place)) if place else info_record(name, r))
                    size += len(out[-1])
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                        out, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    side = F.broadcast(by_file) if revisits <= BROADCAST_REVISITS else by_file
    return files.select("name", "content").join(side, "name", "left").mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("record"))


def write_warc(records: DataFrame, path: str, per_file: int = 1000) -> None:
    """Gzipped WARC files of at most per_file records. The text writer puts the two line ends after each record."""
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


READ = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "id": pa.string(), "refers": pa.string()}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, id and refers (identifier of the record that a revisit stands for).

    Every record but warcinfo; blocks and the payloads of responses are checked against their digests. A revisit has no payload, its
    payload_bytes are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in read_warc_bytes(gunzipped(content.as_py())):
                    if head["warc-block-digest"] != f"sha1:{sha1(block)}":
                        raise ValueError(f"{head['warc-record-id']} does not have the block it declares")
                    if head["warc-type"] == "warcinfo":
                        continue
                    http, payload = payload_of(block)
                    digest, page, full = head["warc-payload-digest"].removeprefix("sha1:"), header(http, "X-Page"), head["warc-type"] != "revisit"
                    if full and sha1(payload) != digest:
                        raise ValueError(f"{head['warc-record-id']} does not have the payload it declares")
                    rows.append((int(page) if page else None, len(payload) if full else None, digest, head["warc-type"], head["warc-record-id"], head.get("warc-refers-to")))
                yield batch_of(rows, READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, id string, refers string")


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: revisits with the page and the payload length of what they refer to."""
    records = written(records.withColumn("run", F.spark_partition_id()), "warc-index")
    whole = records.filter("refers IS NULL")
    targets = whole.select(F.col("id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"))
    again = by_run(records.filter("refers IS NOT NULL"), ["refers"], targets, "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(again.withColumn("payload_bytes", F.col("full_bytes")).select(*columns))


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages through ARC and WARC archives and back: what the WARC archives say of each page."""
    spark, path = pages.sparkSession, new_path(pages.sparkSession, "warc")
    write_warc(arc_to_warc(written(pages_to_arc(pages), "arc-files"), least_bytes), path)
    return resolved(read_warc(spark, path))
