"""Legacy ARC archives to WARC, and both formats' readers.

ARC (versions 1 and 2) has one header line a record, of 5 or 10 fields as its version block says, and a declared
length; nothing else.  The converter parses that, and synthesises what WARC wants beyond it: record identifiers (from
the record's own place and address, so reruns agree), timestamps, types and digests.  Records are gzip members of
their own, so a record is read alone by its offset.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_binary, partitions, shared_dir, stored, write_whole

# Fixed values of the public formats
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def member(data: bytes, level: int = 1) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(file, at: int = 0, most: int | None = None, chunk: int = 1 << 18):
    """(offset, bytes) of each gzip member from `at` on, at most `most` of them; one member is held at a time."""
    file.seek(at)
    held, n = b"", 0
    while most is None or n < most:
        if not held and not (held := file.read(chunk)):
            return
        d, out, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            if not held and not (held := file.read(chunk)):
                raise ValueError("the archive ends inside a record")
            out.append(d.decompress(held))
            used += len(held) - len(d.unused_data)
            held = d.unused_data if d.eof else b""
        yield at, b"".join(out)
        at += used
        n += 1


def arc_members(file, at: int = 0, most: int | None = None):
    """(offset, bytes) of the records of an ARC file, of gzip members or, by their declared lengths, of plain text."""
    file.seek(0)
    if file.read(2) == b"\x1f\x8b":
        yield from members(file, at, most)
        return
    file.seek(at)
    n = 0
    while most is None or n < most:
        at, line = file.tell(), file.readline()
        if not line:
            return
        if not line.strip():  # between records
            continue
        length = int(line.split(b" ")[-1])
        block = file.read(length)
        if len(block) < length:
            raise ValueError(f"declared {length} bytes, found {len(block)}")
        yield at, line + block
        n += 1


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 sluice\n{FIELDS[version]}\n\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain " + ("200 - - 0 " + name + " " if version == 2 else "") + f"{len(body)}\n"
    return head.encode() + body


def arc_record(version: int, name: str, offset: int, url: str | None, date: str, kind: str, block: bytes, ip: str = "0.0.0.0") -> bytes:
    address = quote(url or "-", safe="!#$%&'()*+,/:;=?@[]~_.-")
    more = f"200 - - {offset} {name} " if version == 2 else ""
    return f"{address} {ip} {date} {kind} {more}{len(block)}\n".encode() + block + b"\n"


def parse_arc(record: bytes, version: int | None) -> tuple[dict, bytes, int]:
    """(header fields, block, version) of an ARC record; a version block tells its own version."""
    line, _, rest = record.lstrip(b"\n").partition(b"\n")
    parts = line.decode("utf-8", "replace").split(" ")
    if line.startswith(b"filedesc://"):
        version = int(rest.split(b" ", 1)[0])
    if version not in FIELDS:
        raise ValueError(f"ARC version {version}")
    names = FIELDS[version].split(" ")
    # an address with blanks shifts the later fields, which are counted from the end
    tail = parts[len(parts) - len(names) + 1 :]
    fields = dict(zip(names, [" ".join(parts[: len(parts) - len(tail)]), *tail]))
    length = int(fields["Archive-length"])
    if len(rest) < length:
        raise ValueError(f"declared {length} bytes, found {len(rest)}")
    return fields, rest[:length], version


def warc_date(date: str) -> str:
    """ISO form of a 14-digit ARC date; shorter ones (12 or 8 digits) are filled with zeros."""
    d = re.sub(r"\D", "", date).ljust(14, "0")[:14]
    month, day = max(1, min(12, int(d[4:6]))), max(1, min(31, int(d[6:8])))
    return f"{d[:4]}-{month:02d}-{day:02d}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and the payload; a block that is no HTTP response is payload alone."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, mark, body = block.partition(b"\r\n\r\n")
    return head + mark, body


def warc_record(kind: str, rid: str, date: str, url: str, block: bytes, media: str, payload_digest: str | None = None, refers: tuple | None = None, more: tuple = ()) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", *more]
    if payload_digest:
        head.append(f"WARC-Payload-Digest: sha256:{payload_digest}")
    if refers:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {refers[0]}", f"WARC-Refers-To-Target-URI: {refers[1]}", f"WARC-Refers-To-Date: {refers[2]}"]
    head += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_warc(record: bytes) -> tuple[dict, bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"{fields['WARC-Record-ID']} does not match its block digest")
    return fields, block


def write_arcs(pages: DataFrame, folder: str, date: str = "20000101000000", file_bytes: int = 1 << 28, press: bool = True) -> DataFrame:
    """ARC files of page_id, url, html rows, versions 1 and 2 in turn by partition: name, path, version, records.

    A file closes once it holds file_bytes, so that later steps deal files to tasks evenly.  press: records are gzip
    members, or else plain text."""
    schema = "name string, path string, version int, records long"
    packed = member if press else bytes

    def write(batches):
        part, records = TaskContext.get().partitionId(), (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        version, nth, n, first = 1 + part % 2, 0, [0], next(records, None)

        def chunks(name):
            nonlocal first
            data = packed(arc_version_block(name, version, date))
            at = len(data)
            yield data
            while first is not None and (at < file_bytes or not n[0]):
                key, url, html = first
                payload = (html or "").encode("utf-8", "surrogatepass")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if key is None else key}\r\nContent-Length: {len(payload)}\r\n\r\n"
                data = packed(arc_record(version, name, at, url, date, "text/html", head.encode() + payload))
                at += len(data)
                n[0] += 1
                first = next(records, None)
                yield data

        while first is not None:
            n[0], name = 0, f"part-{part:06d}-{nth:06d}.arc{'.gz' if press else ''}"
            path = f"{folder}/{name}"
            write_whole(path, chunks(name))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([path]), pa.array([version], pa.int32()), pa.array(n)], ["name", "path", "version", "records"])
            nth += 1

    cols = [F.col("page_id").cast("long").alias("page_id"), "url", "html"]
    n = partitions(pages.sparkSession)
    key = F.xxhash64("page_id", "url", F.length("html"))  # equal pages may fall in one file, never all pages
    dealt = pages.select(*cols, key.alias("k")).repartition(n, "k").sortWithinPartitions("page_id", "url", "k")
    return stored(dealt.select("page_id", "url", "html").mapInArrow(write, schema), "arcs")


def index_arcs(arcs: DataFrame) -> DataFrame:
    """Each captured record's place and payload digest: path, name, version, at, page_id, digest, bytes, rid, url, date."""
    schema = "path string, name string, version int, at long, page_id long, digest string, bytes long, rid string, url string, date string"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def scan(batches):
        for b in batches:
            for path, name in zip(*(b.column(i).to_pylist() for i in range(2))):
                rows, version = [], None
                with open_binary(path) as f:
                    for at, raw in arc_members(f):
                        fields, block, version = parse_arc(raw, version)
                        if fields["URL"].startswith("filedesc://"):
                            continue
                        head, payload = split_http(block)
                        found = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
                        rows.append((path, name, version, at, int(found[1]) if found else None, hashlib.sha256(payload).hexdigest(), len(payload), record_id(f"{name}#{at}#{fields['URL']}"), fields["URL"], warc_date(fields["Archive-date"])))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    n = partitions(arcs.sparkSession)
    return stored(arcs.select("path", "name").repartition(n, "path").mapInArrow(scan, schema), "index")


def convert(index: DataFrame, folder: str, least_bytes: int = 100) -> DataFrame:
    """Write one WARC file per ARC file and return the paths.

    Of equal payloads of at least least_bytes the one of the smallest page_id (null last, then by file and offset) is
    the response and the others revisit it."""
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "name", "at", "rid", "url", "date")
    groups = index.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    planned = index.join(groups, ["digest", "bytes"], "left").select("path", "name", "version", "at", "rid", "digest", F.col("first.rid").alias("first_rid"), F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date"))
    schema = "path string, records long"

    def write(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        row = next(rows, None)
        while row:
            path, name, n = row[0], row[1], [0]
            target, info = f"{name.removesuffix('.gz').removesuffix('.arc')}.warc.gz", record_id(f"{name}#warcinfo")

            def chunks():
                nonlocal row
                yield member(warc_record("warcinfo", info, "2000-01-01T00:00:00Z", f"urn:file:{name}", b"software: sluice\r\nformat: WARC File Format 1.1\r\n", "application/warc-fields", more=(f"WARC-Filename: {target}",)))
                with open_binary(path) as f:
                    while row and row[0] == path:
                        _, _, version, at, rid, digest, first, first_url, first_date = row
                        fields, block, _ = parse_arc(next(arc_members(f, at, 1))[1], version)
                        head, _ = split_http(block)
                        again = first is not None and first != rid
                        media = "application/http; msgtype=response" if head else fields["Content-type"]
                        kind = "revisit" if again else "response" if head else "resource"
                        n[0] += 1
                        yield member(warc_record(kind, rid, warc_date(fields["Archive-date"]), fields["URL"], head if again else block, media, digest, (first, first_url, first_date) if again else None, (f"WARC-IP-Address: {fields['IP-address']}", f"WARC-Warcinfo-ID: {info}")))
                        row = next(rows, None)

            out = f"{folder}/{target}"
            write_whole(out, chunks())
            yield pa.RecordBatch.from_arrays([pa.array([out]), pa.array(n)], ["path", "records"])

    n = partitions(index.sparkSession)
    return stored(planned.repartition(n, "path").sortWithinPartitions("path", "at").mapInArrow(write, schema), "warcs")


def read_warcs(warcs: DataFrame) -> DataFrame:
    """Captures of WARC files: rid, page_id, payload_bytes, payload_digest, record_type, refers (a record id)."""
    schema = "rid string, page_id long, payload_bytes long, payload_digest string, record_type string, refers string"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def read(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                with open_binary(path) as f:
                    for _, raw in members(f):
                        fields, block = parse_warc(raw)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = split_http(block)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = len(payload)
                        if kind == "revisit":  # its payload is the response's; the headers say how long
                            size = int(re.search(rb"(?im)^Content-Length: *(\d+)", head)[1])
                        elif hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{fields['WARC-Record-ID']} does not match its payload digest")
                        key = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
                        rows.append((fields["WARC-Record-ID"], int(key[1]) if key else None, size, digest, kind, fields.get("WARC-Refers-To")))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    n = partitions(warcs.sparkSession)
    return warcs.select("path").repartition(n, "path").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Pages to ARC files, those to WARC files, and those back to a row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to.  A null html is an empty payload, a null url an
    address of "-", a null page_id comes back null; repeated rows are a record each, of which one is the response; an
    empty table gives no rows; other columns are not read.  Folders lie under spark.checkpoint.dir."""
    folder = shared_dir(pages.sparkSession)
    records = stored(read_warcs(convert(index_arcs(write_arcs(pages, f"{folder}/arc")), f"{folder}/warc", least_bytes)), "records")
    # responses refer to nothing, so they stay out of the join: their null key would gather in one task
    again = records.where("refers is not null")
    seen = again.select("refers").distinct()
    responses = records.where("refers is null").select("rid", F.col("page_id").alias("refers_to")).join(seen, F.col("rid") == F.col("refers")).select("refers", "refers_to")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    whole = records.where("refers is null").withColumn("refers_to", F.lit(None).cast("long"))
    # one response may have a third of all rows as its revisits, so each response meets them in several parts
    parts = 16
    spread = responses.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = again.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int"))
    return whole.select(*columns).unionByName(dealt.join(spread, ["refers", "part"], "left").select(*columns))
