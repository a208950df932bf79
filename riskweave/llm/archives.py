"""Web archives: WARC records in ZIP packages, read by ranges.

A package is a ZIP file with stored members: the records (`archive/data.warc.gz`, one gzip member a record), their places
(`indexes/index.cdxj`) and a description. The reader takes the end of the file, follows the ZIP64 locator where there is
one, parses the central directory, finds the stored members' bytes behind their local headers, and then reads index and
records by ranges. Nothing is unpacked to disk.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import BATCH_ROWS, cut_lineage, filesystem, new_path, task_batches

REVISIT_BYTES = 1000  # payloads from this size on are kept once
HEAVY = 1024  # a payload of more than one in so many of the repeated pages is joined by broadcast: there are fewer of them than this
RUN_BYTES = 4 << 20  # of neighbouring records read at once
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_TAIL = 20 + 22 + 65_535  # ZIP64 locator, end record and the longest comment
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# -- reading ZIP ----------------------------------------------------------------------------------


def read_directory(f, size: int) -> dict[str, dict]:
    """Members by name: method, stored size, size, place of the local header. `f` can seek and read."""
    at = max(0, size - _TAIL)
    f.seek(at)
    tail = f.read(size - at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP file")
    entries, length, offset = struct.unpack("<10xHII", tail[end : end + 20])
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":  # ZIP64 locator
        (place,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        f.seek(place)
        head = f.read(56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("damaged ZIP64 end record")
        entries, length, offset = struct.unpack("<QQQ", head[32:56])
    f.seek(offset)
    raw, at, out = f.read(length), 0, {}
    for _ in range(entries):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<HH", raw[at + 8 : at + 12])
        stored, full, n_name, n_extra, n_comment = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
        (header,) = struct.unpack("<I", raw[at + 42 : at + 46])
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # 64-bit values, only of the fields that are full
                values = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = next(values) if full == 0xFFFFFFFF else full
                stored = next(values) if stored == 0xFFFFFFFF else stored
                header = next(values) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        out[name] = {"method": method, "stored": stored, "size": full, "header": header}
        at += 46 + n_name + n_extra + n_comment
    return out


def member_start(f, member: dict) -> int:
    """Where the bytes of a stored member begin."""
    if member["method"] != 0:
        raise ValueError("member is compressed by the package; only stored members can be read by ranges")
    f.seek(member["header"])
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("damaged local header")
    return member["header"] + 30 + sum(struct.unpack("<HH", head[26:30]))


# -- records --------------------------------------------------------------------------------------


def record_bytes(row: dict, payload: bytes) -> bytes:
    """One WARC record with an HTTP response, or a revisit that holds its headers only."""
    digest = hashlib.sha1(payload).hexdigest()
    revisit = row["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(row['refers_to'])}", f"X-Payload-Length: {len(payload)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """Headers and payload of an uncompressed record; the length and digest of what a response holds are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("record ends early")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("payload does not match its digest")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload": payload,
        "payload_bytes": len(payload) if payload is not None else int(fields["x-payload-length"]),
        "payload_digest": digest,
        "refers_to": page_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


# -- writing packages -----------------------------------------------------------------------------

_MANIFEST = pa.schema([("path", pa.string()), ("n", pa.int64()), ("size", pa.int64())])


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        path = f"{root}/{uuid.uuid4().hex}.wacz"  # a repeated attempt writes another file, only listed ones count
        index: list[bytes] = []
        out = None
        at = n = 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = fs.open_output_stream(path)
                    package = zipfile.ZipFile(_Forward(out), "w", zipfile.ZIP_STORED, allowZip64=True)
                    member = package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                raw = _gzip(record_bytes(row, (row["html"] or "").encode("utf-8")))
                member.write(raw)
                index.append(f"{n:012d} 19700101000000 {json.dumps({'offset': at, 'length': len(raw)})}\n".encode())
                at += len(raw)
                n += 1
        if out is None:
            return
        member.close()
        package.writestr(zipfile.ZipInfo(INDEX), b"".join(index))
        package.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "records": n}))
        package.close()
        size = out.tell()
        out.close()
        yield pa.RecordBatch.from_pylist([{"path": path, "n": n, "size": size}], _MANIFEST)

    return run


class _Forward:
    """A store's output stream as the ZIP writer wants it: forward only."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, raw) -> int:
        self.stream.write(bytes(raw))
        return len(raw)

    def flush(self) -> None:
        pass

    def seekable(self) -> bool:
        return False


def write_archives(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Write a record for each row of (page_id, url, html) and return the packages: path, n, size.

    Of records with equal payloads of at least `least` bytes the one with the largest page_id (null counts as smallest) is
    a response, others revisit it; rows that repeat that page_id with that payload are responses too.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "archives")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    # small payloads go by their page, so that the join deals them out evenly
    small = F.concat(F.lit("page "), F.coalesce(F.xxhash64("page_id", "url").cast("string"), F.lit("")))
    keyed = rows.withColumn("digest", F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).otherwise(small))
    first = cut_lineage(
        keyed.filter("digest not like 'page %'").groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    # payloads shared by very many pages are few and are broadcast; their pages go by themselves in the other join
    rows_of_first = first.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") * HEAVY > rows_of_first
    common = first.filter(heavy).select("digest", F.col("kept").alias("common_kept"), F.lit(True).alias("common"))
    met = keyed.join(F.broadcast(common), "digest", "left").withColumn("digest", F.when(F.col("common"), small).otherwise(F.col("digest")))
    refers_to = F.coalesce("common_kept", "kept")
    refers = F.when(~refers_to.eqNullSafe(F.col("page_id")), refers_to)
    placed = met.join(first.filter(~heavy).select("digest", "kept"), "digest", "left").select("page_id", "url", "html", refers.alias("refers_to"))
    # a package for each task of the join; no further shuffle of the pages
    return cut_lineage(placed.mapInArrow(_write(folder), "path string, n long, size long"))


# -- reading packages -----------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each package, runs of neighbouring records from its index."""
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("n", pa.int64())])

    def rows():
        for batch in batches:
            for package in batch.to_pylist():
                fs, path = filesystem(package["path"])
                with fs.open_input_file(path) as f:
                    members = read_directory(f, f.size())
                    start = member_start(f, members[DATA])
                    f.seek(member_start(f, members[INDEX]))
                    index = f.read(members[INDEX]["size"])
                lo = hi = n = 0
                for line in index.splitlines():
                    place = json.loads(line.split(b" ", 2)[2])
                    if n and place["offset"] + place["length"] - lo > RUN_BYTES:
                        yield {"path": path, "offset": start + lo, "length": hi - lo, "n": n}
                        lo, n = place["offset"], 0
                    hi = place["offset"] + place["length"]
                    n += 1
                if n:
                    yield {"path": path, "offset": start + lo, "length": hi - lo, "n": n}

    yield from task_batches(rows(), schema)


def read_records(path: str, offset: int, length: int) -> Iterator[dict]:
    """The records of one range of a package."""
    fs, path = filesystem(path)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        raw = f.read(length)
    while raw:
        unpacker = zlib.decompressobj(31)
        record = unpacker.decompress(raw)
        if not unpacker.eof:
            raise ValueError("range ends within a record")
        yield parse_record(record)
        raw = unpacker.unused_data


def _records(with_payload: bool):
    names = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(names + ([("payload", pa.binary())] if with_payload else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    records = list(read_records(r["path"], r["offset"], r["length"]))
                    if len(records) != r["n"]:
                        raise ValueError(f"{r['path']}: {len(records)} records where the index has {r['n']}")
                    yield from ({k: v for k, v in x.items() if k in schema.names} for x in records)

        yield from task_batches(rows(), schema, BATCH_ROWS // 10 if with_payload else BATCH_ROWS)

    return run


def read_archives(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload, null for revisits) of all records.

    Digests and lengths of responses are those of the bytes read, and are checked against the record's headers; revisits
    state those of the payload they refer to. A missing or damaged range fails the job. Null html is an empty payload, a
    null url an empty one; repeated pages are read back as often as they were written.
    """
    spark = packages.sparkSession
    tasks = max(1, packages.count())
    runs = cut_lineage(packages.repartition(tasks, "path").mapInArrow(_runs, "path string, offset long, length long, n long"))
    spread = runs.repartition(max(tasks, spark.sparkContext.defaultParallelism), "path", "offset")
    extra = ", payload binary" if with_payload else ""
    return spread.mapInArrow(_records(with_payload), f"page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long{extra}")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    return read_archives(write_archives(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
