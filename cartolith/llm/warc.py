"""Web archives in ZIP packages: written from page rows, read back by byte ranges.

A package is a ZIP file whose members are stored, not compressed: `archive/data.warc.gz` (one gzip
member a record) and `indexes/index.cdxj` (offset and length of each record). The reader parses the
end record, the ZIP64 record where there is one, and the central directory; it finds both members'
places, reads the index, and fetches records by byte range. Nothing is extracted to disk.

Defined cases: null payload = empty; null url = no target header; a url with blanks or control
characters is escaped in the header and stands beside it as given; ids are whole 64-bit numbers;
null ids are kept (a null-id copy
of a page with an id refers to that id; among null ids alone each is a response); repeated rows are
written once each, and rows that share both the smallest id and the payload are all responses; an
empty table gives no packages and no rows. Only the three named columns are read, so others may
have any names.
"""

import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha256
from io import BytesIO

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, passing, saved, shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Records are gathered in memory up to this many compressed bytes, then become one package.
PACKAGE_BYTES = 32 << 20
#: One reading task's range holds about this many bytes of records.
RANGE_BYTES = 4 << 20

# ---- ZIP directory ---------------------------------------------------------------------------


def directory(file, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Members by name: (method, stored bytes, bytes, place of the local header)."""

    def at(place: int, n: int) -> bytes:
        file.seek(place)
        return file.read(n)

    tail_at = max(0, size - 65557)  # the end record and the longest comment
    tail = at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    locator = tail_at + end - 20
    if locator >= 0 and (found := at(locator, 20))[:4] == b"PK\x06\x07":
        wide = at(struct.unpack("<Q", found[8:16])[0], 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator points at no ZIP64 end record")
        count, length, start = struct.unpack("<QQQ", wide[32:56])
    block, members, p = at(start, length), {}, 0
    for _ in range(count):
        if block[p : p + 4] != b"PK\x01\x02":
            raise ValueError("the central directory breaks off")
        method = struct.unpack("<H", block[p + 10 : p + 12])[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", block[p + 20 : p + 34])
        place = struct.unpack("<I", block[p + 42 : p + 46])[0]
        name = block[p + 46 : p + 46 + n_name].decode("utf-8", "replace")
        extra, q = block[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[q : q + 4])
            if kind == 1:  # ZIP64: 8 bytes for each of these that is all ones, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[q + 4 : q + 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                place = next(wide) if place == 0xFFFFFFFF else place
            q += 4 + n
        members[name] = (method, packed, plain, place)
        p += 46 + n_name + n_extra + n_comment
    return members


def member_start(file, member: tuple[int, int, int, int]) -> int:
    """Where a stored member's own bytes begin."""
    if member[0] != 0:
        raise ValueError("the member is compressed and can't be read by ranges")
    file.seek(member[3])
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory points")
    n_name, n_extra = struct.unpack("<HH", head[26:30])
    return member[3] + 30 + n_name + n_extra


# ---- records ---------------------------------------------------------------------------------


def record(page_id, url, payload: bytes | None, digest: str, n: int, refers_to) -> bytes:
    """One WARC record, as a gzip member. A revisit has HTTP headers and no payload."""
    name = "null" if page_id is None else str(page_id)
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload or b"" if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        plain = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {plain}")
        if plain != url:  # the header holds no such characters: what was given stands beside it
            head.append(f"X-Target-Given: {json.dumps(url)}")
    if kind == "revisit":
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of an unpacked record."""

    def fields(block: bytes) -> dict[str, str]:
        lines = block.decode("utf-8", "surrogatepass").split("\r\n")[1:]
        return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}

    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def _package(records: list[bytes]) -> bytes:
    out, index, place = BytesIO(), [], 0
    for r in records:
        index.append(json.dumps({"offset": place, "length": len(r)}))
        place += len(r)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        z.writestr(DATA, b"".join(records))
        z.writestr(INDEX, "\n".join(index))
    return out.getvalue()


# ---- DataFrames ------------------------------------------------------------------------------


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100) -> DataFrame:
    """page_id, url, payload (binary; null for revisits), digest, n_bytes, refers_to.

    Equal payloads are found by digest on thin rows: a pre-aggregated minimum for each digest that
    occurs twice, joined to (id, digest) pairs. Payloads move once, by id, so a payload that a
    third of all pages share is no hot key for them.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    full = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("n_bytes"))
    thin = full.filter(F.col("n_bytes") >= least).select("page_id", "digest")
    first = thin.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null").drop("n")
    again = (
        thin.join(first, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), F.col("first_id").alias("refers_to"))
        .distinct()
    )
    out = full.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    return out.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "n_bytes", "refers_to")


def write_packages(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of with_roles() as packages under `folder`; (path, n_records) for each.

    Each task attempt uses names of its own, and the returned table names only those of attempts
    that committed, so a lost executor or a second attempt adds no records. The table is written;
    the folder is deleted when the driver ends.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def flush(records: list[bytes]) -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(_package(records))
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [len(records)]})

        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # Arrow keeps whole numbers whole, nulls or not
                b = whole.slice(at, 256)
                for row in zip(*(b[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "n_bytes", "refers_to")), strict=True):
                    held.append(record(*row))
                    size += len(held[-1])
                    if size >= PACKAGE_BYTES:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    out = saved(rows.mapInArrow(write, "path string, n_records long"), "packages")
    passing(rows.sparkSession, folder)
    return out


def read_packages(packages: DataFrame) -> DataFrame:
    """A row for each record of the packages in column `path`: page_id, url, record_type,
    refers_to, payload_bytes and payload_digest (of the full payload, for a revisit as its record
    states them; a response's digest is worked out anew and compared), payload (null: revisit)."""

    places = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))])
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["path"].to_pylist():
                store, place = pafs.FileSystem.from_uri(path)
                with store.open_input_file(place) as f:
                    members = directory(f, f.size())
                    data = member_start(f, members[DATA])
                    f.seek(member_start(f, members[INDEX]))
                    index = [json.loads(x) for x in f.read(members[INDEX][1]).splitlines()]
                rows, run, size = [], [], 0
                for x in index:
                    run.append((data + x["offset"], x["length"]))
                    size += x["length"]
                    if size >= RANGE_BYTES:
                        rows.append(run)
                        run, size = [], 0
                if run:
                    rows.append(run)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([path] * len(rows), [r[0][0] for r in rows], [[n for _, n in r] for r in rows]), places.types, strict=True)], schema=places)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, lengths in zip(*(b[c].to_pylist() for c in ("path", "start", "lengths")), strict=True):
                store, place = pafs.FileSystem.from_uri(path)
                with store.open_input_file(place) as f:
                    f.seek(start)
                    block = f.read(sum(lengths))
                rows, p = [], 0
                for n in lengths:
                    warc, http, payload = parse(zlib.decompress(block[p : p + n], 31))
                    p += n
                    kind, told = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and (sha256(payload).hexdigest() != told or len(payload) != int(http["content-length"])):
                        raise ValueError(f"damaged record in {path}")
                    own, to = (warc.get(k, "<urn:page:null>")[10:-1] for k in ("warc-record-id", "warc-refers-to"))
                    url = json.loads(warc["x-target-given"]) if "x-target-given" in warc else warc.get("warc-target-uri")
                    rows.append((None if own == "null" else int(own), url, kind, None if to == "null" else int(to), int(http["content-length"]), told, payload if kind == "response" else None))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), fields.types, strict=True)], schema=fields)

    found = packages.select("path").mapInArrow(ranges, "path string, start long, lengths array<long>")
    n = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(n, "path", "start")
    return dealt.mapInArrow(records, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to packages and read back from them."""
    rows = with_roles(load(spark, sf_dir, "pages"))
    packages = write_packages(rows, _uri(shared_dir(spark)) + "/packages")
    return read_packages(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


OP1_SQL = """
WITH p AS (SELECT page_id, url, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id IS NOT NULL AND f.first_id IS DISTINCT FROM p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id IS DISTINCT FROM p.page_id THEN f.first_id END AS refers_to, p.url
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
