"""WARC archives: written by Spark's own file sink, read back by byte ranges.

Writing. Every record is one gzip member. The last byte of a member is the top byte of its length, zero below 16 MB; a longer record
is followed by an empty member, which ends in zero too. So members are the rows of a text sink whose row end is one zero byte: the
archive goes through Spark's committer to any file system Spark can write, and a task that dies leaves nothing behind.

Reading. Tasks get byte ranges of the archives and cut them at the gzip magic; a piece belongs to the range it starts in. A candidate
counts as a member only if its gzip header and the first bytes of its record decode; the magic may also occur inside compressed
data, and such pieces are joined to the member they interrupt, across ranges if need be.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.shipping import by_value
from .common import fresh_folder, utf8

MAGIC = b"\x1f\x8b\x08"
#: Smaller payloads are always stored; of larger equal ones, the first is.
MIN_REVISIT = 100
LEVEL = 6
BATCH_BYTES = 8 << 20
#: Bytes of a candidate that are decoded before it counts as a member.
PROBE = 1 << 12
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_bytes(kind: str, url: str, page: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url}')}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page is not None:
        head.append(f"X-Page-ID: {quote(page, safe='')}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {quote(refers_to, safe='')}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = LEVEL) -> bytes:
    """Ends in a zero byte; an empty member follows where the record's length would not."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def first_pages(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(digest, refers_to): the smallest page of each payload of at least MIN_REVISIT bytes that occurs more than once."""
    raw = utf8(html)
    keyed = pages.select(F.col(page_id).alias("page"), F.sha2(raw, 256).alias("digest"), F.octet_length(raw).alias("size"))
    many = keyed.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page").alias("refers_to"), F.count("*").alias("n"))
    return many.where("n > 1").select("digest", "refers_to")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", level: int = LEVEL) -> None:
    """One record per page: response, or revisit of the smallest page with the same payload of at least MIN_REVISIT bytes.

    A null html is an empty payload; a null url is written as an empty target. Pages that repeat the id of the stored one are
    responses too. Line ends in urls become spaces. Ids are percent-encoded; a null id has no header.
    """
    raw = utf8(html)
    # Only digests travel in the join; they are few, as only payloads that occur more than once are listed.
    firsts = first_pages(pages, page_id, html)
    wide = pages.select(F.col(page_id).alias("page"), F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), "[\r\n]+", " ").alias("url"),
                        raw.alias("payload"), F.sha2(raw, 256).alias("digest"))
    typed = wide.join(firsts, "digest", "left").withColumn("revisit", F.coalesce(F.col("refers_to") != F.col("page"), F.lit(False)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            columns = [batch.column(c) for c in ("page", "url", "payload", "digest", "refers_to", "revisit")]
            for page, target, payload, digest, first, again in zip(*columns):
                body, again = payload.as_py(), again.as_py()
                named = str(page.as_py()) if page.is_valid else None
                record = record_bytes("revisit" if again else "response", target.as_py(), named, body, len(body), digest.as_py(), str(first.as_py()) if again else None)
                rows.append(member(record, level)[:-1])
                held += len(rows[-1])
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    members = typed.select("page", "url", "payload", "digest", "refers_to", "revisit").mapInArrow(pack, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


def _inflate(piece: bytes) -> tuple[bytes, bool]:
    """The first member's bytes and whether it is whole. Raises zlib.error for what is no member."""
    unpacker = zlib.decompressobj(31)
    out = unpacker.decompress(piece)
    return out, unpacker.eof


def is_member(piece: bytes) -> bool:
    """Whether gzip header and record header decode (or the member is empty)."""
    unpacker = zlib.decompressobj(31)
    try:
        out = unpacker.decompress(piece[:PROBE], 64)
    except zlib.error:
        return False
    return out.startswith(b"WARC/") or (not out and unpacker.eof)


def parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    page, first = (None if v is None else unquote(v) for v in (fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")))
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged record of page {page}")
    return {"page_id": page, "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload": None if revisit else payload,
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest, "refers_to": first}


FIELDS = "page_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string"


def _scan(batches: Iterator[pa.RecordBatch], records: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of ranges in, records out; what cannot be settled inside a range is a loose piece (file, range, place).

    records: whether the records or the loose pieces are given out."""
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "file", "range", "place", "loose"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary()]
    rows: list[dict] = []
    held, where, place = b"", None, 0

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds)], names)
        rows.clear()
        return made

    def loose(piece: bytes) -> None:
        nonlocal place
        if not records:
            rows.append({"file": where[0], "range": where[1], "place": place, "loose": piece})
        place += 1

    def settled(record: bytes) -> None:
        if records and record:
            rows.append(parse(record))

    size = 0
    for batch in batches:
        for file, begin, value in zip(batch.column("file").to_pylist(), batch.column("range").to_pylist(), batch.column("value")):
            if (file, begin) != where:
                if held:
                    loose(held)
                held, where, place = b"", (file, begin), 0
                if begin == 0:  # what stands before the first magic of a file
                    if value.as_py():
                        raise ValueError(f"{file} does not begin with a gzip member")
                    continue
            piece = MAGIC + value.as_py()
            if held:
                joined = held + piece
                try:
                    done, whole = _inflate(joined)
                except zlib.error:
                    raise ValueError(f"damaged member in {file}, range from {begin}")
                held = b"" if whole else joined
                if whole:
                    settled(done)
            elif not is_member(piece):
                loose(piece)  # goes on a member that another range began
            else:
                done, whole = _inflate(piece)
                if not whole:
                    held = piece
                else:
                    settled(done)
                    size += len(done)
            if rows and size > BATCH_BYTES:
                yield out()
                size = 0
    if held:
        loose(held)
    if rows:
        yield out()


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Loose pieces of a file in order: a member and what follows until it is whole."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [f.split()[0] for f in FIELDS.split(", ")]
    held, now = b"", None
    for batch in batches:
        for file, value in zip(batch.column("file").to_pylist(), batch.column("loose")):
            if file != now and held:
                raise ValueError(f"cut member at the end of {now}")
            now, held = file, held + value.as_py()
            done, whole = _inflate(held)
            if whole:
                held = b""
                if done:
                    r = parse(done)
                    yield pa.RecordBatch.from_arrays([pa.array([r[n]], k) for n, k in zip(names, kinds)], names)
    if held:
        raise ValueError(f"cut member at the end of {now}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, record_type, payload (null for revisits), payload_bytes, payload_digest, refers_to of every record in a folder.

    Payloads are checked against their digests; a damaged or cut record stops the read. Archives are found by name without a
    compression suffix, as a suffix would make the file layer unpack whole files.
    """
    ranges = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(folder)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")))
    columns = f"{FIELDS}, file string, range long, place int, loose binary"
    names = [f.split()[0] for f in FIELDS.split(", ")]
    found = ranges.mapInArrow(lambda b: _scan(b, True), columns).select(*names)
    pieces = ranges.mapInArrow(lambda b: _scan(b, False), columns).select("file", "range", "place", "loose")
    mended = pieces.repartition("file").sortWithinPartitions("file", "range", "place").mapInArrow(_mend, FIELDS)
    return found.unionByName(mended)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the pages to a new folder of the shared one and reads the archives back; ids come back in their own type."""
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    write(pages, folder, page_id, url, html)
    kind = pages.schema[page_id].dataType
    back = read(spark, folder)
    typed = lambda c: F.col(c).cast(kind).alias(c)
    return back.select(typed("page_id"), "url", "record_type", "payload", "payload_bytes", "payload_digest", typed("refers_to"))


by_value(__name__)
