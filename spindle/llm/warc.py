"""Zstandard web archives (``.warc.zst``): writer and reader.

An archive starts with a skippable frame that holds the compression
dictionary; every record is one frame compressed with it.  Archives are
written by the tasks that hold the records and read back frame by frame, so
neither side ever holds an archive in memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import new_file, open_file, staged

# Fixed values of the formats.
DICT_FRAME_MAGIC = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
ZSTD_FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED_FIELDS = ("warc-type", "warc-record-id", "warc-date", "content-length")

MANIFEST = "archive string, records long, bytes long"
RECORDS = ("archive string, offset long, record_id string, record_type string, target_uri string, "
           "refers_to string, payload binary, payload_bytes long, payload_digest string, error string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, response_id, record_type`` for every row of ``pages``.

    Among rows with equal payloads of at least ``min_bytes`` bytes the largest
    ``page_id`` is the response and the others revisit it; shorter payloads are
    all responses.  A null html is an empty payload.  A null ``page_id`` is
    smaller than any other; rows that share the largest ``page_id`` are
    responses alike, and so are all rows of a payload that has no ``page_id``.
    Other columns of ``pages`` are ignored, so clashing names do no harm.

    One row per payload digest is aggregated map-side, then joined: the join
    keeps no group together, so Spark can split a payload that many pages share.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("long_enough", F.octet_length("payload") >= min_bytes)
    first = (rows.filter("long_enough").groupBy("digest").agg(F.max("page_id").alias("response_id")))
    joined = rows.join(first, "digest", "left")
    revisit = F.col("long_enough") & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select("page_id", "url", "payload",
                         F.when(revisit, F.col("response_id")).alias("response_id"),
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP head (with the full length) and drops the payload."""
    digest = sha1_base32(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records, or none where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes one archive; the dictionary comes from the records gathered first."""

    def __init__(self, folder: str, level: int, dict_bytes: int, sample_bytes: int):
        self.uri, self.stream = new_file(folder, ".warc.zst")
        self.level, self.dict_bytes, self.sample_bytes = level, dict_bytes, sample_bytes
        self.waiting, self.waiting_bytes, self.compressor = [], 0, None
        self.records = self.raw_bytes = self.bytes = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw_bytes += len(record)
        if self.compressor is not None:
            self._write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= self.sample_bytes:
            self._begin()

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def _begin(self) -> None:
        # samples are heads of records: long ones would crowd out the rest
        trained = train_dictionary([r[:16384] for r in self.waiting], self.dict_bytes)
        if trained is not None:
            body = trained.as_bytes()
            self._write(struct.pack("<II", DICT_FRAME_MAGIC, len(body)) + body)
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_content_size=True, write_checksum=True)
        for record in self.waiting:
            self._write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> dict:
        if self.compressor is None:
            self._begin()
        self.stream.close()
        return {"archive": self.uri, "records": self.records, "bytes": self.bytes}


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 256 << 20, level: int = 3,
                   dict_bytes: int = 32 << 10, sample_bytes: int = 1 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write rows of :func:`mark_revisits` to archives below ``folder``.

    Returns the manifest (``archive, records, bytes``), itself written to the
    shared folder: it names the archives of the committed task attempts only.
    A task opens a new archive after ``archive_bytes`` of records."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, out = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "response_id")), strict=True):
                out = out or ArchiveWriter(folder, level, dict_bytes, sample_bytes)
                out.add(record_bytes(*row, date))
                if out.raw_bytes >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return staged(records.select("page_id", "url", "payload", "response_id").mapInArrow(write, MANIFEST), "warc-manifest")


def frames(stream, chunk: int = 1 << 18, max_record: int = 1 << 30) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``(offset, record, error)`` per frame of an archive.

    The dictionary comes from a leading skippable frame (plain, or itself a
    Zstandard frame); other skippable frames are passed over.  A frame that
    cannot be decoded ends the archive with an error."""
    dictionary, held, offset, first = None, b"", 0, True

    def fill(n: int) -> bool:
        nonlocal held
        while len(held) < n:
            more = stream.read(max(chunk, n - len(held)))
            if not more:
                return False
            held += more
        return True

    while fill(1):
        if not fill(4):
            yield offset, None, "truncated frame"
            return
        magic = struct.unpack("<I", held[:4])[0]
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if not fill(8) or not fill(8 + (size := struct.unpack("<I", held[4:8])[0])):
                yield offset, None, "truncated skippable frame"
                return
            if first and magic == DICT_FRAME_MAGIC:
                body = held[8:8 + size]
                if body[:4] == struct.pack("<I", ZSTD_FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
                dictionary = zstandard.ZstdCompressionDict(body)
            held, offset, first = held[8 + size:], offset + 8 + size, False
            continue
        first = False
        decoder, parts, size, used = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), [], 0, 0
        try:
            while not decoder.eof:
                if not fill(1):
                    raise zstandard.ZstdError("truncated frame")
                used += len(held)
                parts.append(decoder.decompress(held))
                held, size = decoder.unused_data if decoder.eof else b"", size + len(parts[-1])
                if size > max_record:
                    raise zstandard.ZstdError(f"record over {max_record} bytes")
        except zstandard.ZstdError as e:
            yield offset, None, f"bad frame: {e}"
            return
        yield offset, b"".join(parts), None
        offset += used - len(held)


def parse_record(record: bytes) -> dict:
    """Fields of a record, or ``error`` with what is wrong in its head, lengths or digests."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.decode("utf-8", "replace").partition("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", version):
        return {"error": "no WARC head"}
    field: dict[str, str] = {}
    for line in lines.split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#-'*+.0-9A-Z^_`a-z|~-]+", name):
            return {"error": f"bad field: {line[:80]}"}
        field[name.lower()] = value.strip()
    for name in REQUIRED_FIELDS:
        if name not in field:
            return {"error": f"missing {name}"}
    if not field["content-length"].isdecimal() or rest[-4:] != b"\r\n\r\n" or len(rest) - 4 != int(field["content-length"]):
        return {"error": "Content-Length does not match the block"}
    block = rest[:-4]
    if (said := field.get("warc-block-digest")) and said != f"sha1:{sha1_base32(block)}":
        return {"error": "block digest does not match"}
    got = {"record_id": field["warc-record-id"], "record_type": field["warc-type"], "target_uri": field.get("warc-target-uri"),
           "refers_to": field.get("warc-refers-to"), "payload": block, "payload_bytes": len(block), "payload_digest": None, "error": None}
    if field.get("content-type", "").startswith("application/http"):
        http, mark, payload = block.partition(b"\r\n\r\n")
        said_length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        if not mark or not http.startswith(b"HTTP/"):
            return {"error": "no HTTP head"}
        length = int(said_length[1]) if said_length else len(payload)
        if field["warc-type"] != "revisit" and length != len(payload):
            return {"error": "HTTP Content-Length does not match the payload"}
        got |= {"payload": payload, "payload_bytes": length}
    said = field.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if said and field["warc-type"] != "revisit" and said != sha1_base32(got["payload"]):
        return {"error": "payload digest does not match"}
    return got | {"payload_digest": said}


def read_archives(archives: DataFrame, payloads: bool = True, rows_per_batch: int = 256) -> DataFrame:
    """Records of the archives named in column ``archive``, one row per frame.

    Damaged frames and records give a row whose ``error`` says what is wrong;
    nothing is dropped.  ``payloads=False`` leaves the payload column null."""
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n in ("offset", "payload_bytes") else pa.string()) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                with open_file(uri) as stream:
                    for offset, record, error in frames(stream):
                        got = parse_record(record) if error is None else {"error": error}
                        if not payloads:
                            got["payload"] = None
                        held.append({n: got.get(n) for n in names} | {"archive": uri, "offset": offset})
                        size += len(got.get("payload") or b"")
                        if len(held) >= rows_per_batch or size >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    # a fixed number of partitions: the rows are small, so merging them by size would leave one task
    partitions = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(partitions, F.col("archive")).mapInArrow(read, RECORDS)


def pages_through_archives(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write every row of ``pages`` to archives, read them back: one row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, all taken
    from the archives; a damaged record fails the job.  An empty table gives no
    archive and no rows."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    read = read_archives(write_archives(mark_revisits(pages, min_bytes), folder), payloads=False)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("archive", F.lit(" at "), "offset", F.lit(": "), "error"))).otherwise(F.col("payload_bytes"))
    return read.select(number(F.col("record_id")).alias("page_id"), sound.cast("long").alias("payload_bytes"), "payload_digest", "record_type",
                       number(F.col("refers_to")).alias("refers_to"))
