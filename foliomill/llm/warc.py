"""Web archives of one Zstandard frame per record behind a leading dictionary frame: writing, and validated reading."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.session import fresh_path

# fixed values of the archive and frame formats
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", VERSION)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
DATE = "2024-01-01T00:00:00Z"

ARCHIVE_BYTES = 16 << 20  # payload bytes after which an archive is closed
DICTIONARY_BYTES = 16 << 10
MOST_READERS = 20_000  # tasks among which archives are dealt out
SAMPLE_BYTES = 1 << 20  # leading payload bytes of an archive that its dictionary is made from


class Record(NamedTuple):
    headers: dict[str, str]
    payload: bytes


def write_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> bytes | None:
    """Dictionary of some records; none if there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def split_dictionary(archive: memoryview) -> tuple[bytes | None, int]:
    """Dictionary in the leading skippable frame, and where the records begin."""
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_FRAME:
        return None, 0
    end = 8 + struct.unpack_from("<I", archive, 4)[0]
    if end > len(archive):
        raise ValueError("the dictionary frame is cut off")
    found = bytes(archive[8:end])
    if found[:4] == struct.pack("<I", ZSTD_FRAME):
        found = zstandard.ZstdDecompressor().decompressobj().decompress(found)
    return found, end


def frame_end(archive: memoryview, start: int) -> int:
    """End of the frame at ``start``, from its block headers."""
    if len(archive) < start + 6 or struct.unpack_from("<I", archive, start)[0] != ZSTD_FRAME:
        raise ValueError(f"no frame at byte {start}")
    head = bytes(archive[start : start + 18])
    at = start + zstandard.frame_header_size(head)
    checksum = 4 * bool(head[4] & 4)
    last = False
    while not last:
        if at + 3 > len(archive):
            raise ValueError(f"the frame at byte {start} is cut off")
        block = int.from_bytes(archive[at : at + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    if at + checksum > len(archive):
        raise ValueError(f"the frame at byte {start} is cut off")
    return at + checksum


def parse_record(data: bytes) -> Record:
    """Headers in lower case and the payload behind any HTTP head; raises if a header or a length is wrong."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in VERSIONS:
        raise ValueError(f"not a record: {data[:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:40]!r}")
        headers[name.decode().strip().lower()] = value.decode().strip()
    if missing := [h for h in REQUIRED if h not in headers]:
        raise ValueError(f"headers are missing: {missing}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, its header says {length}")
    block = rest[:length]
    if headers.get("content-type", "").startswith("application/http"):
        http, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise ValueError("the HTTP head has no end")
    else:
        payload = block
    digest = headers.get("warc-payload-digest")
    if digest and headers["warc-type"] == "response" and digest != f"sha1:{hashlib.sha1(payload).hexdigest()}":
        raise ValueError(f"payload and digest differ in {headers['warc-record-id']}")
    return Record(headers, payload)


def read_archive(archive: bytes) -> Iterator[Record]:
    view = memoryview(archive)
    dictionary, at = split_dictionary(view)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpack = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(view):
        end = frame_end(view, at)
        yield parse_record(unpack.decompressobj().decompress(view[at:end]))
        at = end


def pack_records(records: Iterable[bytes], sample: int = SAMPLE_BYTES) -> Iterator[bytes]:
    """Frames of an archive: the dictionary of the leading records, then one frame per record."""
    records, first, size = iter(records), [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= sample:
            break
    dictionary = train(first)
    options = {"level": 3, "write_checksum": True}
    if dictionary:
        yield dictionary_frame(dictionary)
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
    pack = zstandard.ZstdCompressor(**options)
    yield from map(pack.compress, first)
    yield from map(pack.compress, records)


def _page_record(page: object, url: str | None, html: str | None, own: str, refers: str | None) -> tuple[bytes, int]:
    payload = (html or "").encode()
    headers = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": own,
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{hashlib.sha1(payload).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
    }
    if url and not any(c in url for c in "\r\n"):
        headers["WARC-Target-URI"] = url
    if page is not None:
        headers["X-Page-ID"] = str(page)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers is not None:
        headers |= {"WARC-Refers-To": refers, "WARC-Profile": PROFILE}
        return write_record(headers, http), len(http)
    return write_record(headers, http + payload), len(payload)


def _record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page row {row}')}>"


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id, url, html``) and return the stored list ``path, records``.

    Of equal payloads of at least ``min_bytes`` the row with the largest id is the response and the others are revisits
    that refer to it; a row repeated with the same id is a response once. Each attempt of a task writes files of its own
    and the list names those of the attempts that counted, so a repeated task does no harm. ``folder`` must be reachable
    by every executor. Null html is an empty payload, a null url or one with line breaks is left out of its record.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").alias("_page"),
        F.col("url").alias("_url"),
        F.col("html").alias("_html"),
        F.monotonically_increasing_id().alias("_row"),
    )
    large = F.coalesce(F.octet_length("_html"), F.lit(0)) >= min_bytes
    # a small payload gets a digest of its own row, so that it meets no other
    digest = F.when(large, F.sha2("_html", 256)).otherwise(F.col("_row").cast("string"))
    keyed = rows.withColumn("_digest", digest)
    owners = keyed.filter(large).groupBy("_digest").agg(F.max(F.struct("_page", "_row"))["_row"].alias("_owner"), F.count("*").alias("_n"))
    keyed = keyed.join(owners.filter("_n > 1").select("_digest", "_owner"), "_digest", "left")
    refers = F.when(F.col("_owner") != F.col("_row"), F.col("_owner"))
    keyed = keyed.select("_page", "_url", "_html", "_row", refers.alias("_refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True))
        done, number = False, 0
        while not done:
            taken = [0, 0]

            def records() -> Iterator[bytes]:
                nonlocal done
                while taken[1] < archive_bytes:
                    row = next(rows, None)
                    if row is None:
                        done = True
                        return
                    page, url, html, own, refers_to = row
                    record, size = _page_record(page, url, html, _record_id(own), None if refers_to is None else _record_id(refers_to))
                    taken[0] += 1
                    taken[1] += size
                    yield record

            name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.warc.zst"
            with store.open_output_stream(name) as out:
                for frame in pack_records(records()):
                    out.write(frame)
            if taken[0]:
                yield pa.record_batch([pa.array([name.rsplit("/", 1)[1]]), pa.array([taken[0]], pa.int64())], names=["path", "records"])
            number += 1

    keyed.mapInArrow(write, "path string, records bigint").write.parquet(listed := fresh_path(spark, "archive-list"))
    return spark.read.schema("path string, records bigint").parquet(listed)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of the listed archives: ``record_id, page_id, url, record_type, payload, payload_bytes, payload_digest,
    refers_to_record``. Stops at a record whose headers, length or digest are wrong, or if one is missing."""
    schema = (
        "record_id string, page_id bigint, url string, record_type string, payload string, payload_bytes bigint, "
        "payload_digest string, refers_to_record string"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{root}/{path}") as f:
                    archive = f.read()
                seen, rows = 0, []
                for record in read_archive(archive):
                    h = record.headers
                    whole = h["warc-type"] == "response"
                    rows.append({
                        "record_id": h["warc-record-id"],
                        "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
                        "url": h.get("warc-target-uri"),
                        "record_type": h["warc-type"],
                        "payload": record.payload.decode() if whole else None,
                        "payload_bytes": len(record.payload) if whole else None,
                        "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"),
                        "refers_to_record": h.get("warc-refers-to"),
                    })
                    seen += 1
                    if len(rows) == 200:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                if seen != n:
                    raise ValueError(f"{path} has {seen} records, not {n}")

    arrow = pa.schema([(f, pa.int64() if f in ("page_id", "payload_bytes") else pa.string()) for f in schema.replace(" string", "").replace(" bigint", "").split(", ")])
    # a list of paths is tiny, whatever the archives hold: the number of readers follows from their number
    readers = max(1, min(archives.count(), MOST_READERS))
    return archives.repartition(readers, "path").mapInArrow(read, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``; a revisit has the length of
    the payload that it refers to and that response's page id. A response that many records refer to is one row of the
    join's smaller side."""
    slim = records.select("record_id", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to_record")
    whole = slim.filter("record_type = 'response'")
    first = whole.select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_n")
    )
    found = slim.filter("record_type <> 'response'").join(first, "refers_to_record", "left")
    revisits = found.select("page_id", F.coalesce("payload_bytes", "_n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    # responses refer to nothing and need no join
    return revisits.unionByName(whole.drop("record_id").withColumnRenamed("refers_to_record", "refers_to").withColumn("refers_to", F.lit(None).cast("bigint")))


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and resolve the revisits.

    One row per input row, repeated rows and null ids included; an empty table gives an empty result; columns other than
    ``page_id, url, html`` are not read.
    """
    folder = fresh_path(spark, "archives")
    archives = write_archives(pages, folder, min_bytes)
    read_archives(archives, folder).drop("payload").write.parquet(stored := fresh_path(spark, "records"))
    return resolve_revisits(spark.read.parquet(stored))
