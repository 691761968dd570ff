"""Web archives of Zstandard frames, written and read by Spark.

An archive begins with a skippable frame that holds the dictionary; every record is a frame of its own
after it. Spark's text writer puts the frames into the files, so that they go to whatever store the
folder is in: its line separator is an empty skippable frame, which Zstandard readers pass over. The
reader finds each frame's end from its block headers, decodes one frame per record, and validates
headers, lengths and digests; a fault raises, as a silently lost record would not be noticed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import new_path, present

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
EMPTY_SKIPPABLE = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2020-01-01T00:00:00Z"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")

#: The dictionary is trained on the leading bytes of this many pages, those with the smallest id hashes.
SAMPLE_PAGES = 256
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
#: An archive is closed by the record that takes its frames to this many bytes; the next begins with the dictionary.
ARCHIVE_BYTES = 1 << 26


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def skippable(magic: int, content: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins here ends, from its header and block headers."""
    describes = data[at + 4]
    single = describes >> 5 & 1
    size_bytes = (single, 2, 4, 8)[describes >> 6]
    at += 5 + (not single) + (0, 1, 2, 4)[describes & 3] + size_bytes
    while True:
        header = int.from_bytes(data[at : at + 3], "little")
        kind = header >> 1 & 3
        if kind == 3 or at + 3 > len(data):
            raise ValueError("broken frame")
        at += 3 + (1 if kind == 1 else header >> 3)
        if header & 1:
            return at + 4 * (describes >> 2 & 1)


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    view, at, dictionary, first = memoryview(data), 0, None, True
    decoder = zstandard.ZstdDecompressor()
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            end = at + 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            if first and magic == DICTIONARY_MAGIC:
                content = bytes(view[at + 8 : end])
                if content[:4] == FRAME_MAGIC.to_bytes(4, "little"):
                    content = zstandard.ZstdDecompressor().decompress(content)
                dictionary = zstandard.ZstdCompressionDict(content)
                decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
        elif magic == FRAME_MAGIC:
            end = frame_end(view, at)
            if end > len(view):
                raise ValueError("the archive ends inside a frame")
            yield decoder.decompress(view[at:end])
        else:
            raise ValueError(f"no frame begins at byte {at}")
        at, first = end, False
    if at != len(view):
        raise ValueError("the archive ends inside a frame")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its whole payload, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = [line.decode().partition(":") for line in lines]
    if any(not colon for _, colon, _ in pairs):
        raise ValueError("a header line has no colon")
    return {name: value.strip() for name, _, value in pairs}


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", name)
    if not found:
        raise ValueError(f"unknown record id {name}")
    return int(found[1]) if found[1] else None


def parse(data: bytes) -> dict:
    """A record's fields, every declared length and the payload digest checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    fields = _fields(lines)
    if version != VERSION or not gap or any(n not in fields for n in NEEDED):
        raise ValueError("not a record, or a header field is missing")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as declared")
    block = rest[:length]
    http, gap, payload = block.partition(b"\r\n\r\n")
    declared = int(_fields(http.split(b"\r\n")[1:])["Content-Length"])
    kind, named = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        if not gap or len(payload) != declared or digest(payload) != named:
            raise ValueError("the payload is not as declared")
    elif kind != "revisit" or payload or "WARC-Refers-To" not in fields:
        raise ValueError(f"a {kind} record that is not understood")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": declared,
        "payload_digest": named,
        "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample; empty where there are too few pages to train one."""
    hashed = pages.where("html <> ''").select(F.xxhash64("page_id", "html").alias("h"), F.encode("html", "UTF-8").alias("b"))
    smallest = [r["h"] for r in hashed.select("h").orderBy("h").limit(SAMPLE_PAGES).collect()]  # hashes alone are sent
    chosen = hashed.where(F.col("h").isin(smallest)).groupBy("h").agg(F.first(F.substring("b", 1, SAMPLE_BYTES)).alias("b"))
    samples = [bytes(r["b"]) for r in chosen.orderBy("h").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record per row with ``page_id``, ``url`` and ``html``; null html is an empty payload.

    Of rows with equal payloads of at least ``min_bytes``, the largest page id is the response and rows
    with another id revisit it; rows that repeat the response's id are responses too, and so are all
    rows of a payload that has no id but null. An empty table gives no archive. Further columns are not
    read. A task writes its records into as many archives as they need, each a folder with one file that
    exceeds ``archive_bytes`` by less than a record: readers hold one archive at a time. The pages are shuffled once, by id, which no group of copies makes uneven;
    groups are found on digests alone, counted in each task before they are shuffled.
    """
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), present("html").alias("html"))
    dictionary = train_dictionary(plain)
    keyed = plain.withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    keys = keyed.where(F.octet_length("html") >= min_bytes).select("page_id", "sha")
    groups = keys.groupBy("sha").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1 and response is not null").drop("n")
    links = keys.join(groups, "sha").where(~F.col("page_id").eqNullSafe(F.col("response"))).distinct()
    links = links.select(F.col("page_id").alias("of_page"), F.col("sha").alias("of_sha"), "response")
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("sha") == F.col("of_sha"))
    rows = keyed.join(links, same, "left").select("page_id", "url", "html", "response")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        first = skippable(DICTIONARY_MAGIC, zstandard.ZstdCompressor().compress(dictionary)) if dictionary else None
        task, number, place, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            archives, places, parts = [], [], []
            for page_id, url, html, response in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= archive_bytes:
                    number, size = number + 1, 0
                frame = encoder.compress(record(page_id, url, html.encode(), response, response is not None))
                for part in (frame,) if size or first is None else (first, frame):
                    archives.append(f"task{task}-{number}")
                    places.append(place)
                    parts.append(part)
                    place, size = place + 1, size + len(part)
            columns = [pa.array(archives, pa.string()), pa.array(places, pa.int64()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["archive", "place", "frame"])

    ordered = rows.mapInArrow(run, "archive string, place long, frame binary").sortWithinPartitions("archive", "place")
    as_text = ordered.select("archive", F.col("frame").cast("string").alias("value"))
    as_text.write.partitionBy("archive").option("lineSep", EMPTY_SKIPPABLE).option("compression", "none").text(path)


PARSED = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder; a revisit has no payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for data in frames(content.as_py()):
                    held.append(parse(data))
                    size += len(data)
                    if size > 1 << 24:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    return files.mapInArrow(run, PARSED)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]))


def round_trip(pages: DataFrame) -> DataFrame:
    path = new_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path).drop("url", "payload")
