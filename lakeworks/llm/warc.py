"""WARC archives as Zstandard files: one record per frame, the dictionary in a skippable frame in front.

Writing. Rows become records, about ``ARCHIVE_BYTES`` of payload an archive (a longer record has one
of its own). Each archive trains a dictionary on its own payloads, if they are enough for one, and
starts with it in a skippable frame. Of the rows with equal payloads of at least ``min_bytes`` bytes
the one with the largest id is a response; the others are revisits of it, without the payload.
Files are written by Spark's text sink, a file per archive, with an empty skippable frame as line end,
so the commit of the job is Spark's and any Zstandard reader takes the files.

Reading. Every file is walked frame by frame: the dictionary is loaded from the leading skippable
frame (stored as it is or compressed), other skippable frames are passed over, and each frame must
decode to one whole record. A record's version line, its named headers, the lengths and both digests
are checked; what is wrong stands in ``problem`` instead of ending the job. Files up to 2 GiB are read,
a file by one task, a record at a time.

Defined cases: a null payload is empty; a null id is written as none and read as null, and loses
against any other id; rows that share payload and the largest id are all responses; a null address has no header;
control characters and blanks of addresses are percent-encoded; an empty table makes no archive, and
reading it gives no rows; payloads of any length are records of their own. Columns not named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

ARCHIVE_BYTES = 4 << 20
DICTIONARY_BYTES = 32 << 10
# A dictionary is trained on at least so many payloads.
LEAST_SAMPLES = 16
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the file formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

_RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "payload binary, problem string")


def bare_digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(none|-?\d+)>", name)
    if not found:
        raise ValueError(f"unknown record name {name[:80]}")
    return None if found[1] == "none" else int(found[1])


def record(page_id: int | None, url: str | None, payload: bytes, response: bool, refers_to: int | None = None) -> bytes:
    """One WARC record. A revisit keeps the head of the answer, whose length is that of the payload, and not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if response else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: {_record_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if not response:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_name(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{bare_digest(payload)}", f"WARC-Block-Digest: sha1:{bare_digest(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes], samples: list[bytes]) -> bytes:
    """A whole archive: the dictionary where one can be trained, then a frame per record."""
    trained = None
    if len(samples) >= LEAST_SAMPLES:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:  # too little to learn from
            trained = None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    parts = []
    if trained is not None:
        stored = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        parts = [DICTIONARY_MAGIC, len(stored).to_bytes(4, "little"), stored]
    return b"".join(parts + [packer.compress(r) for r in records])


def _text(data: pa.Scalar) -> bytes:
    return data.as_buffer().to_pybytes() if data.is_valid else b""


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, response, refers_to`` from ``page_id, url, html``.

    Only payloads that occur more than once are looked up; a hot payload is counted in every task, and the join that
    brings its largest id back can be split.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("key"))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    largest = rows.where(long_enough).groupBy("key").agg(F.max("page_id").alias("largest"), F.count("*").alias("m")).where("m > 1").drop("m")
    found = rows.join(largest, "key", "left")
    # A null id is a revisit where any other id has the payload.
    response = F.col("largest").isNull() | (F.col("page_id").isNotNull() & (F.col("page_id") == F.col("largest")))
    return found.select("page_id", "url", "html", response.alias("response"), F.when(~response, F.col("largest")).alias("refers_to"))


def write_archives(marked: DataFrame, path: str) -> None:
    """Write ``page_id, url, html, response, refers_to`` as archives into the folder ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, samples, held = [], [], 0

        def whole() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([archive(records, samples)], pa.binary())], ["archive"])

        for batch in batches:
            ids, urls, bodies, kinds, targets = (batch.column(i) for i in range(5))
            for r in range(batch.num_rows):
                body = _text(bodies[r])
                if records and held + len(body) > ARCHIVE_BYTES:
                    yield whole()
                    records, samples, held = [], [], 0
                response = kinds[r].as_py()
                records.append(record(ids[r].as_py(), urls[r].as_py(), body, response, targets[r].as_py()))
                if response and body:
                    samples.append(body)
                held += len(body) if response else 0
                held += 512
        if records:
            yield whole()

    rows = marked.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), "response", "refers_to")
    files = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    files.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def _headers(block: bytes) -> tuple[dict[str, str], int]:
    """Fields up to the empty line, and where that ends."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("headers do not end")
    fields: dict[str, str] = {}
    for line in block[:end].decode("utf-8", "strict").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"no header: {line[:80]}")
        if name.lower() in fields:
            raise ValueError(f"repeated header {name[:80]}")
        fields[name.lower()] = value.strip()
    return fields, end + 4


def _length(fields: dict[str, str]) -> int:
    text = fields["content-length"]
    if not re.fullmatch(r"[0-9]{1,18}", text):
        raise ValueError(f"no length: {text[:80]}")
    return int(text)


def parse(data: bytes) -> tuple:
    """One record as a row of ``read_archives``. Anything that does not hold raises ValueError."""
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        raise ValueError("no WARC version line")
    fields, at = _headers(data)
    missing = [n for n in NAMED if n.lower() not in fields]
    if missing:
        raise ValueError("no header " + ", ".join(missing))
    length = _length(fields)
    if len(data) != at + length + 4 or not data.endswith(b"\r\n\r\n"):
        raise ValueError(f"Content-Length {length}, but the block has {len(data) - at - 4} bytes")
    block = data[at:at + length]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha1:" + bare_digest(block):
        raise ValueError("block digest differs")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind[:80]}")
    if "warc-payload-digest" not in fields:
        raise ValueError("no header WARC-Payload-Digest")
    answer, start = _headers(block)
    if "content-length" not in answer:
        raise ValueError("the answer has no length")
    payload, size, digest = block[start:], _length(answer), fields["warc-payload-digest"].removeprefix("sha1:")
    target = None
    if kind == "response":
        if len(payload) != size:
            raise ValueError(f"the answer's length is {size}, but the payload has {len(payload)} bytes")
        if bare_digest(payload) != digest:
            raise ValueError("payload digest differs")
    else:
        if payload or "warc-refers-to" not in fields:
            raise ValueError("a revisit has a payload or refers to nothing")
        target = _page_of(fields["warc-refers-to"])
    return _page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, target, size, digest, payload if kind == "response" else None, None


def _skippable(data: memoryview, at: int) -> int | None:
    """Where a skippable frame ends; None if another frame starts here."""
    magic = int.from_bytes(data[at:at + 4], "little")
    if not 0x184D2A50 <= magic <= 0x184D2A5F:
        return None
    end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    if at + 8 > len(data) or end > len(data):
        raise ValueError("a skippable frame is cut off")
    return end


def _frame(data: memoryview, at: int, trained: zstandard.ZstdCompressionDict | None) -> tuple[bytes, int]:
    """What the frame decodes to, and where it ends. It is fed in pieces, so no more than a piece is copied twice."""
    reader = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
    parts, piece = [], 1 << 14
    while not reader.eof:
        if at >= len(data):
            raise ValueError("a frame is cut off")
        fed = data[at:at + piece]
        parts.append(reader.decompress(fed))
        at += len(fed)
        piece = min(piece * 2, 1 << 20)
    return b"".join(parts), at - len(reader.unused_data)


def records_of(content: bytes) -> Iterator[tuple]:
    """The records of one archive. After a frame that cannot be decoded the rest of the file is unreadable: one last row says so."""
    data, at, trained = memoryview(content), 0, None
    while at < len(data):
        try:
            end = _skippable(data, at)
            if end is not None:
                if at == 0 and bytes(data[:4]) == DICTIONARY_MAGIC:
                    held = bytes(data[8:end])
                    if held[:4] == FRAME_MAGIC:
                        held = _frame(memoryview(held), 0, None)[0]
                    trained = zstandard.ZstdCompressionDict(held)
                at = end
                continue
            found, at = _frame(data, at, trained)
        except (zstandard.ZstdError, ValueError) as problem:
            yield None, None, None, None, None, None, None, f"byte {at}: {problem}"
            return
        try:
            yield parse(found)
        except (ValueError, UnicodeDecodeError) as problem:
            yield None, None, None, None, None, None, None, f"record before byte {at}: {problem}"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for every record of the archives in a folder: ``file`` and the columns of ``_RECORD``.

    Without ``payloads`` they are checked as well, but not handed on.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])
    schema = schema.insert(0, pa.field("file", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                name, held, size = batch.column(0)[r].as_py(), [], 0
                for row in records_of(batch.column(1)[r].as_py()):
                    body = row[6] if payloads else None
                    held.append((name, *row[:6], body, row[7]))
                    size += len(body or b"") + 256
                    if size > ARCHIVE_BYTES:
                        yield _batch(held, schema)
                        held, size = [], 0
                if held:
                    yield _batch(held, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, " + _RECORD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def sound(column: str = "problem") -> Column:
    """True, or an error that ends the query with the first problem."""
    return F.when(F.col(column).isNull(), F.lit(True)).otherwise(F.raise_error(F.col(column)))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
               payloads: bool = True) -> DataFrame:
    """Write the pages as archives in the shared scratch folder and read them back; a bad record is an error."""
    named = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    path = new_folder(pages.sparkSession, "archives")
    write_archives(mark_revisits(named, min_bytes), path)
    return read_archives(pages.sparkSession, path, payloads).where(sound())
