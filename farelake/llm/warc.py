"""WARC archives compressed record by record with a Zstandard dictionary.

Method: a dictionary is built from a bounded sample of the records to archive. Every archive begins with a skippable
frame that holds it; each record follows as a frame of its own, so one record can be read without the others. Records
whose payload is archived elsewhere become revisits.

Archives are written by the tasks into a shared folder under names that no other attempt uses; a table of the files of
successful tasks says which ones count. A task that is lost leaves at most a file that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import scratch_dir
from .common import bounded_sample, stored

DICTIONARY_FRAME = 0x184D2A5D  # fixed value: skippable frame of a dictionary in front of an archive
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
ID_PREFIX = "urn:x-page:"
RECORD_SCHEMA = (
    "record_id string, page_id long, uri string, record_type string, payload_digest string, payload_bytes long,"
    " refers_to long, payload binary"
)


def open_folder(folder: str):
    """File system and path of a folder given as a path or URI (the Hadoop name of an object store is translated)."""
    import pyarrow.fs

    at = folder.replace("s3a://", "s3://", 1)
    return pyarrow.fs.FileSystem.from_uri(at)


def record_bytes(page_id: int | None, uri: str | None, html: str | None, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: an HTTP response, or a revisit that keeps the HTTP header and drops the payload."""
    payload = (html or "").encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = str(page_id) if page_id is not None else f"none:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {digest}')}"
    target = "".join(c if c.isprintable() and c != " " else "%" + c.encode().hex() for c in uri or f"{ID_PREFIX}{name}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID_PREFIX}{name}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict | None:
    """Fields of a response or revisit record; None for other kinds. A payload that misses its digest is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: (lambda x: int(x) if x.lstrip("-").isdigit() else None)(fields.get(name, "")[1:-1].removeprefix(ID_PREFIX))
    return {
        "record_id": fields["WARC-Record-ID"][1:-1], "page_id": number("WARC-Record-ID"), "uri": fields["WARC-Target-URI"],
        "record_type": kind, "payload_digest": digest, "payload_bytes": length, "refers_to": number("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Records of an archive, one frame after another; memory holds one record and one chunk."""
    import zstandard

    left = stream.read(8)
    book = None
    if len(left) == 8 and struct.unpack("<I", left[:4])[0] == DICTIONARY_FRAME:
        book = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", left[4:])[0]))
        left = b""
    reader = zstandard.ZstdDecompressor(dict_data=book)
    while left := left or stream.read(chunk):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not (left := left or stream.read(chunk)):
                raise ValueError("archive ends within a record")
            parts.append(frame.decompress(left))
            left = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def mark_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, revisit, refers_to: of equal payloads the largest page_id is the response.

    Rows that repeat the largest page_id are all responses; a NULL page_id is a response only where no other has its
    payload. Pages meet their group by a join on its digest, so a payload shared by very many pages is split.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # written, so that both sides of the join are plain shuffles, which Spark splits where a payload is common
    largest = stored(rows.select("page_id", "digest").groupBy("digest").agg(F.max("page_id").alias("last_id")), "payloads")
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return rows.join(largest, "digest").select(
        "page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("last_id")).alias("refers_to")
    )


def build_dictionary(pages: DataFrame, date: str, records: int = 512, record_bytes_used: int = 16 << 10, size: int = 64 << 10) -> bytes:
    """Dictionary from records of at most ``records`` pages (first by a hash of the id), ``record_bytes_used`` bytes of each.

    The sample is bounded and only shapes the dictionary. Too few or too short records give no dictionary.
    """
    import zstandard

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("html", F.substring("html", 1, record_bytes_used))
    picked = {r.html: r for r in bounded_sample(rows, records, "page_id").collect()}  # equal payloads once
    samples = [record_bytes(r.page_id, r.url, r.html, None, False, date)[:record_bytes_used] for r in picked.values()]
    held = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, held // 8)), samples, k=min(1024, max(64, held // 64)), d=8).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def write_archives(
    pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 256 << 20, level: int = 3
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as .warc.zst files into ``folder``; returns the files (path, records, bytes).

    NULL html is an empty payload, a NULL url gets a name made from the page_id. A task starts a new archive beyond
    ``archive_bytes``. An empty table gives no file. ``date`` goes to every record: pages carry no time of capture.
    """
    marked = mark_revisits(pages)
    dictionary = build_dictionary(pages, date)
    schema = to_arrow_schema(_parse_datatype_string("path string, records long, bytes long"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        book = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if book:
            book.precompute_compress(level=level)
        pack = zstandard.ZstdCompressor(level=level, dict_data=book).compress
        files, top = open_folder(folder)
        files.create_dir(top, recursive=True)
        out, done, n = None, [], 0

        def close() -> None:
            done.append((f"{folder}/{name}", n, out.tell()))
            out.close()

        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and out.tell() > archive_bytes:
                    close()
                    out = None
                if out is None:
                    name, n = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = files.open_output_stream(f"{top}/{name}", compression=None)
                    if dictionary:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                    about = b"software: farelake\r\nformat: WARC File Format 1.1\r\n"
                    head = (
                        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
                        f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n"
                    )
                    out.write(pack(head.encode() + about + b"\r\n\r\n"))
                out.write(pack(record_bytes(row["page_id"], row["url"], row["html"], row["refers_to"], row["revisit"], date)))
                n += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], f.type) for i, f in enumerate(schema)], schema=schema)

    return stored(marked.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(files: DataFrame, payloads: bool = True, chunk: int = 1 << 20) -> DataFrame:
    """Response and revisit records of archives (column ``path``), one row each; ``payloads=False`` leaves those out.

    Every response is held against its digest; damaged archives are an error.
    """
    names = [n for n in RECORD_SCHEMA.split(", ") if payloads or not n.startswith("payload binary")]
    schema = to_arrow_schema(_parse_datatype_string(", ".join(names)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, _, name = path.rpartition("/")
                files_, top = open_folder(folder)
                with files_.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for record in frames(stream, chunk):
                        if (row := parse_record(record)) is not None:
                            rows.append(row if payloads else {k: v for k, v in row.items() if k != "payload"})
                            held += len(record) if payloads else 500
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    count = files.count()
    return files.select("path").repartition(max(1, count)).mapInArrow(read, ", ".join(names))


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per input row; repeated rows, empty and NULL payloads as in ``mark_revisits``; extra columns are left out.
    """
    files = write_archives(pages, folder or scratch_dir(pages.sparkSession, "warc"))
    return read_archives(files, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
