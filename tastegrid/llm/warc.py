"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each task writes archives of about ``archive_bytes``: a dictionary is trained on the archive's records and put
in front of them in a skippable frame, then every record is a frame of its own that any reader of the format can
seek to. Of the records with equal payloads the one with the largest page_id is a ``response``; the others are
``revisit`` records that refer to it and carry only the HTTP header.

Files are named after the task attempt that wrote them and listed in the table that the writer returns, so what a
lost or repeated attempt left behind is never read. The folder must be one that all executors reach.

Nulls, ties and odd rows: a null page is an empty payload; a null url leaves the target header out; empty payloads
are equal to each other; of repeated rows with the largest page_id exactly one is the response and the others refer
to that page_id; a null page_id is smaller than any other; an empty table writes nothing.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import partial
from io import BytesIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.session import ensure_checkpoint_dir, settle

#: Bytes of records in one archive, of dictionary samples and of the dictionary; compression level.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 16 << 20, 2 << 20, 64 << 10, 3

# fixed values: frame marks of the format, the profile of a revisit, names of headers
SKIPPABLE, ZSTD_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN, DATE = "urn:x-page:", "2000-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    """The payload digest as WARC files write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    digits = urn.strip("<>").removeprefix(PAGE_URN)
    return int(digits) if digits else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record: WARC header, HTTP header and, for a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes], level: int = LEVEL, size: int = DICTIONARY_BYTES) -> Iterator[bytes]:
    """The parts of an archive: the dictionary in its skippable frame, then a frame per record."""
    import zstandard

    dictionary = _dictionary(records, size)
    if dictionary is not None:
        body = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        yield SKIPPABLE.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    for record in records:
        yield compressor.compress(record)


def _dictionary(records: list[bytes], size: int):
    """Trained on records spread over the archive; raw bytes of records where there are too few to train on."""
    import zstandard

    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 16] for r in records[::step]]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples)
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(r[: size // 8] for r in records[:8])
        return zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an open binary file."""
    import zstandard

    head, dictionary = source.read(8), None
    if len(head) == 8 and int.from_bytes(head[:4], "little") == SKIPPABLE:
        body = source.read(int.from_bytes(head[4:], "little"))
        if body.startswith(ZSTD_MAGIC):
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    else:
        source = BytesIO(head + source.read())
    with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True) as stream:
        yield from _records(stream)


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    waiting = bytearray()

    def fill(n: int) -> bool:
        while len(waiting) < n:
            more = stream.read(1 << 16)
            if not more:
                return False
            waiting.extend(more)
        return True

    while fill(4):
        while (end := waiting.find(b"\r\n\r\n")) < 0:
            if not fill(len(waiting) + 1):
                raise ValueError("a record ends inside its header")
        lines = bytes(waiting[:end]).decode("utf-8", "surrogatepass").split("\r\n")
        del waiting[: end + 4]
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if not fill(size + 4):
            raise ValueError("a record ends inside its block")
        block = bytes(waiting[:size])
        del waiting[: size + 4]
        yield headers, block


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _write(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    name = f"{context.partitionId():06d}-{context.taskAttemptId()}" if context else "000000-0"
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    records: list[bytes] = []
    held, made = 0, 0

    def close() -> pa.RecordBatch:
        path, size = f"{root}/pages-{name}-{made:05d}.warc.zst", 0
        with store.open_output_stream(path, compression=None) as out:
            for part in archive_bytes(records):
                out.write(part)
                size += len(part)
        row = [f"{folder}/{path.rsplit('/', 1)[1]}"], [len(records)], [held], [size]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["path", "records", "raw_bytes", "archive_bytes"])

    for batch in batches:
        for page_id, url, html, digest, kind, refers_to in zip(*(batch.column(k) for k in range(6))):
            payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
            sha = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
            records.append(record_bytes(page_id.as_py(), url.as_py(), payload, sha, kind.as_py(), refers_to.as_py()))
            held += len(records[-1])
            if held >= limit:
                yield close()
                records, held, made = [], 0, made + 1
    if records:
        yield close()


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, record_type, refers_to. Pages meet their group's largest page_id by narrow rows only."""
    html = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html).alias("digest"))
    # a plain key, so that numbering repeated rows and the join share one shuffle of the pages
    rows = rows.withColumn("_key", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    top = rows.groupBy("digest").agg(F.max("page_id").alias("_top"))
    decided = rows.groupBy("_key", "digest").agg(F.lit(1).alias("_one")).join(top, "digest").select("_key", "digest", "_top")
    copy = F.row_number().over(Window.partitionBy("_key", "digest").orderBy("url"))
    first = F.col("page_id").eqNullSafe(F.col("_top")) & (F.col("_copy") == 1)
    return rows.withColumn("_copy", copy).join(decided, ["_key", "digest"]).select(
        "page_id", "url", "html", "digest",
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("_top")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html); returns path, records, raw_bytes, archive_bytes per archive."""
    if folder is None:
        folder = f"{ensure_checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    rows = with_record_types(pages).sortWithinPartitions("page_id")
    schema = "path string, records bigint, raw_bytes bigint, archive_bytes bigint"
    return settle(rows.mapInArrow(partial(_write, folder=folder, limit=archive_bytes), schema))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "html"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = _store(path)
            rows: list[tuple] = []
            held = 0
            with store.open_input_stream(at, compression=None) as source:
                for headers, block in read_archive(source):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"{path}: the payload of {headers['WARC-Record-ID']} is damaged")
                    rows.append(
                        (
                            _page(headers["WARC-Record-ID"]), size, digest, kind,
                            _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
                            headers.get("WARC-Target-URI"), payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
                        )
                    )
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, html from a table with ``path``.

    Payloads of responses are checked against their digest.
    """
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, html string"
    return archives.select("path").mapInArrow(_read, schema)
