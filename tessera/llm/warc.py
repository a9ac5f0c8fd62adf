"""Dictionary-compressed WARC archives (.warc.zst).

Each archive starts with a skippable frame holding a Zstandard dictionary that
was built from the archive's own records; every record is a frame of its own,
compressed with that dictionary. Records with a payload another record already
has are written as revisits.

Archives go into a folder every executor reaches, each under a name of its own
task attempt; the returned manifest names the archives of successful tasks, so
what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct as binary
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import required, struct
from tessera.session import scratch_path, write_table

#: Fixed values of the format: the dictionary frame's magic number and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6f2d1c5e-58f5-4f43-9d2b-6a1b0a5f6f10")

RECORDS = {"page_id": "long", "url": "string", "payload": "binary", "sha": "string", "record_type": "string", "refers_to": "long"}


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Payload, digest and record type of each page.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the
    smallest page_id are responses and the others revisit it. Rows without a
    page_id revisit a payload that a row with one has, and are responses
    otherwise. Null html is an empty payload. Payload groups are found by a
    partial aggregate of digests, so a payload that very many pages share
    costs one row per task.
    """
    pages = required(pages, {"page_id": "long", "url": "string", "html": "string"})
    pages = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("sha", F.sha1("payload"))
    first = (pages.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return pages.join(first, "sha", "left").select(
        "page_id", "url", "payload", "sha", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def record_id(page_id: int | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {sha}')}>"


def record(page: dict, date: str) -> bytes:
    """One WARC record."""
    digest = base64.b32encode(bytes.fromhex(page["sha"])).decode()
    head = [("WARC-Type", page["record_type"]), ("WARC-Record-ID", record_id(page["page_id"], page["sha"])),
            ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http;msgtype=response")]
    if page["url"] is not None:
        head.append(("WARC-Target-URI", page["url"].replace("\r", "%0D").replace("\n", "%0A")))
    if page["page_id"] is not None:
        head.append(("X-Page-Id", page["page_id"]))
    head.append(("X-Payload-Length", len(page["payload"])))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page['payload'])}\r\n\r\n".encode()
    if page["record_type"] == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(page["refers_to"], page["sha"])),
                 ("X-Refers-To-Page-Id", page["refers_to"])]
    else:
        block += page["payload"]
    head.append(("Content-Length", len(block)))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], level: int, dictionary_bytes: int) -> bytes:
    """An archive of the given records. Where they are too few or too short to
    build a dictionary from, the first ones themselves are the dictionary."""
    try:
        dictionary = zstandard.train_dictionary(dictionary_bytes, records, k=256, d=8, level=level)
    except zstandard.ZstdError:
        raw = b"".join(records)[:dictionary_bytes]
        dictionary = zstandard.ZstdCompressionDict(raw if len(raw) >= 8 else raw.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held = dictionary.as_bytes()
    pack = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    return b"".join([binary.pack("<II", DICTIONARY_MAGIC, len(held)), held, *map(pack.compress, records)])


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    magic, size = binary.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    with unpack.stream_reader(memoryview(data)[8 + size:], read_across_frames=True) as frames:
        stream = io.BufferedReader(frames, 1 << 20)
        while stream.readline():
            head = {}
            while line := stream.readline().rstrip(b"\r\n"):
                name, _, value = line.decode().partition(": ")
                head[name] = value
            block = stream.read(int(head["Content-Length"]))
            stream.read(4)
            yield head, block


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 16 << 20, level: int = 6,
                   dictionary_bytes: int = 64 << 10, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the rows of ``with_revisits`` as archives into ``folder`` (a URI
    or path that all executors share) and returns the manifest (archive,
    n_records, n_bytes). An archive holds up to ``archive_bytes`` of records
    before compression, or one longer record."""
    schema = struct(archive="string", n_records="long", n_bytes="long")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
        store.create_dir(root, recursive=True)
        task, number, held, size = TaskContext.get(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, size
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
            data = archive(held, level, dictionary_bytes)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)]), pa.array([len(data)])], names=schema.names)
            number, held, size = number + 1, [], 0
            return row

        for batch in batches:
            for i in range(batch.num_rows):
                one = record({n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}, date)
                if held and size + len(one) > archive_bytes:
                    yield close()
                held.append(one)
                size += len(one)
        if held:
            yield close()

    return write_table(required(records, RECORDS).mapInArrow(write, schema), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Rows (page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload) of the archives of a manifest; ``payload`` is null for
    revisits. Length and digest of a response come from its payload and are
    checked against its headers."""
    schema = struct(page_id="long", url="string", payload_bytes="long", payload_digest="string", record_type="string",
                    refers_to="long", payload="binary")

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for head, block in records_of(data.as_py()):
                    payload, n = None, int(head["X-Payload-Length"])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        if (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (n, digest):
                            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                    rows.append((number(head.get("X-Page-Id")), head.get("WARC-Target-URI"), n, digest, head["WARC-Type"],
                                 number(head.get("X-Refers-To-Page-Id")), payload))
                    size += len(block)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=arrow)

    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(f"{folder}/*.warc.zst").withColumn("archive", F.element_at(F.split("path", "/"), -1))
    return files.join(manifest.select("archive"), "archive", "left_semi").select("content").mapInArrow(read, schema)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages into archives and reads them back.

    Columns as ``read_archives``. Empty and null html are empty payloads (and
    equal to each other); repeated rows are records of their own; an empty
    table gives no archive and no rows.
    """
    folder = folder or scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex[:12]}")
    return read_archives(write_archives(with_revisits(pages), folder), folder)
