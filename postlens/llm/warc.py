"""WARC archives compressed record by record with a dictionary of their own.

An archive starts with a skippable frame that holds a Zstandard dictionary built from records
of that archive; then every record is one Zstandard frame. Archives are written and read by
the tasks through pyarrow's file systems, so that the folder can be any store it knows.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import read_table, staged, work_folder

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 4 * 1024 * 1024
ARCHIVE_BYTES = 512 * 1024 * 1024
MIN_REVISIT_BYTES = 100

RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"\Afile:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def _value(text: str) -> str:
    """A header value on one line."""
    return re.sub(r"[%\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def _unvalue(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m.group(1), 16)), text)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    digits = urn[len("<urn:page:"):-1]
    return int(digits) if digits else None


def encode_record(row: dict, date: str) -> bytes:
    """A response with its payload, or a revisit that names the response instead."""
    revisit = row["record_type"] == "revisit"
    block = HTTP_HEAD if revisit else HTTP_HEAD + row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_urn(row['page_id'])}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_value(row['url'])}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b"WARC/1.1\r\n"


class ArchiveWriter:
    """One archive. Records are held back until the dictionary's sample is full."""

    def __init__(self, folder: str, name: str, date: str):
        self.uri, self.date = f"{folder}/{name}", date
        self.system, self.path = _open(self.uri)
        self.held: list[bytes] = []
        self.bytes = self.records = 0
        self.out = self.compressor = None

    def add(self, row: dict) -> None:
        record = encode_record(row, self.date)
        self.bytes += len(record)
        self.records += 1
        if self.out is None:
            self.held.append(record)
            if self.bytes >= SAMPLE_BYTES:
                self._start()
        else:
            self.out.write(self.compressor.compress(record))

    def _start(self) -> None:
        dictionary = build_dictionary([r[: 64 * 1024] for r in self.held])
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.system.open_output_stream(f"{self.path}.open", compression=None)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for record in self.held:
            self.out.write(self.compressor.compress(record))
        self.held = []

    def close(self) -> dict:
        if self.out is None:
            self._start()
        self.out.close()
        self.system.move(f"{self.path}.open", self.path)
        return {"archive": self.uri, "records": self.records}


def write_archives(rows: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write rows of ``RECORD_SCHEMA`` as archives; returns ``[archive, records]``.

    The list of archives is a committed table. A task that is run again writes archives under
    new names, and only those of the attempt that counts are listed, so no record is listed
    twice or lost; files of other attempts are left behind unlisted.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, writer, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).to_dict("records"):
                if writer is None:
                    writer = ArchiveWriter(folder, f"part-{part:05d}-{len(done):04d}-{uuid.uuid4().hex}.warc.zst", date)
                row["payload"] = bytes(row["payload"])
                for name in ("page_id", "refers_to", "payload_bytes"):
                    row[name] = None if row[name] is None else int(row[name])
                writer.add(row)
                if writer.bytes >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pd.DataFrame(done)

    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    exact = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return staged(exact.mapInPandas(write, "archive string, records long"), "warc-list")


def read_archive(uri: str) -> Iterator[dict]:
    """The records of one archive, in order; raises if a payload does not have its digest."""
    system, path = _open(uri)
    with system.open_input_stream(path, compression=None) as raw:
        magic, size = struct.unpack("<II", raw.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{uri} does not start with a dictionary")
        dictionary = zstandard.ZstdCompressionDict(raw.read(size))
        frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(raw, read_across_frames=True)
        text = io.BufferedReader(frames, 1 << 20)
        while line := text.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"{uri} holds {line[:40]!r} where a record should start")
            head = {}
            while (line := text.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                head[name] = value
            block = text.read(int(head["Content-Length"]))
            text.read(4)
            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
            payload = block[len(HTTP_HEAD):]
            revisit = head["WARC-Type"] == "revisit"
            if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{uri}: payload of {head['WARC-Record-ID']} is damaged")
            yield {
                "page_id": _page_of(head["WARC-Record-ID"]),
                "url": _unvalue(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
                "record_type": head["WARC-Type"],
                "refers_to": _page_of(head["WARC-Refers-To"]) if revisit else None,
                "payload_digest": digest,
                "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(payload),
                "payload": None if revisit else payload,
            }


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of the listed archives, in tasks of one archive or more each."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["archive"]:
                held, size = [], 0
                for record in read_archive(uri):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if size >= 8 << 20 or len(held) >= 5000:
                        yield _frame(held)
                        held, size = [], 0
                if held:
                    yield _frame(held)

    spark = archives.sparkSession
    dealt = archives.repartition(max(2, spark.sparkContext.defaultParallelism), F.xxhash64("archive"))
    return dealt.mapInPandas(read, RECORD_SCHEMA)


def _frame(records: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(records)
    for name in ("page_id", "refers_to", "payload_bytes"):
        frame[name] = pd.array([r[name] for r in records], dtype="Int64")
    return frame


def page_records(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows of ``RECORD_SCHEMA`` for a table with page_id, url and html.

    The payload is the html in UTF-8, empty if null. Of rows with equal payloads of at least
    ``min_revisit`` bytes those with the smallest page_id are responses (all of them, if that
    row is repeated; null ids count as greatest) and the others revisit it.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    first = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("payload_digest").alias("first_digest"), "first_id")
    )
    joined = rows.join(first, rows["payload_digest"] == first["first_digest"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        "payload_digest", "payload_bytes", "payload",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back, and describe each record that came back."""
    rows = page_records(read_table(spark, sf_dir, "pages"))
    archives = write_archives(rows, work_folder(spark, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM rows WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM rows LEFT JOIN first USING (payload_digest)"""

QUERIES = {"op10_warc": op10_warc}
ORACLES = {"op10_warc": OP10_SQL}
