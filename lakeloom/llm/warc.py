"""WARC archives compressed with Zstandard: one frame a record, dictionary in front.

An archive starts with a skippable frame that holds the dictionary (itself a Zstandard frame);
every record is a frame of its own, so a reader holds one record at a time.  Records of equal
payloads refer to the first of them instead of storing it again.  Archives lie in the shared
folder; only those named in the manifest count, so what a lost task has left does no harm.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import located, ship, small
from lakeloom.shared import materialize, scratch_path

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: Smaller payloads are stored each time.
LEAST_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
#: Tasks at most that read archives.
READERS = 20_000
#: The dictionary is trained on so many payloads, none longer than so many bytes.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 300, 32_000, 64_000
DATE = "2000-01-01T00:00:00Z"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on a bounded sample, the different payloads first by hash; empty if
    there are too few to train on.  Only hashes are ranked; then the chosen payloads are read."""
    fit = pages.where(F.octet_length("html").between(1, SAMPLE_BYTES))
    fit = fit.select(F.xxhash64("html").alias("h"), "html")
    first = [r.h for r in fit.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    rows = (
        fit.where(F.col("h").isin(first))
        .groupBy("h")
        .agg(F.min(F.encode("html", "UTF-8")).alias("payload"))
        .orderBy("h")
        .collect()
    )
    samples = [bytes(r.payload) for r in rows]
    if len(samples) < 20:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _record(row: dict) -> bytes:
    payload = row["payload"]
    revisit = row["first"] is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(row["page_id"], row["file"], row["at"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(row["url"] or "about:blank", safe=":/?#[]@!$&'()*+,;=%~-._"),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if row["page_id"] is not None:
        headers["WARC-Page-ID"] = quote(str(row["page_id"]))
    if revisit:
        first = row["first"]
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = _urn(first["page_id"], first["file"], first["at"])
        if first["page_id"] is not None:
            headers["WARC-Refers-To-Page-ID"] = quote(str(first["page_id"]))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _urn(*of) -> str:
    digest = hashlib.sha256("|".join(map(str, of)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16])}>"


def write(pages: DataFrame, folder: str | None = None, *, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page (page_id, url, html) and return the manifest: ``path``
    and ``records`` of each archive.

    Null html is the empty payload.  Of equal payloads of at least ``LEAST_REVISIT`` bytes the
    one with the smallest page_id (null last; of repeated rows the first by place) is the
    response, the others revisit it.  An empty table gives no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.encode(F.coalesce("row.html", F.lit("")), "UTF-8")
    at = located(pages.select("page_id", "url", "html")).select(
        "row.page_id", "row.url", payload.alias("payload"), "file", "at"
    )
    at = at.withColumn("digest", F.sha2("payload", 256))
    entry = F.struct("page_id", "file", "at")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), entry.alias("entry"))
    thin = at.where(F.octet_length("payload") >= LEAST_REVISIT).select("digest", "page_id", "file", "at")
    repeated = materialize(
        thin.groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.entry").alias("first")),
        "warc-repeated",
    )
    is_first = (F.col("first.file") == F.col("file")) & (F.col("first.at") == F.col("at"))
    rows = at.join(small(repeated), "digest", "left").withColumn(
        "first", F.when(~is_first, F.col("first"))
    )
    words = dictionary(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        data = zstandard.ZstdCompressionDict(words) if words else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True)
        done, out, size, records = [], None, 0, 0
        for batch in batches:
            for row in _rows(batch):
                if out is None:
                    path = f"{base}/{stem}-{len(done):04d}.warc.zst"
                    out, size, records = store.open_output_stream(path), 0, 0
                    out.write(_leading(words))
                frame = packer.compress(_record(row))
                out.write(frame)
                size, records = size + len(frame), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())],
            ["path", "records"],
        )

    ship(spark)
    manifest = rows.mapInArrow(run, "path string, records bigint")
    return materialize(manifest.withColumn("folder", F.lit(folder)), "warc-manifest")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _leading(words: bytes) -> bytes:
    if not words:
        return b""
    frame = zstandard.ZstdCompressor(level=10).compress(words)
    return struct.pack("<II", SKIPPABLE, len(frame)) + frame


def _exactly(stream, n: int, kept: bytes) -> tuple[bytes, bytes]:
    while len(kept) < n:
        more = stream.read(max(n - len(kept), 1 << 16))
        if not more:
            raise PySparkValueError(f"the archive ends {n - len(kept)} bytes early")
        kept += more
    return kept[:n], kept[n:]


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one decoded frame each."""
    head = stream.read(1 << 16)
    if not head:
        return
    words = b""
    if len(head) >= 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        start, head = _exactly(stream, 8, head)
        words, head = _exactly(stream, struct.unpack("<I", start[4:])[0], head)
        if words[:4] == ZSTD_MAGIC:
            words = zstandard.ZstdDecompressor().decompress(words)
    data = zstandard.ZstdCompressionDict(words) if words else None
    opener = zstandard.ZstdDecompressor(dict_data=data)
    rest = head
    while rest or (rest := stream.read(1 << 16)):
        one, parts = opener.decompressobj(), []
        while True:
            parts.append(one.decompress(rest))
            if one.eof:
                rest = one.unused_data
                break
            if not (rest := stream.read(1 << 16)):
                raise PySparkValueError("the last frame is not whole")
        yield b"".join(parts)


def parse(record: bytes) -> dict:
    """Fields of a record; raises ``ValueError`` where headers, lengths or digests are wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"no header: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            raise ValueError(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as Content-Length")
    kind = headers["warc-type"]
    stated = headers.get("warc-block-digest")
    if stated and stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise ValueError("the block digest differs")
    out = {
        "record_type": kind,
        "url": headers.get("warc-target-uri"),
        "page_id": headers.get("warc-page-id"),
        "refers_to": headers.get("warc-refers-to-page-id"),
        "payload_digest": (headers.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
        "payload_bytes": None,
        "payload": None,
    }
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        sizes = [x.split(b":")[1] for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
        if len(sizes) != 1:
            raise ValueError("the HTTP header has no Content-Length")
        out["payload_bytes"] = int(sizes[0])
        if kind == "response":
            if len(payload) != out["payload_bytes"]:
                raise ValueError("the payload is not as long as its Content-Length")
            if hashlib.sha256(payload).hexdigest() != out["payload_digest"]:
                raise ValueError("the payload digest differs")
            out["payload"] = payload
    return out


FIELDS = "record_type string, url string, page_id string, refers_to string, payload_digest string, payload_bytes bigint"


def read(manifest: DataFrame, *, payload: bool = False) -> DataFrame:
    """The records of the archives of ``manifest`` (folder, path), one row each: type, url,
    page id and the page it refers to as text, digest and length of the full payload, and the
    payload itself if asked for.  ``error`` says what is wrong with a record that is not
    valid; an archive that breaks off fails the task."""
    fields = FIELDS + (", payload binary" if payload else "")
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

        def made(rows: list[dict]) -> pa.RecordBatch:
            every = [*names, "error"]
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in every], every
            )

        for batch in batches:
            for row in _rows(batch):
                store, _ = pafs.FileSystem.from_uri(row["folder"])
                rows, size = [], 0
                with store.open_input_stream(row["path"]) as stream:
                    for record in frames(stream):
                        try:
                            rows.append(parse(record))
                        except ValueError as e:
                            rows.append({"error": str(e)})
                        size += len(record) if payload else 200
                        if size > 4_000_000:
                            yield made(rows)
                            rows, size = [], 0
                yield made(rows)

    ship(manifest.sparkSession)
    # A stated number of partitions is not merged: archives are large, their rows here are not.
    count = min(max(1, manifest.count()), READERS)
    spread = manifest.repartition(count, "path")
    return spread.select("folder", "path").mapInArrow(run, fields + ", error string")
