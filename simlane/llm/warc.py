"""WARC archives in Zstandard: one frame a record, the dictionary in a skippable frame at the start."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simlane.llm.common import pick, shared_dir, staged

DICTIONARY_FRAME, FRAME = 0x184D2A5D, 0xFD2FB528
#: Bytes of records in an archive after which the next one begins; a reader holds one archive in memory.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on at most so many pages, chosen by hash, of at most so many characters each.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 512, 65536, 32768
#: Repeated payloads up to which their table (a digest and an id each) is broadcast: under 10 MB.
BROADCAST_ROWS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "file string, position long, record_type string, page_id long, target_uri string, refers_to long, payload_digest string, payload_bytes long, payload binary, error string"


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, kind: str, refers_to: int | None, date: str, place: str = "") -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone; that header has the payload's length. A page
    without an id is named by the record's place instead."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{f':{place}' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest32(bytes.fromhex(sha1_hex))}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; ValueError where header, lengths or digest don't hold."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    named = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a name: {line[:40]!r}")
        named[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in named:
            raise ValueError(f"no {name}")
    length = int(named["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, block of {len(rest) - 4}")
    out = {"record_type": named["warc-type"], "page_id": _number(named["warc-record-id"]), "target_uri": named.get("warc-target-uri"), "refers_to": None, "payload": None, "payload_bytes": None, "payload_digest": None}
    if out["record_type"] not in ("response", "revisit"):
        return out | {"payload": rest[:length], "payload_bytes": length}
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/1."):
        raise ValueError("no HTTP header")
    sizes = [x.partition(b":")[2] for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    size = int(sizes[0]) if sizes else len(payload)
    algorithm, _, digest = named.get("warc-payload-digest", "").partition(":")
    if algorithm.lower() != "sha1":
        raise ValueError("no SHA-1 payload digest")
    out |= {"payload_bytes": size, "payload_digest": digest}
    if out["record_type"] == "response":
        if len(payload) != size:
            raise ValueError(f"payload of {len(payload)}, its header says {size}")
        if digest32(hashlib.sha1(payload).digest()) != digest:
            raise ValueError("payload digest differs")
        out["payload"] = payload
    else:
        if payload or "warc-refers-to" not in named:
            raise ValueError("revisit with a payload or without its response")
        out["refers_to"] = _number(named["warc-refers-to"])
    return out


def _number(uri: str) -> int | None:
    if not (uri.startswith("<urn:page:") and uri.endswith(">")):
        raise ValueError(f"unknown record id {uri[:60]}")
    number = uri[10:-1].partition(":")[0]
    return int(number) if number else None


def records(data: bytes) -> Iterator[tuple[int, dict | None, str | None]]:
    """(position, record, error) of each frame of an archive. A frame that can't be decoded ends the archive."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        raw, at = data[8 : 8 + size], 8 + size
        if len(raw) < size:
            yield 0, None, "dictionary cut off"
            return
        if raw[:4] == struct.pack("<I", FRAME):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        start, frame, parts = at, reader.decompressobj(), []
        try:
            while not frame.eof:
                if at >= len(data):
                    raise ValueError("frame cut off")
                some = data[at : at + 8192]
                parts.append(frame.decompress(some))
                at += len(some)
            at -= len(frame.unused_data)
        except (zstandard.ZstdError, ValueError) as e:
            yield start, None, f"frame: {e}"
            return
        try:
            yield start, parse(b"".join(parts)), None
        except ValueError as e:
            yield start, None, str(e)


def train(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; empty where they are too few or too short."""
    fit = pick(pages, "page_id", "url", "html").where(F.length("html").between(1, SAMPLE_CHARS))
    ids = fit.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES)
    some = fit.join(F.broadcast(ids), "page_id").dropDuplicates(["page_id"]).collect()
    some.sort(key=lambda r: r["page_id"])
    samples = []
    for r in some:
        payload = r["html"].encode("utf-8", "surrogatepass")
        samples.append(record(r["page_id"], r["url"], payload, hashlib.sha1(payload).hexdigest(), "response", None, "2024-01-01T00:00:00Z"))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def classify(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html (null: empty), sha1 (hex), record_type and refers_to. Of pages with equal payloads of `least`
    bytes or more that with the smallest page_id is the response (rows that repeat it too) and the others revisit it;
    null ids come last. Only payloads that occur more than once are joined; their table is written, counted and broadcast
    if it is small, so that pages needn't be shuffled."""
    p = pick(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    p = p.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    repeated = p.where(F.octet_length("html") >= least).groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("sha1", "first_id", F.lit(True).alias("hit"))
    repeated = staged(repeated)
    joined = p.join(F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated, "sha1", "left")
    again = F.col("hit").isNotNull() & (F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "html", "sha1", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"))


def write(pages: DataFrame, folder: str, least: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Writes one record a page into archives under folder, a URI that driver and executors share, and returns file,
    records and bytes of each. A task writes its archives under a hidden name and moves them when they are whole; its
    rows are sorted, so a task that runs again writes the same files."""
    dictionary = train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        t = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        how = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)
        out, name, done, n, count = None, "", [], 0, 0

        def close() -> None:
            out.close()
            # the name tells how many records there are, so that the reader knows if some are lost
            whole = f"{name}-n{count}.warc.zst"
            store.move(f"{base}/.{name}.{t.taskAttemptId()}", f"{base}/{whole}")
            done.append((f"{folder}/{whole}", count, n))

        for b in batches:
            for i in range(b.num_rows):
                r = {c: b[c][i].as_py() for c in b.schema.names}
                if out is None:
                    name, n, count = f"part-{t.partitionId():05d}-{len(done):05d}", 0, 0
                    out = store.open_output_stream(f"{base}/.{name}.{t.taskAttemptId()}", compression=None)
                    if dictionary:
                        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
                        n += out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
                frame = how.compress(record(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["sha1"], r["record_type"], r["refers_to"], date, f"{t.partitionId()}-{len(done)}-{count}"))
                out.write(frame)
                n, count = n + len(frame), count + 1
                if n >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict({"file": [d[0] for d in done], "records": [d[1] for d in done], "bytes": [d[2] for d in done]})

    rows = classify(pages, least).sortWithinPartitions("page_id", "sha1", "url")
    return staged(rows.mapInArrow(run, "file string, records long, bytes long"))


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder, with READ's columns; error says why one isn't valid and is null
    otherwise. An archive with fewer or more records than its name tells (-n<records>) gives one more row with an error.
    Spark's file reader opens the archives, so any store it reaches will do."""
    schema = pa.schema([("file", pa.string()), ("position", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                file, rows, size, found = b["path"][i].as_py(), [], 0, 0
                for position, r, error in records(b["content"][i].as_py()):
                    r = (r or {}) | {"file": file, "position": position, "error": error}
                    size += len(r.get("payload") or b"")
                    found += 1
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    if len(rows) >= 4096 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                told = re.search(r"-n(\d+)\.warc\.zst$", file)
                if told and int(told[1]) != found:
                    rows.append({"file": file, "position": len(b["content"][i].as_py()), "error": f"{found} records, {told[1]} were written"})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content").mapInArrow(run, READ)


def valid(rows: DataFrame) -> DataFrame:
    """The rows; computing any of their columns fails, with the record's place, where one is not valid."""
    bad = F.concat_ws(": ", F.lit("WARC record not valid"), F.concat(F.col("file"), F.lit("@"), F.col("position").cast("string")), F.col("error"))
    return rows.where(F.when(F.col("error").isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.lit(True)))


def check_written(spark: SparkSession, folder: str, written: DataFrame) -> None:
    """Fails unless the folder holds the archives that were written, no others, each of its size; contents aren't read."""
    name = F.element_at(F.split(F.col("path"), "/"), -1).alias("name")
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(name, F.col("length").alias("there"))
    told = written.select(F.element_at(F.split("file", "/"), -1).alias("name"), F.col("bytes").alias("told"))
    odd = told.join(there, "name", "full").where(~F.col("told").eqNullSafe(F.col("there"))).limit(1).collect()
    if odd:
        raise OSError(f"archive {odd[0]['name']}: {odd[0]['told']} bytes written, {odd[0]['there']} found")


def archived(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Writes the pages (page_id, url, html) to archives, reads them back and returns page_id, payload_bytes,
    payload_digest (bare base 32 SHA-1), record_type and refers_to of each record.

    A null html is an empty payload; a null url leaves its header out, line breaks in one are percent-encoded; null ids are written as the record's place and
    read as null; repeated rows are repeated records with equal record ids; other columns are ignored; an empty table writes no archive. The archives
    stay in the folder, by default a new one beside the checkpoints; the result reads them whenever it is computed.
    Archives that are lost or cut off, and records that are, end the query with an error."""
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    written = write(pages, folder, least)
    if not written.take(1):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    check_written(spark, folder, written)
    rows = valid(read(spark, folder, payloads=False))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT p.page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(p.h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN p.page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN f ON p.h = f.h"""
