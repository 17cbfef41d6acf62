"""WARC archives with dictionary-compressed records.

Each writing task makes archives of at most about `archive_bytes` of payload. A Zstandard dictionary is built from (the first
`sample_bytes` of) the archive's own records, stands in a leading skippable frame (magic 0x184D2A5D), and every record is a
frame of its own, compressed with it, so that records can be read one by one. Of records with equal payloads of at least
`min_revisit` bytes the one with the largest id is the response and the others are revisits, which hold no payload.

A record's id is made from the page's id, digest and a number for its row, so that ids are unique and a revisit can name its
response; a response's block is an HTTP message around the payload.

Archives are written under a name of their own attempt in a shared folder; what counts is the list of archives that the
successful tasks returned, so repeated or lost attempts leave nothing in the result. Reading goes through Spark's binary files of
the whole folder, joined with that list.

Defined results: null is an empty payload; rows with equal id and payload are all the response; a null id is a page like
others, and comes before all ids; an empty table writes no archive and reads back an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import uuid
from datetime import datetime, timezone

import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, read_table, scratch_path, stored, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = 0x184D2A5D
MIN_REVISIT, ARCHIVE_BYTES, SAMPLE_BYTES, DICT_BYTES = 1000, 32 << 20, 2 << 20, 64 << 10
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


#: What stands around a response's payload.
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_id(page_id: int | None, digest: str, number: int = 0) -> str:
    """The same for the same page and payload; number tells rows that repeat both apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}:{number}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, digest: str | None = None, number: int = 0, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record."""
    digest = digest or hashlib.sha1(payload).hexdigest()
    body = b"" if revisit else HTTP % len(payload) + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest, number)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def dictionary(records: list[bytes], sample_bytes: int = SAMPLE_BYTES, dict_bytes: int = DICT_BYTES) -> bytes:
    """A trained dictionary, or the plain beginning of the records where there are too few to train on."""
    sample, held = [], 0
    for r in records:
        if held >= sample_bytes:
            break
        sample.append(r[: 128 << 10])
        held += len(sample[-1])
    if len(sample) >= 16 and held >= 10 * 1024:
        try:
            return zstandard.train_dictionary(min(dict_bytes, max(1024, held // 8)), sample, k=512, d=8).as_bytes()
        except zstandard.ZstdError:  # too little in common
            pass
    return b"".join(sample)[:dict_bytes]


def archive(records: list[bytes], level: int = 6) -> bytes:
    raw = dictionary(records)
    held = zstandard.ZstdCompressor(level=9).compress(raw)
    packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    return b"".join([struct.pack("<II", MAGIC, len(held)), held, *(packer.compress(r) for r in records)])


def records_of(data: bytes):
    """The records of an archive, each decompressed alone."""
    magic, n = struct.unpack_from("<II", data)
    if magic != MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    raw = zstandard.ZstdDecompressor().decompress(data[8 : 8 + n])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at = 8 + n
    view = memoryview(data)
    while at < len(data):
        one = reader.decompressobj()
        parts = []
        while not one.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            parts.append(one.decompress(view[at : at + (1 << 16)]))
            at += min(1 << 16, len(data) - at)
        at -= len(one.unused_data)
        yield b"".join(parts)


def parsed(raw: bytes) -> dict:
    """A record's headers as the row of RECORD, with url and payload; lengths and digests are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    h = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(h["Content-Length"])]
    revisit, page = h["WARC-Type"] == "revisit", None
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit:
        page = body.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(page).hexdigest() != digest or rest[len(body) :] != b"\r\n\r\n":
            raise ValueError(f"record {h['WARC-Record-ID']} is damaged")

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    return {"page_id": number(h["X-Page-ID"]), "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": number(h.get("X-Refers-To-Page")), "url": h["WARC-Target-URI"], "payload": page}


def payload(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def with_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """pages with the added columns _refers_to and _revisit."""
    pages = without(pages, "_bytes", "_key", "_last", "_n", "_refers_to", "_revisit")
    keyed = pages.select("*", F.octet_length(payload(html)).cast("long").alias("_bytes"), F.sha2(payload(html), 256).alias("_key"))
    large = keyed.where(F.col("_bytes") >= min_revisit).groupBy("_key").agg(F.max(page_id).alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    found = lookup(keyed, stored(large, "warc-equal"), "_key", "_n")
    revisit = F.col("_last").isNotNull() & (F.col(page_id).isNull() | (F.col(page_id) < F.col("_last")))
    return found.select(*pages.columns, F.when(revisit, F.col("_last")).alias("_refers_to"), revisit.alias("_revisit"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes pages (with _refers_to, _revisit) as archives in folder, which all executors share; returns path, n_records of each
    archive, stored. All records have the time of this call as their date."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)

        def put(records: list[bytes]) -> "pd.DataFrame":
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{name}.part") as out:
                out.write(archive(records))
            store.move(f"{name}.part", name)
            return pd.DataFrame({"path": [f"{folder}/{name.rpartition('/')[2]}"], "n_records": [len(records)]})

        held, size = [], 0
        for p in batches:
            for i, u, h, to, again, row in zip(p["i"], p["u"], p["h"], p["to"], p["again"], p["row"], strict=True):
                body = b"" if h is None else bytes(h)
                # a repeated row would repeat its id; small responses and revisits count by row, responses that are referred to do not
                number = 0 if not again and len(body) >= MIN_REVISIT else int(row) + 1
                one = record(None if pd.isna(i) else int(i), u, body, None if pd.isna(to) else int(to), bool(again), number=number, date=date)
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield put(held)
                    held, size = [], 0
        if held:
            yield put(held)

    rows = pages.select(F.col(page_id).cast("long").alias("i"), F.col(url).alias("u"), payload(html).alias("h"), F.col("_refers_to").cast("long").alias("to"), F.col("_revisit").alias("again"), F.monotonically_increasing_id().alias("row"))
    return stored(rows.mapInPandas(run, "path string, n_records bigint"), "warc-list")


def read(spark: SparkSession, folder: str, archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives in folder that `archives` (path) lists: RECORD, and with payloads also url and payload. The folder
    is read as one, so that the driver holds no list of archives of its own."""
    schema = RECORD + (", url string, payload binary" if payloads else "")
    if not archives.limit(1).count():
        return spark.createDataFrame([], schema)
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column("content"):
                rows: list[dict] = []
                for one in records_of(raw.as_py()):
                    row = parsed(one)
                    rows.append({k: row[k] for k in names})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    import pyarrow as pa

    of = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(x.split(" ")[0], of[x.split(" ")[1]]) for x in schema.split(", ")])
    listed = archives.select(F.substring_index("path", "/", -1).alias("name")).distinct()
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = found.select(F.substring_index("path", "/", -1).alias("name"), "content")
    names_of = listed.withColumn("n", F.lit(1))
    return lookup(files, names_of, "name", "n", "left_semi").select("content").mapInArrow(run, schema)


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    return read(spark, folder, write(with_revisits(pages), folder))


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), q AS (
  SELECT page_id, octet_length(payload)::BIGINT AS n, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS last FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM q
"""
