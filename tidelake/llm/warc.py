"""Web archives: written by all tasks, indexed first, read back by byte ranges.

Each task writes its rows as one gzip member per record into files of its own (one for each Arrow
batch) in a folder that all executors share, and returns the index: file, offset, length, URL and digest of each record. A
reader selects rows of the index, sorts and coalesces their byte ranges into reads of bounded size,
and parses the records from those bytes. A file of a lost task stays behind unread: the index names
only files of tasks that ended.

Of records with equal payloads of at least `least` bytes the one with the smallest page_id is a
response, the others revisit it. Null html is an empty payload; null URLs are written as
about:blank; rows without page_id are responses or revisits like others and never referred to;
rows that repeat a page_id and its payload are all responses if the first is."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, new_path, table

LEAST = 100
#: Bytes of one coalesced read, and of a gap that it reads over.
READ_BYTES, GAP = 4 << 20, 64 << 10
#: Tasks that copies of one payload are dealt to.
SALTS = 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string, refers_to long"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tidelake:page")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def _line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as WARC/1.1; the digest is hexadecimal here and Base32 in the standard field."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url or 'about:blank')}",
        f"WARC-Payload-Digest: sha256:{base64.b32encode(bytes.fromhex(digest)).decode().rstrip('=')}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; digest and size of a response come from its payload, those of a
    revisit from what it says of the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(fields[k]) if k in fields else None
    revisit = fields["WARC-Type"] == "revisit"
    said = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    digest = base64.b32decode(said + "=" * (-len(said) % 8)).hex()
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one that was written")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1]) if revisit else len(payload)
    return {"page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "payload": None if revisit else payload}


def _written(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        fs.create_dir(path, recursive=True)
        for k, batch in enumerate(batches):
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{k}.warc.gz"
            rows, offset = [], 0
            with fs.open_output_stream(f"{path}/{name}", compression=None) as out:  # whole on disk before its index goes on
                for r in batch.to_pylist():
                    raw = gzip.compress(record(r["page_id"], r["url"], (r["html"] or "").encode(), r["digest"], r["refers_to"], date), 4, mtime=0)
                    out.write(raw)
                    rows.append({"page_id": r["page_id"], "url": r["url"], "file": f"{folder}/{name}", "offset": offset, "length": len(raw), "payload_digest": r["digest"], "record_type": "response" if r["refers_to"] is None else "revisit", "refers_to": r["refers_to"]})
                    offset += len(raw)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "url", "file", "offset", "length", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return run


def write(pages: DataFrame, folder: str, least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of pages and returns the index, itself kept in the shared folder."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    # copies of one payload meet in SALTS tasks, payloads too small to be looked up in none of them
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    lookup = F.when(F.col("size") >= least, F.col("digest")).otherwise(F.concat(F.lit("small "), F.xxhash64("page_id", "url").cast("string")))
    first = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("digest").alias("lookup"), "first", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    typed = rows.select("*", lookup.alias("lookup"), salt.alias("salt")).join(first, ["lookup", "salt"], "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return cut(typed.mapInArrow(_written(folder, date), _INDEX), "index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task in batch.to_pylist():
            fs, path = pafs.FileSystem.from_uri(task["file"])
            ranges: list[list] = []
            for s in sorted(task["spans"], key=lambda s: s["offset"]):
                if ranges and s["offset"] <= ranges[-1][1] + GAP:
                    ranges[-1][1] = max(ranges[-1][1], s["offset"] + s["length"])
                    ranges[-1][2].append(s)
                else:
                    ranges.append([s["offset"], s["offset"] + s["length"], [s]])
            with fs.open_input_file(path) as source:
                for start, end, spans in ranges:
                    raw = source.read_at(end - start, start)
                    rows = [parse(gzip.GzipFile(fileobj=io.BytesIO(raw[s["offset"] - start : s["offset"] - start + s["length"]])).read()) for s in spans]
                    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def read(index: DataFrame) -> DataFrame:
    """The records that the rows of an index name: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits)."""
    place = F.struct("offset", "length")
    reads = index.groupBy("file", F.floor(F.col("offset") / READ_BYTES).alias("part")).agg(F.collect_list(place).alias("spans"))
    size = index.agg(F.sum("length")).first()[0] or 0
    dealt = reads.select("file", "spans").repartition(max(1, -(-size // READ_BYTES)))  # by bytes to read, not by bytes of the index
    return dealt.mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records, written and read back."""
    index = write(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return read(index).drop("payload", "url")
