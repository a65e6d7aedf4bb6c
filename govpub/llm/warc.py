"""WARC archives: a gzip normaliser, and what is needed to write and read archives with it.

An archive that was compressed as one gzip stream cannot be read from the middle. The normaliser inflates such a stream once, in
chunks, finds the records by their headers, writes every record as a gzip member of its own and, beside
the new archive, a sidecar index (one JSON line per record: offset, length, id, type). Afterwards any record
is one ranged read. Memory is one chunk and one header, however long the records are. Files that already
consist of members, wholly or in part, are normalised just the same.

Archives are written by Spark tasks: each task streams its records into archives of about `ROLL` bytes. Equal payloads
of `REVISIT_FROM` bytes or more are stored once: the record with the smallest page id is the response, the others
are revisits that refer to it.

Defined results: a null html is an empty payload; a null url has an empty target; rows that share the smallest page id of a
payload are all responses; ill-formed UTF-8 of a url is replaced by U+FFFD; a row without a page id is a revisit if any row with an id has its payload, else a response; no pages
give no archives; extra columns are not read. Control characters of a url are percent-encoded.

Recovery: a task attempt writes under a name of its own and reports it in its rows; the rows are a written table, so only
archives of finished tasks count and a lost executor costs its own tasks. Files are opened through pyarrow's file
systems by URI (file, hdfs, s3, gs), always in the folder that the session shares.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, new_folder, staged, valid

#: Payload bytes from which equal payloads are stored once; bytes of an archive before the next one begins.
REVISIT_FROM, ROLL = 100, 64 << 20
CHUNK, LEVEL = 1 << 20, 4
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_file(path: str, mode: str):
    """A file of any file system that pyarrow knows, by URI or absolute path."""
    system, name = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(name.rpartition("/")[0], recursive=True)
        return system.open_output_stream(name, compression=None)
    return system.open_input_file(name) if mode == "seek" else system.open_input_stream(name, compression=None)


# --- one record ------------------------------------------------------------------------

def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit if it refers to another page."""
    revisit = refers_to is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        body += payload
    target = quote(url or "", safe="".join(map(chr, range(33, 127))))
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name(page_id)}>",
            f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{name(refers_to)}>"] if revisit else []),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def name(page_id) -> str:
    return "" if page_id is None else quote(str(page_id), safe="")


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


# --- normaliser ------------------------------------------------------------------------

def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a gzip file, whether it is one stream or many members."""
    machine = None
    while data := stream.read(chunk):
        while data:
            if machine is None:
                data = data.lstrip(b"\0")  # padding after a member
                if not data:
                    break
                machine = zlib.decompressobj(31)
            if out := machine.decompress(data):
                yield out
            data = machine.unused_data
            if machine.eof:
                machine = None
    if machine is not None:
        raise ValueError("an archive ends inside a gzip member")


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """('head', header bytes), then ('body', bytes)*, per record; bodies include the two line ends that close it."""
    held = bytearray()
    for piece in chunks:
        held += piece
        while True:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            head = bytes(held[: end + 4])
            left = int(fields(head)["content-length"]) + 4
            del held[: end + 4]
            yield "head", head
            while left:
                if not held:
                    held += next(chunks, b"")
                    if not held:
                        raise ValueError("an archive ends inside a record")
                    continue
                part = bytes(held[:left])
                del held[: len(part)]
                left -= len(part)
                yield "body", part
    if held.strip(b"\r\n"):
        raise ValueError("an archive ends inside a header")


def normalise(source: str, target: str, chunk: int = CHUNK, level: int = LEVEL) -> Iterator[dict]:
    """Rewrite one archive with a member per record and write its sidecar index; yields the index rows."""
    with open_file(source, "r") as stream, open_file(target, "w") as out, open_file(f"{target}.index", "w") as sidecar:
        at, entry, packer = 0, None, None

        def close() -> dict:
            nonlocal at
            last = packer.flush()
            out.write(last)
            at += len(last)
            entry["length"] = at - entry["offset"]
            sidecar.write(json.dumps(entry).encode() + b"\n")
            return entry

        for kind, data in split_records(inflated(stream, chunk)):
            if kind == "head":
                if entry:
                    yield close()
                known = fields(data)
                entry = {"archive": target, "offset": at, "length": 0, "id": known.get("warc-record-id", ""),
                         "type": known.get("warc-type", "")}
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            packed = packer.compress(data)
            out.write(packed)
            at += len(packed)
        if entry:
            yield close()


def normalised(archives: DataFrame, folder: str, path: str = "archive") -> DataFrame:
    """Index rows (archive, offset, length, id, type) of the normalised copies of all archives, one task per archive."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source in b.column(0).to_pylist():
                rows = []
                for entry in normalise(source, f"{folder}/{uuid.uuid4().hex}.warc.gz"):
                    rows.append(tuple(entry.values()))
                    if len(rows) == 1000:
                        yield batch(_INDEX, *zip(*rows))
                        rows = []
                if rows:
                    yield batch(_INDEX, *zip(*rows))

    spread = archives.select(path).repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism))
    return map_batches(spread, task, "archive string, offset long, length long, id string, type string")


_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.string()),
                    ("type", pa.string())])


# --- writing and reading ---------------------------------------------------------------

def planned(pages: DataFrame, at_least: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses)."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    again = rows.where(F.col("size") >= at_least).groupBy("digest").agg(
        F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("least"))
    again = staged(again, "repeated")  # written first, so that payloads are shuffled only if there are many of these
    return rows.join(again, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(later, F.col("least")).alias("refers_to"))


def written(records: DataFrame, folder: str, roll: int = ROLL, level: int = LEVEL) -> DataFrame:
    """Write the records to archives, each one gzip stream; gives archive and its number of records."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = path = None
        count = held = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return batch(pa.schema([("archive", pa.string()), ("records", pa.int64())]), [path], [count])

        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, packer = open_file(path, "w"), zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record(page_id, url, payload, digest, refers_to)
                out.write(packer.compress(data))
                count, held = count + 1, held + len(data)
                if held >= roll:
                    yield close()
                    out, count, held = None, 0, 0
        if out is not None:
            yield close()

    frame = records.select("page_id", valid("url").alias("url"), "payload", "digest", "refers_to")
    return map_batches(frame, task, "archive string, records long")


_READ = pa.schema([("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers", pa.string())])


def read_record(member: bytes) -> tuple:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    known = fields(head)
    block = rest[: int(known["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = known["warc-payload-digest"].removeprefix("sha256:")
    size = int(fields(http)["content-length"])
    if known["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != said or len(payload) != size):
        raise ValueError(f"{known['warc-record-id']} has another payload than its header says")
    return known["warc-record-id"], size, said, known["warc-type"], known.get("warc-refers-to")


def read_back(index: DataFrame) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type, refers of every indexed record, by ranged reads."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = stream = None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if archive != path:
                    if stream:
                        stream.close()
                    path, stream = archive, open_file(archive, "seek")
                stream.seek(offset)
                rows.append(read_record(stream.read(length)))
            yield batch(_READ, *(list(zip(*rows)) or [[]] * 5))
        if stream:
            stream.close()

    return map_batches(index.select("archive", "offset", "length"), task,
                       "id string, payload_bytes long, payload_digest string, record_type string, refers string")


def page_of(urn: str, kind: str):
    """The page id in a record id."""
    inner = F.regexp_extract(urn, r"^<urn:page:(.*)>$", 1)
    return F.when(inner != "", F.expr(f"url_decode(regexp_extract({urn}, '^<urn:page:(.*)>$', 1))")).cast(kind)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages as archives of one stream each, normalise these, and read all records back by their index."""
    spark = pages.sparkSession
    first = staged(written(planned(pages), new_folder(spark, "warc")), "archives")
    index = staged(normalised(first, new_folder(spark, "members")), "index")
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_back(index).select(page_of("id", kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                   page_of("refers", kind).alias("refers_to"))
