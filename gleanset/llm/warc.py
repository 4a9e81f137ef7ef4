"""WARC archives from Spark: an index first, then byte-range reads of chosen records.

Every writing task makes one archive of gzip members, one per record, in the shared
folder, and returns one index row per record: file, offset, length, URL and digest.
Only index rows of tasks that succeeded are kept, so what a lost task leaves behind is never
read.  Reading sorts index rows by file and offset, joins near ranges into one read, and
deals those reads over the tasks.

Of records with equal payloads the one with the least id is a response, the others
are revisits that refer to it.

Cases: a null payload is an empty one and a null URL an empty URL.  Rows without an id
are responses of their own.  Rows alike in id and payload are all responses, or all revisits.
A payload must fit the memory of a task several times.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanset.llm.tables import small_enough, stored
from gleanset.plans.durable import scratch_path

INDEX = (
    "id bigint, url string, file string, offset bigint, length bigint, "
    "payload_digest string, record_type string, refers_to bigint"
)
RECORD = (
    "id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)
# Records nearer than this are fetched by one read, which is at most READ_BYTES long
# unless one record is longer.
GAP_BYTES = 64 << 10
READ_BYTES = 4 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(number: int | None) -> str:
    """A stable URN of a page id; pages without an id get a fresh one."""
    name = uuid.uuid4() if number is None else uuid.uuid5(uuid.NAMESPACE_OID, f"page {number}")
    return f"<{name.urn}>"


def _uri(url: str) -> str:
    """The URL as printable ASCII."""
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]")


def record_bytes(number: int | None, url: str, payload: bytes, first: int | None) -> tuple[bytes, str]:
    """One record and its digest; ``first`` is the id of the response that a revisit refers to."""
    digest = payload_digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(number)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: {record_id(first)}", f"WARC-Profile: {REVISIT_PROFILE}"]
        payload = b""
    block = http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(record: bytes) -> dict:
    """Type, digest, payload and full payload length of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(re.findall(r"(?m)^([^:\r\n]+): *([^\r\n]*)\r?$", head.decode()))
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    return {
        "type": fields["WARC-Type"],
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": payload,
        "payload_bytes": length,
    }


def _folder(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a URI, as tasks reach it; a bare path is a local one."""
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _first_copies(pages: DataFrame) -> DataFrame:
    """Digest and least id of payloads that more than one row has."""
    return (
        pages.where("id is not null").groupBy(F.sha1("payload").alias("sha"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("many"))
        .where("many > 1").select("sha", "first")
    )


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write one record per row below ``folder``, and return the index of the records."""
    rows = pages.select(
        F.col(key).cast("bigint").alias("id"),
        F.coalesce(url, F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    firsts = small_enough(stored(_first_copies(rows), "first-copies"))
    marked = rows.withColumn("sha", F.sha1("payload")).join(firsts, "sha", "left").select(
        "id", "url", "payload", F.when(F.col("first") < F.col("id"), F.col("first")).alias("first")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _folder(folder)
        store.create_dir(top, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        offset = 0
        with store.open_output_stream(f"{top}/{name}", compression=None) as out:
            for batch in batches:
                made = []
                for number, address, body, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    record, digest = record_bytes(number, address, body, first)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    packed = packer.compress(record) + packer.flush()
                    out.write(packed)
                    kind = "response" if first is None else "revisit"
                    made.append((number, address, f"{folder}/{name}", offset, len(packed), digest, kind, first))
                    offset += len(packed)
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(made, columns=_names(INDEX)).astype({"id": "Int64", "refers_to": "Int64"}),
                    preserve_index=False, schema=_INDEX_SCHEMA,
                )

    return stored(marked.mapInArrow(write, INDEX), "warc-index")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_INDEX_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (p.split() for p in INDEX.split(", "))])
_RECORD_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (p.split() for p in RECORD.split(", "))])


def read_records(index: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records that rows of an index name, by few sorted range reads.

    A record whose payload does not have the length and digest it states raises an error.
    Without ``payloads`` that column is null.
    """
    order = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    far = F.coalesce(F.col("offset") - F.lag(end).over(order) > GAP_BYTES, F.lit(True)).cast("int")
    # A read is a run of near records, cut where a multiple of READ_BYTES is crossed.
    runs = index.withColumn("run", F.sum(far).over(order)).withColumn(
        "cut", F.floor(F.col("offset") / READ_BYTES)
    )
    reads = runs.groupBy("file", "run", "cut").agg(
        F.sort_array(F.collect_list(F.struct(
            "offset", "length", "id", "url", "payload_digest", "record_type", "refers_to"
        ))).alias("records")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                store, path = _folder(file)
                begin = records[0]["offset"]
                with store.open_input_file(path) as source:
                    span = source.read_at(records[-1]["offset"] + records[-1]["length"] - begin, begin)
                made = []
                for r in records:
                    at = r["offset"] - begin
                    found = parse_record(zlib.decompress(span[at : at + r["length"]], 31))
                    kind, body = found["type"], found["payload"]
                    intact = kind == r["record_type"] and found["digest"] == r["payload_digest"]
                    if kind == "response":
                        intact = intact and len(body) == found["payload_bytes"] and (
                            payload_digest(body) == found["digest"])
                    if not intact:
                        raise ValueError(f"damaged record at {r['offset']} of {file}")
                    shown = body if payloads and kind == "response" else None
                    made.append((r["id"], r["url"], found["payload_bytes"], found["digest"], kind,
                                 r["refers_to"], shown))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), _RECORD_SCHEMA.types, strict=True)],
                    schema=_RECORD_SCHEMA,
                )

    return reads.select("file", "records").mapInArrow(read, RECORD)


def archive_folder(pages: DataFrame) -> str:
    """A fresh folder for archives in the shared folder of the cluster."""
    return scratch_path(pages.sparkSession, "warc")
