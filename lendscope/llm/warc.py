"""WARC archives by an index of byte ranges.

Writing gives, per record, a row of the index (file, offset, length, URL,
digest); reading sorts the selected rows by place, joins ranges that lie close
together and fetches each joined range once.  Records are gzip members of
their own, so any of them can be read alone.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize, new_folder

MIN_REVISIT_BYTES = 100
FILE_BYTES = 1 << 30          # an archive is closed beyond this size
RANGE_BYTES = 8 << 20         # records that start within so many bytes are read by one task
SALTS = 16                   # the rows of one payload are spread over so many keys
MAX_READ_TASKS = 20_000
GAP_BYTES = 64 << 10          # ranges with at most so many bytes between them are read at once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, file string, offset long, length long, record_type string, payload_digest string, "
         "payload_bytes long, refers_to long")


def open_store(uri: str):
    """File system and path of a folder that all executors share."""
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(uri)


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, date: str, name: str) -> bytes:
    """One WARC record; without ``refers_to`` a response, else a revisit of
    that page's record, which repeats no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {size}", f"Content-Length: {len(body)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"X-Refers-To-Page: {refers_to}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of one record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[:int(fields["content-length"])].split(b"\r\n\r\n", 1)[1]


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below
    ``folder`` and return the index, as a table in the shared scratch folder.

    Null html is an empty payload; null ids and URLs are left out of the
    record's head.  Of rows with equal payloads of ``min_revisit_bytes`` or
    more, those of the smallest id (all of them, where it repeats, or where no
    row has an id) are responses and the others revisits.  Other columns are
    not read.  A task that is run again writes another file and only the
    finished task's file is in the index.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    copies = (rows.filter(F.col("size") >= min_revisit_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    every = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt")
    marked = (rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
              .join(copies.select("digest", "first", every), ["digest", "salt"], "left")
              .select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "size",
                      F.when(revisit, F.col("first")).alias("refers_to")))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    columns = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.string() if c.split()[1] == "string" else pa.int64() for c in INDEX.split(", ")]

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        out, at, name = None, 0, ""
        try:
            for part in parts:
                index = []
                page, url, text, digest, size, refers = (part.column(i) for i in range(6))
                for i in range(part.num_rows):
                    if out is None or at > file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    page_id, to, n = page[i].as_py(), refers[i].as_py(), size[i].as_py()
                    payload = (text[i].as_py() or "").encode()
                    raw = record(page_id, url[i].as_py(), payload, digest[i].as_py(), n, to, date, f"{name}:{at}")
                    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = gz.compress(raw) + gz.flush()
                    out.write(data)
                    index.append((page_id, url[i].as_py(), f"{folder}/{name}", at, len(data),
                                  "response" if to is None else "revisit", digest[i].as_py(), n, to))
                    at += len(data)
                cols = list(zip(*index)) or [[]] * len(columns)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=columns)
        finally:
            if out is not None:
                out.close()

    store, top = open_store(folder)
    store.create_dir(top, recursive=True)
    return materialize(marked.mapInArrow(write, INDEX), "warc-index")


def joined(spans: list[tuple[int, int]], gap: int = GAP_BYTES) -> list[tuple[int, int, list[int]]]:
    """(start, stop, places in ``spans``) of the ranges to read for sorted
    (offset, length) spans."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(spans):
        if out and offset - out[-1][1] <= gap:
            start, stop, members = out[-1]
            members.append(k)
            out[-1] = (start, max(stop, offset + length), members)
        else:
            out.append((offset, offset + length, [k]))
    return out


def read_records(index: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the selected rows of an index, from the archives alone:
    page_id, record_type, payload_bytes, payload_digest, refers_to and, with
    ``with_payload``, payload (null for revisits).

    Size and digest of a response are taken from the payload that was read,
    those of a revisit from its head.  Rows of the index that repeat give
    repeated records; an empty selection gives none.
    """

    def fetch(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        store, path = open_store(key[0])
        rows = rows.sort_values("offset")
        spans = list(zip(rows["offset"].tolist(), rows["length"].tolist()))
        out = []
        with store.open_input_file(path) as f:
            for start, stop, members in joined(spans):
                data = f.read_at(stop - start, start)
                for k in members:
                    offset, length = spans[k]
                    raw = zlib.decompress(data[offset - start:offset - start + length], 31)
                    head, payload = parse(raw)
                    own = head["warc-type"] == "response"
                    out.append((
                        head.get("x-page-id"), head["warc-type"],
                        len(payload) if own else int(head["x-payload-length"]),
                        hashlib.sha256(payload).hexdigest() if own else head["warc-payload-digest"].split(":")[1],
                        head.get("x-refers-to-page"), payload.decode() if own and with_payload else None))
        table = pd.DataFrame(out, columns=["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to",
                                           "payload"])
        for c in ("page_id", "refers_to"):
            table[c] = table[c].map(int, na_action="ignore").astype("Int64")
        return table if with_payload else table.drop(columns="payload")

    schema = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long" \
             + ", payload string" * with_payload
    places = index.select("file", "offset", "length", F.floor(F.col("offset") / range_bytes).alias("range"))
    # Only index rows are shuffled, so their size says nothing of the work: the bytes to read set the tasks.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = int(min(MAX_READ_TASKS, max(index.sparkSession.sparkContext.defaultParallelism, -(-total // range_bytes))))
    return places.repartition(tasks, "file", "range").groupBy("file", "range").applyInPandas(fetch, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives below the shared scratch folder and read
    every record back through the index."""
    folder = new_folder(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_records(write_archives(pages, folder), with_payload=False)
