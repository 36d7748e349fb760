"""WARC archives: writing with revisit records, reading in parallel by verified chains.

A WARC file can only be entered at a record's start, and a payload may contain the
bytes that start one. To read a file in many tasks, each task looks at one slice and
emits, for every place that looks like a record, where its successor would start. The
places form chains; only the chain that begins at the file's first byte is real.
Inside a slice a task follows the chains itself and keeps, per candidate, the first
place beyond the slice; the few places where chains cross slices are then resolved by
pointer jumping, in as many rounds as the number of slices has binary digits. A second
pass reads the records of each slice from its verified entry.

Records with equal payloads of at least ``min_bytes`` are written once: the one with
the largest id is the ``response``, the others are ``revisit`` records that name it.

Defined results: a null payload is empty. A null id is written as an empty id, counts
as smaller than any other and reads back as null. Rows that repeat the largest id of
equal payloads are all responses. A null url has no target header; control characters
in urls are percent-encoded. Empty tables give no archive and no row. Task retries
leave files that no manifest names.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import batch, stored, table
from loadstar.sources.session import new_folder

MAGIC = b"WARC/1.0\r\n"
FILE_BYTES = 256 << 20
SLICE_BYTES = 8 << 20
_MOST_TASKS = 50_000
_AHEAD = 1 << 20  # bytes read beyond a slice; a longer header is read on to its end
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", re.I)
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; a revisit carries the HTTP head of the full payload, not its bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    body = http + payload if refers_to is None else http
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~')}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return MAGIC + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


_FILES = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, base = pa.fs.FileSystem.from_uri(folder)
    out = path = None
    count = size = 0
    for b in batches:
        for page, url, html, refers in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if out is None:
                path, count, size = f"{base}/{uuid.uuid4().hex}.warc", 0, 0
                out = fs.open_output_stream(path)
            data = record(page, url, html or b"", refers)
            out.write(data)
            count, size = count + 1, size + len(data)
            if size >= file_bytes:
                out.close()
                out = None
                yield batch(_FILES, path=[path], n_records=[count], n_bytes=[size])
    if out is not None:
        out.close()
        yield batch(_FILES, path=[path], n_records=[count], n_bytes=[size])


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: the id whose payload a row repeats, or null."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    # Only payloads that occur more than once go on; counts are combined before the shuffle.
    groups = rows.select("sha", "page_id", F.octet_length("payload").alias("n")).where(F.col("n") >= min_bytes)
    groups = groups.groupBy("sha").agg(F.max("page_id").alias("kept"), F.count("*").alias("copies")).where("copies > 1")
    # Stored, their size is known when the join is planned: payloads move only if they are many.
    groups = stored(groups, "warc-copies")
    rows = rows.join(groups.select(F.col("sha").alias("_sha"), "kept"), F.col("sha") == F.col("_sha"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")), F.col("kept"))
    return rows.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Write ``pages`` (``page_id, url, html``) as archives; the folder and its manifest."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    fs, base = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    files = with_revisits(pages, min_bytes).mapInArrow(lambda b: _write(b, folder, file_bytes), "path string, n_records long, n_bytes long")
    return folder, stored(files, "warc-manifest")


class _Part:
    """Bytes of a file from ``low``, read ahead of ``high`` as far as headers need."""

    def __init__(self, file, low: int, high: int):
        self.file, self.size, self.low = file, file.size(), low
        self.data = file.read_at(max(0, min(high + _AHEAD, self.size) - low), low)

    def header_end(self, at: int) -> int:
        """Where the header that starts at ``at`` ends, both places in ``data``; -1 if it never does."""
        end = self.data.find(b"\r\n\r\n", at)
        while end < 0 and self.low + len(self.data) < self.size:
            known = len(self.data)
            self.data += self.file.read_at(min(max(_AHEAD, known), self.size - self.low - known), self.low + known)
            end = self.data.find(b"\r\n\r\n", max(at, known - 3))
        return end


def _candidates(part: _Part, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets that look like records of the slice, and their successors within the file."""
    at, found = part.data.find(MAGIC), []
    while 0 <= at < high - part.low:
        end = part.header_end(at)
        length = _LENGTH.search(part.data, at, end + 2) if end >= 0 else None
        after = part.low + end + 4 + int(length[1]) + 4 if length and len(length[1]) < 20 else part.size + 1
        if after <= part.size:
            found.append((part.low + at, after))
        at = part.data.find(MAGIC, at + 1)
    rows = np.array(found, np.int64).reshape(-1, 2)
    return rows[:, 0], rows[:, 1]


def exits(offset: np.ndarray, successor: np.ndarray, high: int) -> np.ndarray:
    """Where each candidate's chain leaves the slice; -1 if it ends at no candidate before."""
    n = len(offset)
    at = np.searchsorted(offset, successor)
    inside = successor < high
    known = inside & (at < n) & (offset[np.minimum(at, max(n - 1, 0))] == successor) if n else inside
    # Pointer jumping inside the slice: n + 0 marks chains that end, themselves their own successor.
    last = np.where(inside, -1, successor)
    jump = np.where(known, at, np.arange(n))
    for _ in range(max(1, n.bit_length())):
        jump = jump[jump]
    return last[jump] if n else last


_LINKS = pa.schema([("path", pa.string()), ("part", pa.int64()), ("offset", pa.int64()), ("exit", pa.int64())])


def _links(batches: Iterator[pa.RecordBatch], folder: str, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, _ = pa.fs.FileSystem.from_uri(folder)
    for b in batches:
        for path, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            low, high = part * slice_bytes, (part + 1) * slice_bytes
            with fs.open_input_file(path) as f:
                held = _Part(f, low, high)
                offset, successor = _candidates(held, high)
            out = exits(offset, successor, min(high, held.size))
            yield batch(_LINKS, path=[path] * len(offset), part=[part] * len(offset), offset=offset, exit=out)


def entries(folder: str, slices: DataFrame, n_slices: int, tasks: int, slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, DataFrame]:
    """``path, part, offset`` of the first real record of every slice that has one, and
    ``path, exit`` of the places at which the real chains leave slices.

    ``n_slices`` is the most slices of a file; it only sets the number of rounds.
    """
    links = slices.repartition(tasks, F.col("path"), F.col("part")).mapInArrow(lambda b: _links(b, folder, slice_bytes), "path string, part long, offset long, exit long")
    links = stored(links, "warc-links")
    # Chains cross slices only at the file's start and at exits, so these alone need jumping.
    crossings = links.where("exit >= 0").select("path", F.col("exit").alias("offset")).distinct()
    starts = links.where("offset = 0").select("path", "offset")
    nodes = crossings.join(links, ["path", "offset"]).select("path", "offset", "exit")
    nodes = nodes.unionByName(starts.join(links, ["path", "offset"]).select("path", "offset", "exit")).distinct()
    jump = stored(nodes, "warc-jump")
    reached = starts
    for _ in range(math.ceil(math.log2(max(2, n_slices))) + 1):
        ahead = reached.join(jump, ["path", "offset"]).select("path", F.col("exit").alias("offset"))
        reached = stored(reached.unionByName(ahead).distinct(), "warc-reached")
        far = jump.select("path", F.col("offset").alias("exit"), F.col("exit").alias("_far"))
        jump = stored(jump.join(far, ["path", "exit"], "left").select("path", "offset", F.coalesce("_far", F.lit(-1).cast("long")).alias("exit")), "warc-jump")
    real = reached.join(links, ["path", "offset"])
    return real.select("path", "part", "offset"), real.select("path", "exit")


_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("path", pa.string()),
        ("offset", pa.int64()),
    ]
)
_RECORDS_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, path string, offset long"


def _page(value: str | None) -> int | None:
    text = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def parse(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def _records(batches: Iterator[pa.RecordBatch], folder: str, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, _ = pa.fs.FileSystem.from_uri(folder)
    for b in batches:
        for path, part, at in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            high = (part + 1) * slice_bytes
            rows = []
            with fs.open_input_file(path) as f:
                held, low = _Part(f, at, high), at
                while at < min(high, held.size):
                    end = held.header_end(at - low)
                    fields = parse(held.data[at - low : end])
                    start, length = end + 4, int(fields["content-length"])
                    body = held.data[start : start + length]
                    if len(body) < length:  # the slice's last record reaches beyond what was read
                        body = f.read_at(length, low + start)
                    head, _, payload = body.partition(b"\r\n\r\n")
                    sha = fields["warc-payload-digest"].removeprefix("sha1:")
                    n = int(parse(head)["content-length"])
                    if fields["warc-type"] == "response" and (len(payload) != n or digest(payload) != sha):
                        raise ValueError(f"{path} is damaged at {at}")
                    refers = fields.get("warc-refers-to")
                    rows.append((_page(fields["warc-record-id"]), n, sha, fields["warc-type"], _page(refers), fields.get("warc-target-uri"), path, at))
                    at = low + start + length + 4
            yield batch(_RECORDS, **{f.name: [r[i] for r in rows] for i, f in enumerate(_RECORDS)})


def read_warc(folder: str, manifest: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All records of the archives: ids, payload sizes and digests, type, reference, place.

    Raises ``ValueError`` if the chain of some file does not end where the manifest says that
    the file does: records behind the break would be missing.
    """
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_bytes") - 1) / slice_bytes))
    slices = manifest.where("n_bytes > 0").select("path", F.explode(parts).alias("part"))
    most, tasks = slices.agg(F.max("part") + 1, F.count("*")).first()
    # A given number of partitions stays as it is; by size alone these few bytes would be one task.
    tasks = max(1, min(tasks, _MOST_TASKS))
    first, left = entries(folder, slices, most or 1, tasks, slice_bytes)
    whole = left.withColumnRenamed("exit", "n_bytes").distinct()
    broken = manifest.where("n_bytes > 0").join(whole, ["path", "n_bytes"], "left_anti").select("path").limit(3).collect()
    if broken:
        raise ValueError(f"records are missing or damaged in {', '.join(r.path for r in broken)}")
    return first.repartition(tasks, F.col("path"), F.col("part")).mapInArrow(lambda b: _records(b, folder, slice_bytes), _RECORDS_DDL)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as read back from the archives that were written of them."""
    folder, manifest = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(folder, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, body, max(page_id) OVER (PARTITION BY body) AS kept FROM p
), b AS (
  SELECT page_id, n, kept, sha1(body) AS hex FROM d
), w AS (
  SELECT *, list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
      (('0x' || substr(hex || '0', 1 + (5 * i) // 4, 3))::BIGINT >> (7 - (5 * i) % 4)) & 31) AS BIGINT), 1)) AS chars FROM b
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(chars, '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM w
"""
