"""WARC archives with revisit records, and an index of captures merged from sorted runs."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch_dir

from .common import map_arrow, written

#: Bytes after which an archive file is closed (one record may exceed it), captures sorted as one run.
FILE_BYTES, RUN_CAPTURES = 16 << 20, 50_000
#: Captures of a range of keys that one task merges.
RANGE_CAPTURES = 200_000
#: Smaller payloads are stored again rather than referred to.
LEAST_REVISIT = 100
_RUNS = (
    "run string, pos int, url_key string, captured string, page_id long, file string, record int, "
    "offset long, length long"
)
_RECORDS = "file string, record int, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host labels, then path and query, lower case, without scheme and fragment."""
    rest = (url or "").partition("://")[2] or (url or "")
    host, path = re.fullmatch(r"([^/?#]*)(.*)", rest.partition("#")[0], re.S).groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + (path.lower() or "/")


def _record(kind: str, page_id, url: str | None, captured: str, digest: str, payload: bytes, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {captured}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # each record is a gzip member of its own
    return packer.compress(data) + packer.flush()


def _writer(folder: str, file_bytes: int, run_captures: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = pafs.FileSystem.from_uri(folder)
        parts, size, files, captures, runs = [], 0, 0, [], 0

        def close() -> None:
            # The same rows give the same file, so a task that runs again replaces it.
            nonlocal parts, size, files
            with fs.open_output_stream(draft := f"{base}/.{part:06d}-{files:06d}.{TaskContext.get().taskAttemptId()}") as f:
                f.write(b"".join(parts))
            fs.move(draft, f"{base}/{part:06d}-{files:06d}.warc.gz")
            parts, size, files = [], 0, files + 1

        def run() -> pa.RecordBatch:
            nonlocal captures, runs
            captures.sort()
            columns = list(zip(*captures, strict=True))
            name = f"{part:06d}-{runs:06d}"
            captures, runs = [], runs + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(columns[0])), pa.array(range(len(columns[0])), pa.int32()), pa.array(columns[0]), pa.array(columns[1]),
                 pa.array([None if none else x for none, x in zip(columns[2], columns[3], strict=True)], pa.int64()),
                 pa.array(columns[4]), pa.array(columns[5], pa.int32()), pa.array(columns[6], pa.int64()), pa.array(columns[7], pa.int64())],
                schema=pa.schema([("run", pa.string()), ("pos", pa.int32()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
                                  ("file", pa.string()), ("record", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]),
            )

        for batch in batches:
            for page_id, url, html, at, digest, refers_to in zip(*(c for c in batch.columns), strict=True):
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                kind = "response" if refers_to is None else "revisit"
                captured = datetime.fromtimestamp(at.as_py(), UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
                data = _record(kind, page_id, url, captured, digest.as_py(), html.as_py().encode(), refers_to)
                captures.append((url_key(url), captured, page_id is None, page_id or 0, f"{part:06d}-{files:06d}.warc.gz", len(parts), size, len(data)))
                parts.append(data)
                size += len(data)
                if size >= file_bytes:
                    close()
                if len(captures) >= run_captures:
                    yield run()
        if parts:
            close()
        if captures:
            yield run()

    return write


def loser_tree(runs: list[list]) -> Iterator:
    """The rows of sorted runs in order: a tournament in which each inner node keeps its loser."""
    k = len(runs)
    heads, at = [r[0] if r else None for r in runs], [0] * k

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a], a) < (heads[b], b)

    tree = [-1] * k

    def play(leaf: int) -> int:
        """Carry a leaf's row up; the winner of its path to the root."""
        winner, node = leaf, (leaf + k) // 2
        while node:
            if tree[node] < 0:  # the first to come waits for the other side
                tree[node] = winner
                return -1
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        return winner

    top = -1
    for leaf in range(k):
        won = play(leaf)
        top = won if won >= 0 else top
    while k and heads[top] is not None:
        yield heads[top]
        at[top] += 1
        heads[top] = runs[top][at[top]] if at[top] < len(runs[top]) else None
        top = play(top)


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys: the piece of each run in it, in the run's order, merged."""
    part, runs = TaskContext.get().partitionId(), {}
    schema = None
    for batch in batches:
        schema = batch.schema
        columns = batch.to_pydict()
        for i, run in enumerate(columns["run"]):
            page = columns["page_id"][i]
            runs.setdefault(run, []).append((columns["url_key"][i], columns["captured"][i], page is None, page or 0, columns["file"][i], columns["record"][i], columns["offset"][i], columns["length"][i]))
    merged = list(loser_tree([runs[r] for r in sorted(runs)]))
    for a in range(0, len(merged), 20_000):
        key, at, none, page, file, record, offset, length = zip(*merged[a : a + 20_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(key), pa.int32()), pa.array(range(a, a + len(key)), pa.int64()), pa.array(key), pa.array(at),
             pa.array([None if n else p for n, p in zip(none, page, strict=True)], pa.int64()), pa.array(file), pa.array(record, pa.int32()),
             pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
            names=["part", "rank", "url_key", "captured", "page_id", "file", "record", "offset", "length"],
        )


def write_archives(pages: DataFrame, folder: str, captured: Column | None = None, file_bytes: int = FILE_BYTES, run_captures: int = RUN_CAPTURES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files below ``folder``; the locally sorted runs of their index.

    Of equal payloads of at least LEAST_REVISIT bytes the one with the smallest page_id
    is stored, others refer to it. ``captured`` gives seconds since 1970 (of the years 1 to
    9999; others are taken as 1970), by default 1,700,000,000 plus the page_id modulo 10**9. Null html is empty; a row without a page_id is
    written, and refers to the stored one like any other. Rows that repeat a page_id and
    its payload are all stored.
    """
    page = F.coalesce(F.col("page_id").cast("long"), F.lit(0))
    at = F.lit(1_700_000_000) + F.pmod(page, F.lit(10**9)) if captured is None else captured
    at = F.when(at.cast("long").between(-62_135_596_800, 253_402_300_799), at).otherwise(0)
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"), at.cast("long").alias("at")
    ).withColumn("digest", F.sha2(F.encode("html", "utf-8"), 256))
    large = rows.filter(F.octet_length("html") >= LEAST_REVISIT)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = written(first.filter("n > 1").select("digest", "first"), "payloads")
    joined = rows.join(first, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    laid = joined.select("page_id", "url", "html", "at", "digest", refers.alias("refers_to"))
    return written(map_arrow(laid, _writer(folder, file_bytes, run_captures), _RUNS), "capture-runs")


def merge_runs(runs: DataFrame) -> DataFrame:
    """The capture history: rows of all runs with ``part`` and ``rank``, ordered by url_key, time, page.

    Keys are dealt in ranges of about ``RANGE_CAPTURES`` rows by (url_key, captured, page_id,
    file, record), which split even one url's captures; a task merges the pieces of all runs
    that fall in its range, and holds no more than those.
    """
    order = ["url_key", "captured", "page_id", "file", "record"]
    ranges = max(1, math.ceil(runs.count() / RANGE_CAPTURES))
    ranged = runs.repartitionByRange(ranges, *order).sortWithinPartitions("run", "pos")
    return written(
        map_arrow(
            ranged,
            _merger,
            "part int, rank long, url_key string, captured string, page_id long, file string, record int, offset long, length long",
        ),
        "captures",
    )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def number(field: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
        return int(found[1]) if found else None

    def fields(lines: list[bytes]) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}

    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            out: dict[str, list] = {c.split()[0]: [] for c in _RECORDS.split(", ")}
            stream = gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))
            while start := stream.readline():
                if start.strip() != b"WARC/1.1":
                    raise ValueError(f"{name}: not a record: {start[:40]!r}")
                head = fields(list(iter(lambda: stream.readline().rstrip(b"\r\n"), b"")))
                block = stream.read(int(head["content-length"]))
                if stream.read(4) != b"\r\n\r\n":
                    raise ValueError(f"{name}: a record does not end")
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(fields(http.split(b"\r\n")[1:])["content-length"])
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                if head["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{name}: a payload differs from its digest")
                values = (name, len(out["file"]), number(head["warc-record-id"]), length, digest, head["warc-type"], number(head.get("warc-refers-to")))
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def read_archives(df: DataFrame, folder: str) -> DataFrame:
    """Every record of the archive files below ``folder``; stored payloads are checked against their digests."""
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return map_arrow(files, _reader, _RECORDS)


def warc_index(pages: DataFrame) -> DataFrame:
    """Archive ``pages``, merge the index and read the archives back along it.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key,
    captured, position (in the capture history), file, offset, length.
    """
    folder = scratch_dir(pages.sparkSession, "warc")
    history = merge_runs(write_archives(pages, folder))
    records = read_archives(pages, folder)
    parts = history.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # as many rows as there were tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = history.join(parts, "part").withColumn("position", F.col("rank") + F.col("before"))
    joined = placed.drop("page_id").join(records, ["file", "record"])
    return joined.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position", "file", "offset", "length"
    )
