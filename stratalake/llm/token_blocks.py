"""Token ids in patched frame-of-reference blocks: encode, write shard files, read them back.

File format (little endian), one shard file after another in ascending document order:

    magic "PFB1" | u32 ids per block | u64 ids | u32 documents | u32 blocks
    documents x (i64 doc_id, u64 ids, u8 1 if there is a doc_id)   document index
    blocks x (u64 start, u32 minimum, u8 width, u8 0, u16 exceptions)   block index
    payload of u32 words: per block the low ``width`` bits of (id - minimum), then the
    positions of exceptions (u16, padded to a word), then their high bits (u32)

``start`` counts payload words, so any block can be read alone. ``width`` is the
smallest that holds the given percentile of a block; what needs more bits is an exception.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import scratch_dir

from .common import map_arrow
from .encode_columns import SHARD_BYTES, column_encoder
from .words import shards

BLOCK, PERCENTILE = 256, 90
#: Ids gathered before a shard file is closed; a document lies in one shard.
SHARD_IDS = 2_000_000
_HEAD = struct.Struct("<4sIQII")
_DOCS = np.dtype([("doc_id", "<i8"), ("ids", "<u8"), ("known", "u1")])
_BLOCKS = np.dtype([("start", "<u8"), ("minimum", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")])


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of BLOCK * width / 32 words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64))
    out = np.zeros((max(width, 1), lanes.shape[1]), dtype=np.uint64)
    for j in range(64):
        word, off = divmod(j * width, 64)
        out[word] |= lanes[j] << np.uint64(off)
        if off + width > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - off)
    return np.ascontiguousarray(out[:width].T).view("<u4").reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int, rows: int) -> np.ndarray:
    packed = np.ascontiguousarray(np.ascontiguousarray(words).view("<u8").reshape(-1, width).T)
    out = np.empty((64, packed.shape[1]), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, off = divmod(j * width, 64)
        value = packed[word] >> np.uint64(off)
        if off + width > 64:
            value |= packed[word + 1] << np.uint64(64 - off)
        out[j] = value & mask
    return out.T.reshape(rows, -1)


def encode_shard(doc_ids: list[int | None], docs: list[np.ndarray], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """A shard file's bytes; ``block`` is a multiple of 64, ids are below 2**32."""
    ids = np.concatenate([np.zeros(0, np.uint32), *docs]).astype(np.uint32)
    blocks = -(-len(ids) // block)
    padded = np.zeros(blocks * block, dtype=np.uint32)
    padded[: len(ids)] = ids
    if len(ids):
        padded[len(ids) :] = ids[-1]
    rows = padded.reshape(blocks, block)
    index = np.zeros(blocks, dtype=_BLOCKS)
    index["minimum"] = rows.min(axis=1, initial=(1 << 32) - 1) if blocks else 0
    delta = rows - index["minimum"][:, None]
    at = min(block - 1, block * percentile // 100)
    typical = np.partition(delta, at, axis=1)[:, at] if blocks else np.zeros(0, np.uint32)
    width = np.frexp(typical.astype(np.float64))[1].astype(np.uint8)
    index["width"] = width
    high = delta >> width[:, None] if blocks else delta
    high[width == 32] = 0
    row, pos = np.nonzero(high)
    count = np.bincount(row, minlength=blocks)
    index["exceptions"] = count
    words = block * width.astype(np.int64) // 32 + (count + 1) // 2 + count
    start = np.concatenate([[0], np.cumsum(words)])
    index["start"] = start[:-1]
    payload = np.zeros(int(start[-1]), dtype="<u4")
    for w in np.unique(width[width > 0]):
        which = np.flatnonzero(width == w)
        low = delta[which] & np.uint32((1 << int(w)) - 1)
        payload[start[which][:, None] + np.arange(block * int(w) // 32)] = _pack(low, int(w))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    rank = np.arange(len(row)) - first[row]
    lists = start[:-1] + block * width.astype(np.int64) // 32
    payload.view("<u2")[2 * lists[row] + rank] = pos
    payload[lists[row] + (count[row] + 1) // 2 + rank] = high[row, pos]
    documents = np.zeros(len(docs), dtype=_DOCS)
    documents["doc_id"], documents["ids"] = [0 if i is None else i for i in doc_ids], [len(d) for d in docs]
    documents["known"] = [i is not None for i in doc_ids]
    head = _HEAD.pack(b"PFB1", block, len(ids), len(docs), blocks)
    return head + documents.tobytes() + index.tobytes() + payload.tobytes()


def decode_shard(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(documents, ids)`` of a shard: the document index and all ids in order."""
    magic, block, n, n_docs, blocks = _HEAD.unpack_from(data)
    if magic != b"PFB1":
        raise ValueError("not a token block shard")
    at = _HEAD.size
    documents = np.frombuffer(data, _DOCS, n_docs, at)
    index = np.frombuffer(data, _BLOCKS, blocks, at := at + documents.nbytes)
    payload = np.frombuffer(data, "<u4", -1, at + index.nbytes)
    start, width, count = index["start"].astype(np.int64), index["width"].astype(np.int64), index["exceptions"].astype(np.int64)
    out = np.zeros((blocks, block), dtype=np.uint32)
    for w in np.unique(width[width > 0]):
        which = np.flatnonzero(width == w)
        out[which] = _unpack(payload[start[which][:, None] + np.arange(block * int(w) // 32)], int(w), len(which))
    row = np.repeat(np.arange(blocks), count)
    rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    lists = start + block * width // 32
    pos = payload.view("<u2")[2 * lists[row] + rank]
    out[row, pos] |= payload[lists[row] + (count[row] + 1) // 2 + rank] << width[row].astype(np.uint32)
    out += index["minimum"][:, None]
    return documents, out.reshape(-1)[:n]


_MANIFEST = "shard string, part int, seq int, ids long"


def _writer(folder: str, path: str, end: int | None, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = pafs.FileSystem.from_uri(folder)
        known, doc_ids, docs, size, seq = column_encoder(path), [], [], 0, 0
        closing = np.array([] if end is None else [end], dtype=np.uint32)

        def close() -> pa.RecordBatch:
            # The same rows give the same file, so a task that runs again replaces it.
            name = f"shard-{part:06d}-{seq:06d}.pfb"
            with fs.open_output_stream(draft := f"{base}/.{name}.{TaskContext.get().taskAttemptId()}") as f:
                f.write(encode_shard(doc_ids, docs))
            fs.move(draft, f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"shard": [name], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "ids": [size]})

        for texts in shards(batches, "text", SHARD_BYTES):
            ids, offsets = known.encode(texts["text"])
            cuts = offsets.tolist()
            for doc_id, a, b in zip(texts["doc_id"].to_pylist(), cuts, cuts[1:], strict=False):
                docs.append(np.concatenate([ids[a:b], closing]))
                doc_ids.append(doc_id)
                size += len(docs[-1])
                if size >= shard_ids:
                    yield close()
                    doc_ids, docs, size, seq = [], [], 0, seq + 1
        if docs:
            yield close()

    return write


def write_tokens(docs: DataFrame, path: str, end: int | None, folder: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` with a vocabulary file and write shards in ascending doc_id order.

    Null texts are empty, rows without doc_id come first and keep none; equal doc_ids
    follow each other by text. Documents are dealt by ranges of doc_id,
    encoded and written where they land; no task holds more than a shard. Returns the
    manifest, stored beside the shards: (shard, part, seq, ids). ``folder`` must be
    one that all executors reach.
    """
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Long texts: few rows an Arrow batch is what bounds a task's memory.
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    found = map_arrow(dealt, _writer(folder, path, end, shard_ids), _MANIFEST, encodes=True)
    found.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            documents, ids = decode_shard(content.as_buffer())
            ends = np.cumsum(documents["ids"]).astype(np.int64)
            starts = ends - documents["ids"].astype(np.int64)
            raw = ids.astype("<u4", copy=False)
            yield pa.RecordBatch.from_pydict({
                "shard": [name] * len(documents), "doc_id": pa.array(documents["doc_id"], mask=documents["known"] == 0), "start": starts, "n_tokens": ends - starts,
                "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
            })


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the shard files: doc_id, start (ids of all before it), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.pfb").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    docs = map_arrow(files, _reader, "shard string, doc_id long, start long, n_tokens long, ids_crc32 long")
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("ids"))  # as many rows as there were tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.withColumn("own", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part")
    bases = bases.select("shard", (F.col("before") + F.col("own")).alias("base"))
    return docs.join(bases, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_blocks(docs: DataFrame, path: str, end: int | None = 2) -> DataFrame:
    """Write ``docs`` as token block shards into the shared folder and read every document back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, end, folder), folder)
