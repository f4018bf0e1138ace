"""What several operators share: tables in the shared folder, grouped batches, hot groups in blocks."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch_dir

from . import encode


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _return_memory() -> None:
    """Give back what was freed but is still held; allocators keep it for a process that Spark uses again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _tidy(function: Callable, encodes: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            encode.forget()
        _return_memory()
        yield from function(batches)
        _return_memory()

    return run


def map_arrow(df: DataFrame, function: Callable, schema: str, encodes: bool = False) -> DataFrame:
    """``mapInArrow``, with this package sent to the executors so that they can import it.

    Python workers serve one operator after the other. Only functions that encode
    texts (``encodes``) find what a worker remembers of tokenizers; others drop it.
    """
    context = df.sparkSession.sparkContext
    if getattr(context, "_stratalake_sent", None) is None:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="stratalake-")) / "stratalake_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in package.rglob("*.py"):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._stratalake_sent = archive
    return df.mapInArrow(_tidy(function, encodes), schema)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows cut between groups, from batches sorted (or clustered) by ``keys``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        joined = pa.Table.from_batches(held)
        cut = size - 1
        last = [joined[k][cut] for k in keys]
        while cut and all(joined[k][cut - 1] == v for k, v in zip(keys, last, strict=True)):
            cut -= 1
        if cut:
            yield joined.slice(0, cut)
            held = joined.slice(cut).to_batches()
            size -= cut
        else:
            rows = size * 2  # one group fills all of it: look again when it has doubled
    if held:
        yield pa.Table.from_batches(held)


#: Rows of keys (of a few dozen bytes) that may be broadcast to filter a wide table before it is shuffled.
MOST_KEYS = 500_000


def with_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` that are (``left_anti``: are not) in the stored table ``keys``, which is broadcast only if its counted rows allow."""
    few = keys.count() <= MOST_KEYS
    condition = [df[c].eqNullSafe(keys[c]) for c in on]
    return df.join(F.broadcast(keys) if few else keys, condition, how)


def in_blocks(df: DataFrame, keys: list[str], member: str, limit: int) -> DataFrame:
    """Deal the members of each group to pairs of blocks, so that no task gets an unbounded group.

    A group of up to ``limit`` rows is one block, paired with itself (``left_block`` =
    ``right_block`` = 0). A larger one is split by a hash of ``member`` into blocks of
    about ``limit`` rows; each row goes to every pair its ``block`` takes part in, so
    that two members of a group meet in exactly one pair of blocks: within one block
    where both blocks of the pair are the same, else only across the two.
    """
    large = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit), "hot-groups")
    dealt = df.join(large, keys, "left").withColumn(
        "__n", F.coalesce(F.ceil(F.col("__n") / limit), F.lit(1)).cast("int")
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(member, F.lit(7)), F.col("__n")).cast("int"))
    other = dealt.withColumn("__other", F.explode(F.expr("sequence(0, __n - 1)")))
    return other.select(
        *df.columns,
        "block",
        F.least("block", "__other").alias("left_block"),
        F.greatest("block", "__other").alias("right_block"),
    )
