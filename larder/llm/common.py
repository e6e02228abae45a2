"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.session import scratch_dir

# Bytes of text that vectorised kernels handle at once inside a task.
CHUNK_BYTES = 1 << 19
# Rows of an Arrow batch that an operator turns into Python objects at once.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the plan is
    cut there and a lost executor re-reads files instead of recomputing."""
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, number: str, purpose: str) -> DataFrame:
    """The rows with consecutive numbers from 0, in no stated order.

    They are written once with their place in their task, as a task that runs
    again would number them anew; the starts of the tasks are a prefix sum over
    one row for each task.  The plan reads the written rows."""
    spark = df.sparkSession
    dealt = df.withColumns({"_part": F.spark_partition_id(), "_k": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    dealt = stored(spark, dealt, purpose)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return dealt.join(F.broadcast(starts), "_part").withColumn(number, F.col("_start") + F.col("_k")).drop("_part", "_k", "_start")


def id_fold(doc_id: str | Column, k: int) -> Column:
    """``crc32(doc_id as text) mod k`` (a null id falls in no fold: null)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string")) % k


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a worker's memory
    does not follow the size of a batch."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def rows_where(docs: DataFrame, judge: Callable[[], Callable[[list[str | None]], list[bool]]], text_col: str = "text") -> DataFrame:
    """The rows whose text is judged true, with all their columns as they are.
    Only the text goes to Python, and only the answers come back.

    ``judge`` makes, once in each task, the function that is given at most
    ``SLICE_ROWS`` texts (null as None) at a time."""

    @F.arrow_udf("boolean")
    def decided(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held_by("rows_where")
        keep = judge()
        for texts in batches:
            found: list[bool] = []
            for lo in range(0, len(texts), SLICE_ROWS):
                found += keep(texts.slice(lo, SLICE_ROWS).to_pylist())
            yield pa.array(found, pa.bool_())

    return docs.where(decided(F.col(text_col)))


def text_chunks(texts: list[str | None], limit: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, UTF-8 texts) in runs of about ``limit`` bytes and at
    most ``rows`` texts; a longer text is a run of its own.  Null counts as empty."""
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8") if t else b""
        if run and (size + len(b) > limit or len(run) == rows):
            yield start, run
            start, size, run = i, 0, []
        run.append(b)
        size += len(b)
    if run:
        yield start, run


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) on uint64 arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS = np.ones(1, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        m = max(n, 2 * len(_POWERS))
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, _BASE)]), dtype=np.uint64)
    return _POWERS


def word_hashes(data: np.ndarray, is_word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the maximal runs of word bytes in ``data``.

    ``starts``: the byte where each document begins (a run never crosses it).
    Returns (hash, first byte, end byte) of each word, in order.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    before[starts[starts < n]] = False
    first = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    cut = starts[(starts > 0) & (starts <= n)] - 1
    after[cut] = False
    end = np.flatnonzero(is_word & ~after) + 1
    if len(first) == 0:
        return np.zeros(0, np.uint64), first, end
    at = np.flatnonzero(is_word)
    length = end - first
    offset = np.cumsum(length) - length
    pos = np.arange(len(at)) - np.repeat(offset, length)
    p = _powers(int(length.max()) + 1)
    with np.errstate(over="ignore"):
        h = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * p[pos], offset)
        return mix64(h + length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), first, end


def joined(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a run as one byte array and the byte where each begins."""
    data = np.frombuffer(b"".join(run), dtype=np.uint8)
    starts = np.cumsum([0] + [len(b) for b in run])[:-1]
    return data, starts


# ------------------------------------------------------------------ files


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI or a plain path of the shared folder."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def temporary_name(final: str) -> str:
    return posixpath.join(posixpath.dirname(final), f"_tmp-{uuid.uuid4().hex}-{posixpath.basename(final)}")


def commit_file(filesys, temporary: str, final: str) -> None:
    """Move a whole file to its final name; a repeated attempt replaces it
    with the same bytes."""
    filesys.move(temporary, final)


def write_manifest(uri: str, name: str, content: dict) -> str:
    """The last step of a write: readers trust only files the manifest names."""
    filesys, root = filesystem(uri)
    filesys.create_dir(root, recursive=True)
    final = posixpath.join(root, name)
    tmp = temporary_name(final)
    with filesys.open_output_stream(tmp) as out:
        out.write(json.dumps(content, sort_keys=True).encode())
    commit_file(filesys, tmp, final)
    return final


_HELD: dict[str, dict] = {}


def held_by(operator: str) -> dict:
    """What a worker keeps from task to task for an operator, by key.  Asking
    lets go of what other operators kept there, so that a worker that serves
    them one after another has the memory of one."""
    if operator not in _HELD:
        _HELD.clear()
        _HELD[operator] = {}
    return _HELD[operator]


def arrow_schema(ddl_fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in ddl_fields])
