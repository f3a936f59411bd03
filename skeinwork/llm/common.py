"""Pieces that the training-data operators share: shared-folder tables, input columns, Arrow word views."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and normalisation rules: space, tab, newline, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; set here only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="skeinwork-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Within it, the shuffle files of an action go as soon as the action ends; the session's own setting returns after."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


_SCRATCH: contextvars.ContextVar[list | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch():
    """Tables that operators write within it go when it ends, so act on what they return inside it.

    Without it, what a returned DataFrame reads stays in the shared folder.
    """
    held: list = []
    token = _SCRATCH.set(held)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        release(*held)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/skeinwork/{name}-{uuid.uuid4().hex}"
    with shuffle_cleanup(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    if (held := _SCRATCH.get()) is not None:
        held.append(table)
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of write_table whose readers have all been written themselves; what a returned DataFrame reads stays."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A key with more rows than this, and than 1/1000 of all, is dealt over several tasks; so there are at most 1000 such keys.
HOT_ROWS, HOT_KEYS = 1000, 1000


def hot_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", n: str = "n", sizes: DataFrame | None = None) -> DataFrame:
    """big joined to small (one row for each key), without hot tasks; column n of small, or of sizes, counts a key's rows in big.

    Rows of a hot key are dealt over as many tasks as they are times too many, and small's row goes to each of these.
    Hot keys are at most HOT_KEYS by their definition, so the broadcast list of them is bounded whatever the data's size.
    """
    sizes = small if sizes is None else sizes
    total, most = sizes.agg(F.sum(n), F.max(n)).first()
    cut = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= cut:
        return big.join(small.hint("merge"), key, how)
    hot = F.broadcast(sizes.where(F.col(n) > cut).select(F.col(key).alias("__key"), F.ceil(F.col(n) / cut).cast("int").alias("__copies")))
    copies = F.coalesce("__copies", F.lit(1))
    deal = F.when(F.col("__copies") > 1, F.pmod(F.xxhash64(*big.columns), copies)).otherwise(0).cast("int")
    many = big.join(hot, big[key].eqNullSafe(F.col("__key")), "left").withColumn("__deal", deal).drop("__key", "__copies")
    few = small.join(hot, small[key].eqNullSafe(F.col("__key")), "left").withColumn("__deal", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__key", "__copies")
    return many.join(few.hint("merge"), [key, "__deal"], how).drop("__deal")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator needs, so that extra columns can't clash; a null text is empty."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def without_spaces(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def batches_by_bytes(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.Table]:
    """Deal rows out again into tables of about `limit` bytes of `column`; one longer row makes a table of its own."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        begin, base = 0, 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, base + limit - size, side="right"))
            if end == begin:
                if held:  # full: give out what is held, then look at this row again
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    continue
                end = begin + 1
            held.append(batch.slice(begin, end - begin))
            size += int(ends[end - 1] - base)
            begin, base = end, int(ends[end - 1])
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def flat_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the rows' bounds (one more than rows). Null rows are empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if arr.buffers()[2] is not None and len(arr) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True


def word_spans(data: np.ndarray, bounds: np.ndarray, ink: np.ndarray | None = None, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row numbers of the words; rows end words.

    Words are runs of the bytes in `ink` (of others than SPACES, if not given); a byte in `breaks` begins a word anew.
    """
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    ink = ~_SPACE[data] if ink is None else ink
    first = ink.copy()
    first[1:] &= ~ink[:-1] if breaks is None else ~ink[:-1] | breaks[1:]
    starts_of_rows = bounds[:-1][(bounds[:-1] < len(data)) & (np.diff(bounds) > 0)]
    first[starts_of_rows] = ink[starts_of_rows]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(bounds, starts, side="right") - 1
    return starts, ends, rows


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words within this batch (equal bytes, equal number) and the distinct words."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    full = ends > starts  # their starts differ from one another, and so do their ends
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts[full]] += 1
    mark[ends[full]] -= 1
    packed = data[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A strong mixing of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of the distinct words' bytes, the same on every machine."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
