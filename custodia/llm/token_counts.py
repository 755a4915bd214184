"""Token counts by a scan for separators in flat, unindexed token files.

Token files hold nothing but little-endian ids; an end-of-document id follows
each document. Every block of a file is searched for it with numpy, and a prefix
scan over the blocks' separator counts stitches documents that cross blocks.

Defined results: an empty or null text counts 0 tokens; equal rows count one by
one; an empty table gives an empty table; tokens after a file's last separator
are one more document, none there is no document. Only the id and the text of a
table are read. Files of failed task attempts are never listed, so never counted.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.llm.byte_bpe import broadcast_codec
from custodia.llm.common import like, text_chunks

#: Bytes of a block; a task holds one at a time.
BLOCK_BYTES = 4_000_000


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with the scheme and host of the file system that Spark takes it for."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    name = store.makeQualified(path).toString()
    return f"file://{name.removeprefix('file:')}" if name.startswith("file:/") and not name.startswith("file://") else name


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def id_type(largest: int) -> np.dtype:
    """The smallest type for ids in a file."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def write_token_files(docs: DataFrame, ranks_path: str, separator: int, folder: str) -> DataFrame:
    """Encode documents into flat token files below a shared folder.

    Returns which document is where: file, ordinal in it, doc_id. Write that
    table once before use: its rows name the files of the attempts that count.
    """
    held = broadcast_codec(docs.sparkSession, ranks_path)
    kind = id_type(max(separator, len(held.value.first_token)))
    folder = qualified(docs.sparkSession, folder)
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held.value
        path = f"{folder}/{uuid.uuid4().hex}.tokens"
        out, ordinal = None, 0
        for batch, texts in text_chunks(batches):
            if out is None:
                store, name = _open(path)
                store.create_dir(name.rpartition("/")[0])
                out = store.open_output_stream(name)
            ids, first = codec.encode(texts)
            out.write(np.insert(ids, first[1:], separator).astype(kind).tobytes())
            numbers = np.arange(ordinal, ordinal + len(texts))
            ordinal += len(texts)
            yield like({"file": [path] * len(texts), "ordinal": numbers, "doc_id": batch.column(0)}, schema)
        if out is not None:
            out.close()

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(write, "file string, ordinal long, doc_id long")


def count_tokens(files: DataFrame, separator: int, largest: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Tokens per document of the files named in column ``file``: file, ordinal, n_tokens."""
    kind = id_type(max(separator, largest))
    block_bytes -= block_bytes % kind.itemsize

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [store.get_file_info(name).size for store, name in map(_open, paths)]
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(found, pa.int64())], ["file", "n_bytes"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, name = _open(file)
                with store.open_input_file(name) as stream:
                    ids = np.frombuffer(stream.read_at(min(block_bytes, stream.size() - start), start), kind)
                ends = np.flatnonzero(ids == separator)
                lengths = np.diff(ends, prepend=-1, append=len(ids)) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([start], pa.int64()), pa.array([lengths.tolist()], pa.list_(pa.int64()))],
                    ["file", "start", "lengths"],
                )

    sized = files.select("file").distinct().mapInArrow(sizes, "file string, n_bytes long")
    starts = F.explode(F.expr(f"sequence(0L, greatest(n_bytes - 1, 0L), {block_bytes}L)"))
    blocks = sized.select("file", starts.alias("start"))
    scanned = blocks.repartition("file", "start").mapInArrow(scan, "file string, start long, lengths array<long>")
    # The prefix scan: separators in earlier blocks of the file number a block's first document.
    n_ends = F.size("lengths") - 1
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    numbered = scanned.select(
        "file",
        "lengths",
        F.coalesce(F.sum(n_ends).over(earlier), F.lit(0)).alias("before"),
        F.sum(n_ends).over(W.partitionBy("file")).alias("n_ended"),
    )
    parts = numbered.select("file", "before", "n_ended", F.posexplode("lengths").alias("place", "n"))
    whole = parts.groupBy("file", (F.col("before") + F.col("place")).alias("ordinal"), "n_ended").agg(
        F.sum("n").alias("n_tokens")
    )
    return whole.filter("ordinal < n_ended OR n_tokens > 0").select("file", "ordinal", "n_tokens")
