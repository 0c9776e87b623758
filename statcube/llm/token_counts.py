"""Token counts by a separator scan of flat token files.

A token file is a flat run of token numbers in which an end-of-document number closes every document; nothing tells where
documents begin. Files are read in blocks. Every block is searched for the separator with one vectorised
comparison; the summaries of the blocks (tokens, separators, place of the last separator) are put together by a prefix scan per file, which gives
each block the number of documents before it and the tokens it has to add to its first document. A document may
so reach over any number of blocks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statcube.llm.bpe import TOKENIZER
from statcube.llm.packing import library_words
from statcube.llm.shared import Query, table, tokenizer_file
from statcube.sources.scratch import materialize, scratch_path

END_OF_DOCUMENT = 49407
BLOCK_TOKENS = 1 << 20
#: Unsigned 16-bit numbers, little-endian; enough for vocabularies of up to 65,536.
TOKEN_TYPE = "<u2"


def write_token_files(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], folder: str, identifier: str = "doc_id", text: str = "text", end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write a flat token file per partition of ``docs``, in blocks, and apart from it the order of the documents.

    ``kind=0`` has ``file``, ``block``, ``tokens``; ``kind=1`` has ``file``, ``first`` (ordinal of the first id) and
    ``ids``. ``encode`` makes, inside a task, a function from a text to little-endian unsigned 32-bit token numbers. A task holds one block.
    """
    id_kind = docs.schema[identifier].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, name = encode(), TaskContext.get().partitionId()
        names = ["kind", "file", "block", "tokens", "first", "ids"]
        held, size, block, first = [], 0, 0, 0

        def row(kind: int, number, tokens, begin, ids: pa.Array, id_type: pa.DataType) -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids) if kind else pa.nulls(1, pa.list_(id_type))
            arrays = [pa.array([kind], pa.int32()), pa.array([name], pa.int64()), pa.array([number], pa.int64()), pa.array([tokens], pa.binary()), pa.array([begin], pa.int64()), lists]
            return pa.RecordBatch.from_arrays(arrays, names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for value in batch.column(1):
                ids = np.frombuffer(coder(value.as_py() or ""), "<u4")
                held.append(np.append(ids, end).astype(TOKEN_TYPE))
                size += len(ids) + 1
                while size >= block_tokens:
                    flat = np.concatenate(held)
                    yield row(0, block, flat[:block_tokens].tobytes(), None, None, id_type)
                    held, size, block = [flat[block_tokens:]], size - block_tokens, block + 1
            if batch.num_rows:
                yield row(1, None, None, first, batch.column(0), id_type)
                first += batch.num_rows
        if size:
            yield row(0, block, np.concatenate(held).tobytes(), None, None, id_type)

    schema = f"kind int, file long, block long, tokens binary, first long, ids array<{id_kind}>"
    rows = docs.select(F.col(identifier), F.col(text)).mapInArrow(write, schema)
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(folder)


def _opened(file: str) -> pa.NativeFile:
    """A file for reading in ranges: local paths directly, other stores by the file system that pyarrow has for them."""
    local = re.match(r"file:/*(/.*)", file, re.DOTALL)
    system, place = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(file)
    return system.open_input_file(place)


def _in_ranges(file: str) -> bool:
    try:
        _opened(file).close()
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def _read_range(file: str, start: int, size: int) -> bytes:
    with _opened(file) as source:
        found = source.read_at(size, start)
    if len(found) != size:
        raise OSError(f"{file} has no {size} bytes at {start}")
    return found


def raw_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, token_type: str = TOKEN_TYPE) -> DataFrame:
    """Blocks of plain binary token files of any size: ``file``, ``block``, ``tokens``.

    Only paths and lengths are listed; each task reads its own byte ranges, one block at a time. That needs a shared folder or a
    store that pyarrow reaches; files of other stores, which only Spark's readers reach, are still read whole (below 2 GB each). Empty files give no block.
    """
    step = block_tokens * np.dtype(token_type).itemsize
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select(F.col("path").alias("file"), "length")
    store = F.regexp_extract("file", r"^([^:/]*:(?://[^/]*)?)", 1)
    stores = files.groupBy(store.alias("store")).agg(F.min("file")).collect()
    others = [r[0] for r in stores if not _in_ranges(r[1])]
    if others:
        content = spark.read.format("binaryFile").load(path).withColumnRenamed("path", "file").filter(store.isin(others) & (F.col("length") > 0))
        whole = content.select("file", F.lit(0).cast("long").alias("block"), F.col("content").alias("tokens"))
        files = files.filter(~store.isin(others))
    ranges = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("block"))
    # With a number, so that adaptive execution does not put these short rows into one task.
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, block in zip(*(column.to_pylist() for column in batch.columns)):
                tokens = _read_range(file, block * step, min(step, length - block * step))
                yield pa.RecordBatch.from_pydict({"file": pa.array([file]), "block": pa.array([block], pa.int64()), "tokens": pa.array([tokens], pa.binary())})

    found = ranges.mapInArrow(read, "file string, block long, tokens binary")
    return found.unionByName(whole) if others else found


def scan_separators(blocks: DataFrame, end: int = END_OF_DOCUMENT, token_type: str = TOKEN_TYPE) -> DataFrame:
    """Documents of token files: ``file``, ``ordinal`` (from 0), ``n_tokens`` (without separator), ``terminated``.

    ``blocks`` has ``file``, ``block`` (any rising numbers) and ``tokens``; blocks hold whole numbers. A missing or
    empty block adds nothing. Tokens after the last separator are a document that is not terminated. Empty documents (two
    separators in a row, or one at the beginning) count. Other columns are ignored; no blocks give an empty result.
    """
    file_kind = blocks.schema["file"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for value in batch.column(2):
                tokens = np.frombuffer(value.as_py() or b"", token_type)
                sizes.append(len(tokens))
                ends.append(np.flatnonzero(tokens == end) + 1)
            edges = np.concatenate([[0], np.cumsum([len(e) for e in ends])]).astype(np.int32)
            flat = np.concatenate(ends).astype(np.int64) if ends else np.zeros(0, np.int64)
            arrays = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "size", "ends"])

    found = materialize(blocks.select("file", "block", "tokens").mapInArrow(scan, f"file {file_kind}, block long, size long, ends array<long>"), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = found.select("file", "block", "size", F.size("ends").alias("n"), F.element_at("ends", F.when(F.size("ends") > 0, F.size("ends"))).alias("last"))
    placed = summary.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.withColumn("closed", F.coalesce(F.max(F.col("at") + F.col("last")).over(before), F.lit(0)))
    stitched = placed.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), (F.col("at") - F.col("closed")).alias("carried"))
    # The length of a document is the way from the separator before it; the first of a block adds what was carried in.
    lengths = F.transform("ends", lambda e, k: e - F.when(k == 0, -F.col("carried")).otherwise(F.get("ends", k - 1)) - 1)
    inside = (
        found.filter(F.size("ends") > 0)
        .join(stitched, ["file", "block"])
        .select("file", "first", F.posexplode(lengths).alias("k", "n_tokens"))
        .select("file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("terminated"))
    )
    open_ends = (
        placed.groupBy("file")
        .agg(F.sum("n").alias("ordinal"), (F.sum("size") - F.coalesce(F.max(F.col("at") + F.col("last")), F.lit(0))).alias("n_tokens"))
        .filter("n_tokens > 0")
        .select("file", "ordinal", "n_tokens", F.lit(False).alias("terminated"))
    )
    return inside.unionByName(open_ends)


def count_tokens(docs: DataFrame, identifier: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id and ``n_tokens``, read from flat token files that are written for it.

    A missing text counts as empty and has no tokens. The separator is a number that no text encodes to: special tokens inside texts are
    encoded as ordinary text. Repeated rows are counted one by one; an empty table gives an empty result.
    """

    def encode() -> Callable[[str], bytes]:
        return library_words(path or tokenizer_file(TOKENIZER), True).encode

    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "tokens")
    id_kind = docs.schema[identifier].dataType.simpleString()
    write_token_files(docs, encode, folder, identifier, text)
    schema = f"file long, block long, tokens binary, first long, ids array<{id_kind}>, kind int"
    written = spark.read.schema(schema).parquet(folder)
    counted = scan_separators(written.filter("kind = 0").select("file", "block", "tokens"))
    order = written.filter("kind = 1").select("file", "first", F.posexplode("ids").alias("k", identifier))
    order = order.select("file", (F.col("first") + F.col("k")).alias("ordinal"), identifier)
    return order.join(counted, ["file", "ordinal"]).select(identifier, "n_tokens")


def op3(spark, folder):
    return count_tokens(table(spark, folder, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op3_token_counts": (op3, None)}
