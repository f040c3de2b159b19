"""Token counts of flat token files that have no index, by a separator scan.

A file is one run of token ids, each document's followed by the
end-of-document id. It is read in blocks of a fixed number of tokens, cut
without regard to documents. Each block's separators are found at once with
numpy; a prefix scan over the blocks of a file, by way of super-blocks so that
a single huge file is no bottleneck, tells each block how many tokens lie
before it and where the last separator before it is. With that, the documents
that cross blocks are stitched together.

Tokens after the last separator of a file are a document that is not
terminated. Two separators in a row enclose a document of no tokens. A file
of no tokens has no documents. A file whose size is no multiple of the token
width is an error. Null
and empty texts are documents of no tokens; a null id stays null, and rows
that repeat an id are counted row by row. Long texts are encoded whole. An
empty table gives no rows. Other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import ship, written

BLOCK_TOKENS = 1 << 18
SUPER = 1024      # blocks in a super-block
TASK_BYTES = 1 << 25  # that a task reads of raw files, about


def flat_blocks(docs: DataFrame, vocab_path: str, eod: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat token files of documents, one for each partition: ``file, block,
    content`` and, for later labelling only, ``ended``: ids of the documents
    whose separator lies in the block. Texts are encoded as ordinary text, so
    the separator never comes from one. Null texts count as empty."""
    name = bpe.ship_vocabulary(docs.sparkSession, vocab_path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(name, True)
        end = np.array([eod], f"<u{width}").tobytes()
        size, file = block_tokens * width, TaskContext.get().partitionId()
        rest, block, ended, kind_of = bytearray(), 0, [], None
        last: list = []

        def out(content: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([content], pa.binary()),
                 pa.array([last], pa.list_(kind_of))], ["file", "block", "content", "ended"])

        for batch in batches:
            kind_of = batch.schema.types[0]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(coder.encode(text), "<u4")
                rest += ids.astype(f"<u{width}").tobytes() if width != 4 else ids.tobytes()
                rest += end
                ended.append(((block * size) + len(rest) - 1, i))
                while len(rest) >= size:
                    border = (block + 1) * size
                    last = [x for at, x in ended if at < border]
                    ended = ended[len(last):]
                    yield out(bytes(rest[:size]))
                    del rest[:size]
                    block += 1
        if rest:
            last = [x for _, x in ended]
            yield out(bytes(rest))

    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"file bigint, block bigint, content binary, ended array<{kind}>")


def opened(uri: str) -> pa.NativeFile:
    """A file of the Hadoop file system, by Arrow's reader of its store."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, path = fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest))
    return store.open_input_file(path)


def has_ranges(uri: str) -> bool:
    try:
        opened(uri).close()
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def read_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, content`` of raw flat files under ``path``, of any size:
    only lengths are listed, and tasks read their blocks' own byte ranges. In a
    store that Arrow cannot open (HDFS without libhdfs), a task reads a file as
    one value instead, so there files are shards of at most some 100 MB."""
    size = block_tokens * width
    files = spark.read.format("binaryFile").load(path)
    whole = F.assert_true(F.col("length") % width == 0, F.concat(F.lit("size is no multiple of the token width: "), "path"))
    files = files.where(whole.isNull() & (F.col("length") > 0))
    blocks = F.explode(F.expr(f"sequence(0L, cast((length - 1) div {size} as bigint))")).alias("block")
    some = files.select("path").first()
    if some and not has_ranges(some["path"]):
        return files.select(F.col("path").alias("file"), "content", blocks) \
            .select("file", "block", F.expr(f"substring(content, cast(block * {size} + 1 as int), {size})").alias("content"))
    total = files.agg(F.sum("length")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = None
        for batch in batches:
            for uri, length, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if uri != name:
                    name, file = uri, opened(uri)
                content = file.read_at(want := min(size, length - block * size), block * size)
                if len(content) != want:
                    raise OSError(f"{uri} ends before byte {block * size + want}")
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([block], pa.int64()), pa.array([content], pa.binary())],
                                                 ["file", "block", "content"])

    ship(spark)
    return files.select("path", "length", blocks).repartition(1 + total // TASK_BYTES) \
        .mapInArrow(run, "file string, block bigint, content binary")


def scan(blocks: DataFrame, eod: int, width: int = 2) -> DataFrame:
    """``file, block, nth, first_token, n_tokens, terminated``: each document,
    with the block and the place among the block's separators at which it
    ends (for the last, unterminated one: after all separators)."""
    ship(blocks.sparkSession)
    kind = blocks.schema["file"].dataType.simpleString()

    def separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for content in batch.column(2):
                ids = np.frombuffer(content.as_buffer(), f"<u{width}")
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == eod))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                ["file", "block", "size", "ends"])

    found = written(blocks.select("file", "block", "content").mapInArrow(
        separators, f"file {kind}, block bigint, size bigint, ends array<bigint>"), "token-separators")
    part = F.floor(F.col("block") / SUPER)
    last = F.array_max("ends")
    rows = found.select("file", "block", "size", "ends", part.alias("part"))
    # Within a super-block: tokens before each block, and the last separator before it.
    inside = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .withColumn("own_last", last + F.col("before")) \
        .withColumn("carry", F.max("own_last").over(inside))
    # Over super-blocks: the same, from one row of each.
    over = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    supers = rows.groupBy("file", "part").agg(F.sum("size").alias("part_size"), F.max("own_last").alias("part_last"),
                                              F.max("block").alias("top_block")) \
        .withColumn("offset", F.coalesce(F.sum("part_size").over(over), F.lit(0))) \
        .withColumn("global_last", F.col("part_last") + F.col("offset")) \
        .withColumn("part_carry", F.max("global_last").over(over))
    ends = supers.groupBy("file").agg(F.max("part").alias("final_part"))
    supers = supers.join(ends, "file").select(
        F.col("file").alias("f"), F.col("part").alias("p"), "offset", "part_carry",
        F.when(F.col("part") == F.col("final_part"), F.col("top_block")).alias("final_block"))
    placed = rows.join(supers, F.col("file").eqNullSafe(F.col("f")) & (F.col("part") == F.col("p"))).select(
        "file", "block", (F.col("before") + F.col("offset")).alias("at"), "size", "ends",
        F.coalesce(F.col("carry") + F.col("offset"), "part_carry", F.lit(-1)).alias("carry"),
        (F.col("block") == F.col("final_block")).alias("final"))
    # A final block's own tokens after its last separator close the file.
    open_end = F.coalesce("final", F.lit(False)) & (F.coalesce(F.array_max("ends"), F.lit(-1)) < F.col("size") - 1)
    stops = F.concat(F.transform("ends", lambda e: e + F.col("at")), F.when(open_end, F.array(F.col("at") + F.col("size"))).otherwise(F.array()))
    return placed.withColumn("stops", stops).withColumn("n_ends", F.size("ends")) \
        .select("file", "block", "carry", "stops", "n_ends", F.posexplode("stops").alias("nth", "stop")) \
        .withColumn("first_token", F.when(F.col("nth") == 0, F.col("carry")).otherwise(F.element_at("stops", F.col("nth"))) + 1) \
        .select("file", "block", "nth", "first_token", (F.col("stop") - F.col("first_token")).alias("n_tokens"),
                (F.col("nth") < F.col("n_ends")).alias("terminated"))


def counts(docs: DataFrame, vocab_path: str, eod: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, n_tokens, file, first_token``: documents written as flat
    files, scanned, and labelled with the ids they were written from."""
    blocks = written(flat_blocks(docs, vocab_path, eod, 2, block_tokens), "flat-tokens")
    found = scan(blocks, eod)
    names = blocks.select(F.col("file").alias("f"), F.col("block").alias("b"), F.posexplode("ended").alias("k", "doc_id"))
    return found.join(names, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.col("nth") == F.col("k"))) \
        .select("doc_id", "n_tokens", "file", "first_token")
