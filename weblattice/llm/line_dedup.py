"""Substring dedup by unit hashing.

A text is cut into units: paragraphs, lines, or sentences of lines (so that a
passage put into the middle of a line is still found), or of two kinds at
once ("line+sentence"), which are ranked apart: a line only meets lines, so
that each removed unit has its like in what stays. Units are normalised
(A-Z in small letters, runs of white space as one space, no blanks or .!? at
the end) and those of ``min_words`` words or more are hashed to 128 bits. Of
each digest, over all documents, the earliest ranked occurrence stays, by
document id, then offset; all others are removed, with their offsets in the
original text (code points, end exclusive).

Null and empty texts have no unit. Null ids rank after all others. Of rows
that repeat an id, ties at the same offset go to the one that is read first.
Texts are cut whole, however long. An empty table has no repeats. Other
columns are never read by ``repeats``, whatever their names;
``without_repeats`` hands the columns of documents on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Each pattern's matches, end to end, are the whole text.
UNITS = {
    "paragraph": re.compile(r"(?:[^\n]|\n(?!\n))+\n*|\n+"),
    "line": re.compile(r"[^\n]+\n*|\n+"),
    "sentence": re.compile(r"[^\n.!?]+[\n.!?]*|[\n.!?]+"),
}
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACES = re.compile(r"[ \t\r\n\f\v]+")


def normalised(unit: str) -> str:
    return SPACES.sub(" ", unit.translate(LOWER)).strip(" .!?")


def units(docs: DataFrame, unit: str, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, start, end, n_words, digest`` of all units that count."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    cuts = [(UNITS[name], name.encode() if k else b"") for k, name in enumerate(unit.split("+"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                of, start, end, words, digest = [], [], [], [], []
                for i, text, (cut, salt) in ((i, t, c) for i, t in enumerate(part.column(1).to_pylist()) for c in cuts):
                    at = 0
                    for piece in cut.findall(text or ""):
                        here, at = at, at + len(piece)
                        plain = normalised(piece)
                        n = plain.count(" ") + 1 if plain else 0
                        if n >= min_words:
                            of.append(i)
                            start.append(here)
                            end.append(at)
                            words.append(n)
                            digest.append(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16, salt=salt).digest())
                take = pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(2).take(take), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                     pa.array(words, pa.int32()), pa.array(digest, pa.binary())],
                    ["id", "text_hash", "start", "end", "n_words", "digest"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")) \
        .mapInArrow(run, f"id {kind}, text_hash bigint, start bigint, end bigint, n_words int, digest binary")


def repeats(docs: DataFrame, unit: str = "sentence", min_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_hash, start, end, n_words, kept_id, kept_start``: every
    occurrence but the earliest of each digest. Digests are pre-aggregated in
    the tasks that read; the join back is one that skew handling can split."""
    found = written(units(docs, unit, min_words, id_col, text_col)
                    .withColumn("row", F.monotonically_increasing_id()), "dedup-units")
    rank = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("start").alias("start"), F.col("row").alias("row"))
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1") \
        .select(F.col("digest").alias("of_digest"), "first")
    return found.join(first, F.col("digest") == F.col("of_digest")).where(F.col("row") != F.col("first.row")).select(
        F.col("id").alias(id_col), "text_hash", "start", "end", "n_words",
        F.col("first.id").alias("kept_id"), F.col("first.start").alias("kept_start"))


def without_repeats(docs: DataFrame, unit: str = "sentence", min_words: int = 8) -> DataFrame:
    """``docs`` (columns of documents) with the repeated units cut out of the
    texts; a text that is nothing but repeats becomes empty. The spans of a
    document, no more than its units, travel to it in one row; where they
    overlap, the later one starts at the end of those before. Rows that repeat
    both id and text all lose the spans of any of them."""
    spans = repeats(docs, unit, min_words).groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")) \
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("gone"))
    done = "coalesce(try_element_at(a, -1).end, 0L)"
    spans = spans.withColumn("gone", F.expr(
        "aggregate(gone, cast(array() as array<struct<start: bigint, end: bigint>>), (a, x) -> concat(a, array("
        f"named_struct('start', greatest(x.start, {done}), 'end', greatest(x.end, {done})))))"))
    text = F.col("text").cast("string")
    joined = docs.withColumn("__hash", F.xxhash64(text)).join(
        spans, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("__hash") == F.col("of_hash")), "left")
    # Keep what lies between the ends of one span and the start of the next.
    edges = "concat(array(named_struct('start', 0L, 'end', 0L)), gone, array(named_struct('start', cast(length(text) as bigint), 'end', 0L)))"
    parts = f"transform(sequence(0, size(gone)), k -> substring(text, cast({edges}[k].end + 1 as int), cast({edges}[k + 1].start - {edges}[k].end as int)))"
    return joined.withColumn("text", F.expr(f"if(gone is null, text, array_join({parts}, ''))")).select(*docs.columns)
