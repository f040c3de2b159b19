"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One linear classifier per bit, trained
with the logistic loss on hashed letter n-grams, says how likely the bit is
set. A text gets the language whose codeword has the smallest loss, the bits
weighted by how well their classifiers did on sampled rows kept out of the
training. A text whose two best codewords lie close is flagged as ambiguous.

``und`` with score 0 if a text is null or has no letter. Repeated rows get
alike results; rows with a null id are kept. Rows with a null language or text
are not learnt from. Without any language to learn, every text is ``und``;
with a single one, every text with letters is that language. Texts are read whole, in blocks, however long.
Of equally near codewords the first language by name is taken. An empty table
gives no rows. Other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

UNDETERMINED = "und"
SPACE = 32


@dataclass(frozen=True)
class Params:
    """``rows_per_language`` is about how many rows of a language are learnt
    from, ``sample_rows`` bounds them all."""

    rows_per_language: int = 500
    sample_rows: int = 6000
    buckets: int = 1 << 13
    epochs: int = 150
    rate: float = 0.5
    decay: float = 1e-5
    kept_out: int = 4          # every fourth sampled row weighs the bits
    ambiguous_margin: float = 0.1
    seed: int = 5


@dataclass
class Model:
    params: Params
    languages: list[str]
    codes: np.ndarray      # languages x bits, -1 or 1
    weights: np.ndarray    # buckets x bits
    bias: np.ndarray
    bit_weight: np.ndarray


def codewords(n: int, seed: int) -> np.ndarray:
    """All splits of up to five languages in two; beyond, of many random
    codes of some 10 log2(n) bits, the one whose nearest words lie farthest apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = [[1 if k >> i & 1 else -1 for i in range(n)] for k in range(1, 2 ** (n - 1))]
        return np.array(splits, float).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, reach = None, -1.0
    for _ in range(50):
        code = np.where(rng.random((n, bits)) < 0.5, -1.0, 1.0)
        code[0, np.abs(code.sum(0)) == n] *= -1  # a bit must tell something apart
        apart = bits - code @ code.T
        np.fill_diagonal(apart, 2 * bits)
        if apart.min() > reach:
            best, reach = code, apart.min()
    return best


_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> code point of the small letter, or a space for what is no letter."""
    if not _FOLD:
        t = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(t)
    return _FOLD[0]


def ngrams(text: str | None, buckets: int) -> np.ndarray | None:
    """Counts of hashed 1-, 2- and 3-grams of a whole text, scaled to length
    one; None if the text has no letter. Runs of other characters are one space."""
    if not text:
        return None
    total = np.zeros(buckets, np.float64)
    fold, letters, before = fold_table(), False, np.array([SPACE], np.uint64)
    step = 1 << 20  # characters of a block, so that a long text needs no more memory
    for low in range(0, len(text), step):
        c = fold[np.frombuffer(text[low:low + step].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        letters = letters or bool((c != SPACE).any())
        c = np.concatenate([before, c])
        c = c[np.append(True, (c[1:] != SPACE) | (c[:-1] != SPACE))]
        if len(c) > 2:
            m = np.uint64(buckets - 1)
            one, two = c[2:], c[1:-1] * np.uint64(0x9E3779B1)
            three = c[:-2] * np.uint64(0x85EBCA6B85EBCA77)
            for h in (one * np.uint64(0xC2B2AE3D27D4EB4F), one * np.uint64(0x27D4EB2F165667C5) + two,
                      one * np.uint64(0x165667B19E3779F9) + two + three):
                total += np.bincount(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
                                      & m).astype(np.int64), minlength=buckets)
        before = c[-2:]
    if not letters:
        return None
    norm = np.sqrt((total * total).sum())
    return (total / norm if norm else total).astype(np.float32)


def fit_arrays(params: Params, x: np.ndarray, langs: list[str]) -> Model:
    """Train the bits on feature rows and their languages."""
    languages = sorted(set(langs))
    codes = codewords(len(languages), params.seed)
    y = codes[[languages.index(v) for v in langs]]
    out = np.arange(len(x)) % params.kept_out == 0
    if len(x) < 20 or len(set(np.array(langs)[~out])) < len(languages):
        out[:] = False
    w, b = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    seen = np.full_like(w, 1e-6)
    xt, yt = x[~out], y[~out]
    for _ in range(params.epochs):  # whole-sample adaptive steps
        g = (-yt / (1 + np.exp(np.clip(yt * (xt @ w + b), -30, 30)))).astype(np.float32) / max(len(xt), 1)
        gw = xt.T @ g + params.decay * w
        seen += gw * gw
        w -= params.rate * gw / np.sqrt(seen)
        b -= params.rate * g.sum(0)
    xo, yo = (x[out], y[out]) if out.any() else (xt, yt)
    right = ((xo @ w + b) * yo > 0).mean(0)
    weight = np.clip(2 * right - 1, 0.05, 1.0)
    return Model(params, languages, codes, w, b, weight / weight.sum())


def fit(labelled: DataFrame, params: Params | None = None) -> Model | None:
    """``labelled``: doc_id, text, lang. The tasks turn sampled rows into
    features of a fixed size; the driver gets those of a bounded sample."""
    params = params or Params()
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()) \
        .select("text", "lang", F.xxhash64("doc_id", "lang").alias("h"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").limit(params.sample_rows).collect()}
    if not counts:
        return None
    quota = min(params.rows_per_language, max(1, params.sample_rows * 4 // (5 * len(counts))))
    share = F.lit(1.0)
    for lang, n in counts.items():
        if n > quota:
            share = F.when(F.col("lang") == lang, F.lit(quota / n)).otherwise(share)
    some = rows.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).limit(params.sample_rows)
    buckets = params.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(v, h, f.astype(np.float16).tobytes()) for t, v, h in zip(*(c.to_pylist() for c in batch.columns))
                     if (f := ngrams(t, buckets)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in found], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.binary()))],
                ["lang", "h", "features"])

    got = sorted(some.mapInArrow(run, "lang string, h long, features binary").collect(),
                 key=lambda r: (r["h"], r["lang"], bytes(r["features"])))
    if not got:
        return None
    x = np.stack([np.frombuffer(r["features"], np.float16) for r in got]).astype(np.float32)
    return fit_arrays(params, x, [r["lang"] for r in got])


def decide(model: Model | None, text: str | None) -> tuple[str, float, bool]:
    """Language, score from 0 to 1, and whether the best two lie close."""
    x = ngrams(text, model.params.buckets) if model else None
    if x is None:
        return UNDETERMINED, 0.0, True
    at = np.flatnonzero(x)
    margin = x[at] @ model.weights[at] + model.bias
    loss = np.log1p(np.exp(np.clip(-model.codes * margin, -30, 30))) @ model.bit_weight
    like = np.exp(-(loss - loss.min()) * len(model.bit_weight))
    like /= like.sum()
    best = int(loss.argmin())
    rest = np.delete(like, best)
    return model.languages[best], float(like[best]), bool(len(rest) and like[best] - rest.max() < model.params.ambiguous_margin)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, ambiguous`` per row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x bits and buckets x bits: bounded by Params
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decide(shared.value, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_())))],
                ["row_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"row_id {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("row_id", id_col)
