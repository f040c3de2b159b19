"""Text quality by a generalised additive model with pairwise interactions.

A text becomes a row of measures (``FEATURES``: sizes, shares of kinds of
characters and words, repetition). Each measure is cut into bins at quantiles.
The model is a sum of lookup tables, one per measure and one per chosen pair of
measures, through a logistic link:

* *Main tables* are learnt by cyclic boosting. Round by round, and measure by
  measure within a round, a tree of two levels over the measure's bins is fit
  to the gradient of the log loss and a small share of it is added to the
  table, so that no measure can explain away another by coming first.
* *Pairs* are chosen by what one cut in each measure would still gain on the
  residuals; their two-dimensional tables are boosted in the same way, with
  trees of two levels that cut along either measure.
* Rounds end when the log loss on a held-back share of the sample stops
  falling; the tables of the best round stay.

Scoring computes the measures of many texts at once, looks up their bins, and
adds table entries: no tree is walked. Everything is linear in the text, which
is read whole; long texts are counted in blocks.

Labels are learnt from a bounded sample (``Params.sample_rows``, drawn by a
hash of the id, half of each class and weighted back to the classes' shares);
only its measures, not its texts, reach the driver. Of an id with several
labels the larger counts, labels other than 0 and 1 and null ids are not
learnt from. Without any label every score is 0.5; with one class only, the
share of that class, smoothed. Null, empty and blank texts have defined
measures (zeros for empty ones) and are scored like others. Rows that repeat
an id each have their score, equal texts equal scores, and a null id stays
null. Empty tables give no rows. Other columns are never read, whatever their
names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, ship

FEATURES = (
    "log_chars", "log_words", "word_bytes", "word_bytes_spread", "log_longest_word", "blanks", "capitals", "digits",
    "marks", "wide", "words_with_marks", "words_of_marks", "repeated_bytes", "tripled_bytes", "sentence_ends",
    "capitalised", "short_words", "distinct_words", "commonest_word", "lines_a_word", "distinct_lines", "entropy",
)
CHUNK_BYTES = 4_000_000  # texts are measured together up to so many bytes
BLOCK = 1 << 22          # bytes counted at once

_BYTE = np.arange(256)
_BLANK = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_CAPITAL = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _CAPITAL | ((_BYTE >= 97) & (_BYTE <= 122))
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_WIDE = _BYTE >= 128
_MARK = ~(_BLANK | _LETTER | _DIGIT | _WIDE)
_INSIDE = (_BYTE & 0xC0) == 0x80  # bytes that continue a character
_END = np.isin(_BYTE, [33, 46, 63])


@dataclass(frozen=True)
class Params:
    sample_rows: int = 12_000
    bins: int = 48
    pairs: int = 12
    rounds: int = 400
    rate: float = 0.15
    least_weight: float = 4.0     # of the second derivatives in a leaf
    check_share: int = 5          # every so many rows tell when to stop
    patience: int = 25


@dataclass
class Model:
    base: float                                      # log odds
    cuts: list[np.ndarray] = field(default_factory=list)      # inner bin limits of each measure
    mains: list[np.ndarray] = field(default_factory=list)     # one value a bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)    # one value a pair of bins


def measures(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text (UTF-8)."""
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    # Texts end to end, each closed by one blank, which is taken off again.
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + 1) - (size + 1)
    counts = np.zeros(n * 256, np.int64)
    for low in range(0, len(buffer), BLOCK):
        part = buffer[low:low + BLOCK]
        of = np.searchsorted(begin, np.arange(low, low + len(part)), side="right") - 1
        counts += np.bincount(of * 256 + part, minlength=n * 256)
    counts = counts.reshape(n, 256)
    counts[:, 32] -= 1
    total = np.maximum(size, 1)

    blank = _BLANK[buffer]
    edge = np.diff(blank.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    of = np.searchsorted(begin, starts, side="right") - 1
    words = np.bincount(of, minlength=n)
    each = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    marks = np.concatenate([[0], np.cumsum(_MARK[buffer], dtype=np.int64)])
    own_marks = marks[ends] - marks[starts]

    def share(of_words: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=of_words, minlength=n) / each

    same = np.concatenate([[False], buffer[1:] == buffer[:-1]]) & ~blank
    triple = same & np.concatenate([[False], same[:-1]])
    mean = share(length)
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    p = counts / total[:, None]
    chars = size - counts[:, _INSIDE].sum(1)
    distinct, commonest, lines, distinct_lines = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i, text in enumerate(texts):
        seen = Counter(text.split())
        distinct[i], commonest[i] = len(seen), max(seen.values(), default=0)
        cut = text.split(b"\n")
        lines[i], distinct_lines[i] = len(cut), len(set(cut))
    columns = {
        "log_chars": np.log1p(chars), "log_words": np.log1p(words), "word_bytes": mean,
        "word_bytes_spread": np.sqrt(np.maximum(share(length * length) - mean * mean, 0)),
        "log_longest_word": np.log1p(longest),
        "blanks": counts[:, _BLANK].sum(1) / total, "capitals": counts[:, _CAPITAL].sum(1) / total,
        "digits": counts[:, _DIGIT].sum(1) / total, "marks": counts[:, _MARK].sum(1) / total,
        "wide": counts[:, _WIDE].sum(1) / total,
        "words_with_marks": share(own_marks > 0), "words_of_marks": share(own_marks == length),
        "repeated_bytes": np.add.reduceat(same, begin, dtype=np.int64) / total,
        "tripled_bytes": np.add.reduceat(triple, begin, dtype=np.int64) / total,
        "sentence_ends": share(_END[buffer[ends - 1]]), "capitalised": share(_CAPITAL[buffer[starts]]),
        "short_words": share(length <= 3), "distinct_words": distinct / each, "commonest_word": commonest / each,
        "lines_a_word": np.where(size > 0, lines / each, 0), "distinct_lines": np.where(size > 0, distinct_lines / np.maximum(lines, 1), 0),
        "entropy": -(p * np.log2(np.where(p > 0, p, 1))).sum(1),
    }
    for k, name in enumerate(FEATURES):
        out[:, k] = columns[name]
    return out


def measured(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``id, values`` and the columns ``more`` per row of ``docs``."""
    ship(docs.sparkSession)
    kinds = [(c, docs.schema[c].dataType.simpleString()) for c in more]
    schema = ", ".join([f"id {docs.schema[id_col].dataType.simpleString()}", "values array<double>", *(f"`{c}` {k}" for c, k in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in chunks(batch.column(1)):
                x = measures(texts)
                ends = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
                rows = batch.slice(low, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel())), *rows.columns[2:]],
                    ["id", "values", *more])

    text = F.col(text_col).cast("string").cast("binary").alias("text")
    return docs.select(F.col(id_col).alias("id"), text, *more).mapInArrow(run, schema)


def chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a column (null: empty) with their first row, by bounded size."""
    low, texts, size = 0, [], 0
    for cell in column:
        text = cell.as_py() or b""
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES or len(texts) >= 1000:
            yield low, texts
            low, texts, size = low + len(texts), [], 0
    if texts:
        yield low, texts


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], 1) if cuts \
        else np.zeros((len(x), 0), np.int64)


def log_odds(model: Model, x: np.ndarray) -> np.ndarray:
    """Sums of table entries."""
    z = np.full(len(x), model.base)
    if model.cuts:
        b = binned(x, model.cuts)
        for j, table in enumerate(model.mains):
            z += table[b[:, j]]
        for (j, k), table in zip(model.pairs, model.tables):
            z += table[b[:, j], b[:, k]]
    return z


def score(model: Model, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds(model, x), -500, 500)))


def best_cut(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int, int]:
    """``gain, axis, place`` of the best cut of a table of gradient sums and
    second derivatives; place 0 when none is allowed."""
    best = (0.0, 0, 0)
    whole = g.sum() ** 2 / (h.sum() + 1)
    for axis in (0, 1):
        gl, hl = np.cumsum(g.sum(1 - axis))[:-1], np.cumsum(h.sum(1 - axis))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = np.where((hl >= least) & (hr >= least), gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - whole, 0)
        if len(gain) and gain.max() > best[0] + 1e-12:
            best = (float(gain.max()), axis, int(gain.argmax()) + 1)
    return best


def tree(g: np.ndarray, h: np.ndarray, least: float, depth: int = 2) -> np.ndarray:
    """The leaf value of each cell for a tree of so many levels."""
    _, axis, place = best_cut(g, h, least) if depth else (0, 0, 0)
    if not place:
        return np.full(g.shape, -g.sum() / (h.sum() + 1))
    cut = (slice(None, place), slice(place, None)) if axis == 0 else ((slice(None), slice(None, place)), (slice(None), slice(place, None)))
    out = np.empty(g.shape)
    for side in cut:
        out[side] = tree(g[side], h[side], least, depth - 1)
    return out


def crossed_gain(g: np.ndarray, h: np.ndarray) -> float:
    """What the best cut in each of two measures at once gains over the same
    cuts made apart: four corners against rows and columns."""
    def corners(t: np.ndarray) -> list[np.ndarray]:
        c = t.cumsum(0).cumsum(1)
        a, b, d = c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1]
        return [a, b, d, c[-1, -1] - a - b - d]

    if min(g.shape) < 2:
        return 0.0
    gs, hs = corners(g), corners(h)
    four = sum(a ** 2 / (b + 1) for a, b in zip(gs, hs))
    halves = [((gs[i] + gs[j]) ** 2 / (hs[i] + hs[j] + 1) + (gs[k] + gs[l]) ** 2 / (hs[k] + hs[l] + 1))
              for i, j, k, l in ((0, 1, 2, 3), (0, 2, 1, 3))]
    return float((four - np.maximum(*halves)).max())


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, check: np.ndarray, params: Params) -> Model:
    """``check``: rows that only tell when to stop."""
    share = (weight[y == 1].sum() + 1) / (weight.sum() + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(np.unique(y[~check])) < 2:
        return model
    inner = np.linspace(0, 1, params.bins + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(x[~check, j], inner)) for j in range(x.shape[1])]
    b = binned(x, model.cuts)
    z = np.full(len(x), model.base)
    model.mains = [np.zeros(len(c) + 1) for c in model.cuts]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return np.where(check, 0, weight * (p - y)), np.where(check, 0, weight * p * (1 - p))

    def loss() -> float:
        of = check if check.any() else ~check
        return float((weight * np.logaddexp(0, np.where(y == 1, -z, z)))[of].sum())

    def boost(tables: list[np.ndarray], cells: list[np.ndarray], shapes: list[tuple[int, int]]) -> list[np.ndarray]:
        nonlocal z
        best, kept, kept_z, since = loss(), [t.copy() for t in tables], z.copy(), 0
        for _ in range(params.rounds):
            for t, cell, shape in zip(tables, cells, shapes):
                g, h = slopes()
                cellwise = [np.bincount(cell, weights=v, minlength=shape[0] * shape[1]).reshape(shape) for v in (g, h)]
                step = params.rate * tree(*cellwise, params.least_weight)
                t += step.reshape(t.shape)
                z = z + step.ravel()[cell]
            now = loss()
            if now < best - 1e-6:
                best, kept, kept_z, since = now, [t.copy() for t in tables], z.copy(), 0
            else:
                since += 1
                if since >= params.patience:
                    break
        z = kept_z
        return kept

    model.mains = boost(model.mains, [b[:, j] for j in range(x.shape[1])], [(len(t), 1) for t in model.mains])
    g, h = slopes()
    gains = []
    for j in range(x.shape[1]):
        for k in range(j + 1, x.shape[1]):
            shape = (len(model.mains[j]), len(model.mains[k]))
            cell = b[:, j] * shape[1] + b[:, k]
            tables = [np.bincount(cell, weights=v, minlength=shape[0] * shape[1]).reshape(shape) for v in (g, h)]
            gains.append((crossed_gain(*tables), j, k))
    gains.sort(key=lambda t: (-t[0], t[1:]))
    model.pairs = [(j, k) for gain, j, k in gains[:params.pairs] if gain > 0]
    shapes = [(len(model.mains[j]), len(model.mains[k])) for j, k in model.pairs]
    cells = [b[:, j] * s[1] + b[:, k] for (j, k), s in zip(model.pairs, shapes)]
    model.tables = boost([np.zeros(s) for s in shapes], cells, shapes)
    return model


def fit(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, label (0 or 1)."""
    params = params or Params()
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    sizes = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    some = [drawn(ids.where(F.col("label") == c), params.sample_rows // 2, "doc_id", n=sizes[c]) for c in sorted(sizes)]
    if not some:
        return Model(0.0)
    listed = some[0] if len(some) == 1 else some[0].unionByName(some[1])
    listed = listed.select(F.col("doc_id").alias("listed_id"), "label", "h")
    few = docs.select("doc_id", "text").join(F.broadcast(listed), F.col("doc_id") == F.col("listed_id"))
    rows = measured(few, "doc_id", "text", "label", "h") \
        .select("label", "h", "values").orderBy("h", "values").limit(2 * params.sample_rows).collect()
    if not rows:
        return Model(0.0)
    y = np.array([r["label"] for r in rows], np.int64)
    found = np.bincount(y, minlength=2)
    known = np.array([sizes.get(0, 0), sizes.get(1, 0)], np.float64)
    weight = (known / known.sum() * len(y) / np.maximum(found, 1))[y]
    check = np.array([r["h"] % params.check_share == 0 for r in rows])
    if len(set(y[~check].tolist())) < len(set(y.tolist())):
        check[:] = False
    return train(np.array([r["values"] for r in rows]), y, weight, check, params)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` per row of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of bins, whatever the data
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(texts)), pa.array(score(shared.value, measures(texts)))], ["id", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
        .mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
