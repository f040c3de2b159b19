"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of four hashed rows: the word, its first four
and first six letters and its last four. Filters of several widths run over
the whole text, each keeps its largest response, and a logistic unit reads
those. It learns from every labelled row, whole: the rows are dealt to shards by
a hash, in each epoch a task passes over a shard from the epoch's weights, and
the shards' changes are averaged by a grouped sum into the next epoch's weights
(of a word's row, over the shards that changed it). The changes are summed as
integers, so the weights depend on neither the order nor the partitions. Only
the weights, whose size the parameters fix, reach the driver. A threshold is
calibrated for each language on all labelled rows kept out of the training;
languages with too few of them use the threshold of all rows. The score never
sees language, source, id or label.

Null and empty texts have the score of a text without words. Repeated rows
score alike. Rows with a null id are scored; rows with a null label or text
are not learnt from. Without a row of either class the scores are 0.
Texts are read whole, in blocks, however long. A score that ties with its threshold rejects. Empty tables give no
rows. ``scored`` reads no other columns, whatever their names; ``keep_clean``
hands the columns of documents on.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import drop_checkpoint, materialize
from .common import BROADCAST_IDS, ship

WORD = re.compile(r"\w+")
CACHE_WORDS = 400_000    # words whose vectors a Python worker keeps
BLOCK = 65_536           # words of a text that are convolved at once
SCALE = 1 << 28          # changes of weights are summed as whole multiples of 1 / SCALE
MIXED = 1024             # texts of a shard whose order is mixed anew in each epoch, of
MIXED_BYTES = 32 << 20   # so many bytes together
BINS = 10_000            # thresholds lie between bins of the scores


@dataclass(frozen=True)
class Params:
    """``shard_rows``: labelled rows of a shard, on average."""

    shard_rows: int = 8000
    buckets: int = 1 << 15
    dim: int = 16
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 5
    rate: float = 0.05
    seed: int = 11
    calibration_share: int = 5     # every fifth labelled row calibrates
    calibration_rows: int = 25     # a language needs as many of them


@dataclass
class Model:
    params: Params
    words: np.ndarray                    # buckets x dim
    kernels: list[np.ndarray]            # per width: width x dim x filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)


class WordRows(dict):
    """Word -> its four embedding rows, filled on demand, bounded."""

    def __init__(self, buckets: int):
        super().__init__()
        self.mask = buckets - 1

    def __missing__(self, word: str) -> tuple[int, int, int, int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        rows = self[word] = hashed_rows(word, self.mask)
        return rows


def hashed_rows(word: str, mask: int) -> tuple[int, int, int, int]:
    """Of the word, its beginnings and its end; the second argument tells them apart."""
    h = zlib.crc32
    return (h(word.encode()) & mask, h(word[:4].encode(), 1) & mask,
            h(word[:6].encode(), 2) & mask, h(word[-4:].encode(), 3) & mask)


def word_rows(text: str | None, known: WordRows) -> np.ndarray:
    words = WORD.findall((text or "").lower())
    if not words:
        return np.empty((0, 4), np.int32)
    return np.array([known[w] for w in words], np.int32)


def vectors(model: Model, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the words at these places; zeros beyond the end of the text."""
    inside = at < len(rows)
    out = np.zeros((len(at), model.params.dim), np.float32)
    out[inside] = model.words[rows[at[inside]]].sum(1)
    return out


def responses(model: Model, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter, and where it begins. A text shorter
    than the widest filter is padded with zeros."""
    widest, f = max(model.params.widths), model.params.filters
    n = max(len(rows), widest)
    tops = np.full(f * len(model.kernels), -np.inf, np.float32)
    begins = np.zeros(len(tops), np.int64)
    for low in range(0, n - widest + 1, BLOCK):  # blocks overlap by the widest filter
        part = rows[low:low + BLOCK + widest - 1]
        x = np.zeros((max(len(part), widest), model.params.dim), np.float32)
        for k in range(rows.shape[1]):
            x[:len(part)] += model.words[part[:, k]]
        for k, kernel in enumerate(model.kernels):
            w, own = len(kernel), slice(k * f, (k + 1) * f)
            c = x[:len(x) - w + 1] @ kernel[0]
            for j in range(1, w):
                c += x[j:len(x) - w + 1 + j] @ kernel[j]
            at = c.argmax(0)
            top = c[at, np.arange(f)]
            better = top > tops[own]
            begins[own] = np.where(better, at + low, begins[own])
            tops[own] = np.where(better, top, tops[own])
    return tops, begins


def score(model: Model, rows: np.ndarray) -> float:
    return _unit(model, responses(model, rows)[0])


def _unit(model: Model, top: np.ndarray) -> float:
    z = float(np.tanh(top + model.bias) @ model.out) + model.out_bias
    return 1.0 / (1.0 + float(np.exp(-np.clip(z, -30.0, 30.0))))


class Scorer(dict):
    """Scores whole texts inside a task. Keeps the vectors of words met so
    far (bounded), so that a word is hashed once."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.vectors = np.zeros((CACHE_WORDS, model.params.dim), np.float32)
        self.stacked = np.concatenate([k for kernel in model.kernels for k in kernel], axis=1)

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def _vectors(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > len(self.vectors):
            self.clear()
            if len(words) > len(self.vectors):  # a text that alone could fill the table
                return np.concatenate([self._vectors(words[k:k + CACHE_WORDS // 2])
                                       for k in range(0, len(words), CACHE_WORDS // 2)])
        at = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if self.new:
            mask = self.model.params.buckets - 1
            hashed = np.array([hashed_rows(w, mask) for w in self.new], np.int32)
            self.vectors[len(self) - len(self.new):len(self)] = self.model.words[hashed].sum(1)
            self.new = []
        return self.vectors[at]

    def score(self, text: str | None) -> float:
        words = WORD.findall((text or "").lower())
        widest, f = max(self.model.params.widths), self.model.params.filters
        x = self._vectors(words)
        if len(x) < widest:
            x = np.concatenate([x, np.zeros((widest - len(x), x.shape[1]), np.float32)])
        tops = [np.full(f, -np.inf, np.float32) for _ in self.model.kernels]
        for low in range(0, max(len(x) - widest + 1, 1), BLOCK):  # blocks overlap by the widest filter
            c = x[low:low + BLOCK + widest - 1] @ self.stacked
            col = 0
            for k, kernel in enumerate(self.model.kernels):
                w = len(kernel)
                n = len(c) - w + 1
                own = c[:n, col:col + f]
                for j in range(1, w):
                    own = own + c[j:n + j, col + j * f:col + (j + 1) * f]
                tops[k] = np.maximum(tops[k], own.max(0))
                col += w * f
        return _unit(self.model, np.concatenate(tops))


class Learner:
    """Adaptive steps, one text at a time; only the words under a filter's
    largest response receive a gradient."""

    def __init__(self, params: Params, share: float):
        rng = self.rng = np.random.default_rng(params.seed)
        f = params.filters
        self.params = params
        self.model = Model(
            params, rng.normal(0, 0.05, (params.buckets, params.dim)).astype(np.float32),
            [rng.normal(0, 0.3, (w, params.dim, f)).astype(np.float32) for w in params.widths],
            np.zeros(f * len(params.widths), np.float32),
            rng.normal(0, 0.3, f * len(params.widths)).astype(np.float32), 0.0)
        self.seen_words = np.full(params.buckets, 1e-4, np.float32)
        self.seen_rest = np.full(len(self.rest()), 1e-4, np.float32)
        share = max(share, 1e-3)
        self.weight = (0.5 / max(1 - share, 1e-3), 0.5 / share)
        self.touched = np.zeros(params.buckets, np.int64)

    def rest(self) -> np.ndarray:
        """All weights but the words', in one row."""
        m = self.model
        return np.concatenate([*(k.ravel() for k in m.kernels), m.bias, m.out, [m.out_bias]]).astype(np.float32)

    def set_rest(self, values: np.ndarray) -> None:
        m, done = self.model, 0
        for name in ("kernels", "bias", "out"):
            parts = m.kernels if name == "kernels" else [getattr(m, name)]
            for part in parts:
                part[...] = values[done:done + part.size].reshape(part.shape)
                done += part.size
        m.out_bias = float(values[done])

    def learn(self, rows: np.ndarray, label: int, rate: float) -> None:
        model, f = self.model, self.params.filters
        top, begins = responses(model, rows)
        a = np.tanh(top + model.bias)
        z = float(a @ model.out) + model.out_bias
        p = 1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0)))
        g = (p - label) * self.weight[label]
        if abs(g) < 1e-3:
            return
        dz = (g * model.out * (1 - a * a)).astype(np.float32)
        into, grads, into_rest = [], [], []
        for k, kernel in enumerate(model.kernels):
            own = slice(k * f, (k + 1) * f)
            for j in range(len(kernel)):
                at = begins[own] + j
                inside = at < len(rows)
                into.append(rows[at[inside]])
                grads.append((kernel[j].T * dz[own, None])[inside])                          # filters x dim
                into_rest.append((vectors(model, rows, at) * dz[own, None]).T.ravel())       # dim x filters
        grad = np.concatenate([*into_rest, dz, g * a, [g]]).astype(np.float32)
        self.seen_rest += grad * grad
        self.set_rest(self.rest() - rate * grad / np.sqrt(self.seen_rest))
        into, grads = np.concatenate(into), np.concatenate(grads)
        if len(into):
            rows_hit, back = np.unique(into.ravel(), return_inverse=True)
            total = np.zeros((len(rows_hit), self.params.dim), np.float32)
            np.add.at(total, back, np.repeat(grads, into.shape[1], axis=0))
            self.seen_words[rows_hit] += (total * total).mean(1)
            model.words[rows_hit] -= rate * total / np.sqrt(self.seen_words[rows_hit])[:, None]
            self.touched[rows_hit] += 1

    def state(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights as rows: of each word its vector and its steps' sum of
        squares, and all others with theirs, cut into rows as wide."""
        wide = self.params.dim + 1
        rest = np.concatenate([self.rest(), self.seen_rest])
        return np.column_stack([self.model.words, self.seen_words]), np.resize(np.append(rest, np.zeros(-len(rest) % wide)), (-(-len(rest) // wide), wide))

    def restore(self, words: np.ndarray, rest: np.ndarray) -> None:
        self.model.words, self.seen_words = words[:, :-1].astype(np.float32), words[:, -1].astype(np.float32)
        n = len(self.seen_rest)
        self.set_rest(rest.ravel()[:n])
        self.seen_rest = rest.ravel()[n:2 * n].astype(np.float32)
        self.touched[:] = 0

    def changes(self, words: np.ndarray, rest: np.ndarray, many: int) -> list[np.ndarray]:
        """Since that state: numbers of the rows, how much each counts (the
        steps that changed a word, the texts for all others), and the changes
        times that, as integers."""
        now_words, now_rest = self.state()
        hit = np.flatnonzero(self.touched)
        count = np.concatenate([self.touched[hit], np.full(len(rest), many)])
        change = np.concatenate([now_words[hit].astype(np.float64) - words[hit], now_rest.astype(np.float64) - rest])
        return [np.concatenate([hit, len(words) + np.arange(len(rest))]), count, np.rint(change * SCALE * count[:, None]).astype(np.int64)]


def train(params: Params, texts: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of a list of texts, in one process."""
    learner = Learner(params, float(labels.mean()) if len(labels) else 0.5)
    for epoch in range(params.epochs):
        for i in learner.rng.permutation(len(texts)):
            learner.learn(texts[i], int(labels[i]), params.rate / (1 + epoch))
    return learner.model


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """Middle of the gap at which cutting gives the best F1; 0.5 when only one
    class is there."""
    if not len(labels) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    found = np.cumsum(y)
    f1 = 2 * found / (np.arange(1, len(y) + 1) + y.sum())
    last_of_tie = np.append(s[1:] != s[:-1], True)
    k = int(np.argmax(np.where(last_of_tie, f1, -1)))
    below = s[k + 1] if k + 1 < len(s) else 0.0
    return float(np.clip((s[k] + below) / 2, 0.05, 0.95))


def best_cut(bins: np.ndarray, many: np.ndarray, bad: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """``best_threshold`` between bins: their numbers, rows, rows of class 1,
    least and largest score."""
    if bad.sum() in (0, many.sum()):
        return 0.5
    order = np.argsort(-bins, kind="stable")
    f1 = 2 * np.cumsum(bad[order]) / (np.cumsum(many[order]) + bad.sum())
    k = int(np.argmax(f1))
    below = high[order[k + 1]] if k + 1 < len(order) else 0.0
    return float(np.clip((low[order[k]] + below) / 2, 0.05, 0.95))


def lessons(docs: DataFrame, labels: DataFrame, params: Params) -> DataFrame:
    """``shard, h, held, label, lang, words``, materialised: every row with
    a text, an id and a label of 0 or 1, its words as embedding rows."""
    spark = docs.sparkSession
    ship(spark)
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    listed = ids.count()
    if listed <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    place, h = F.xxhash64("doc_id", "text"), F.xxhash64("doc_id")
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull()).join(ids, "doc_id").select(
        F.pmod(place, F.lit(max(1, math.ceil(listed / params.shard_rows)))).cast("int").alias("shard"), h.alias("h"),
        (F.pmod(h, F.lit(params.calibration_share)) == 0).alias("held"), "label", "lang", "text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordRows(params.buckets)
        for batch in batches:
            words = [word_rows(t, known).astype(np.uint16 if params.buckets <= 1 << 16 else np.int32).tobytes()
                     for t in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(words, pa.binary())], [*batch.schema.names[:5], "words"])

    found = rows.mapInArrow(packed, "shard int, h bigint, held boolean, label int, lang string, words binary")
    return materialize(found.repartition(max(1, math.ceil(listed / params.shard_rows)), "shard")
                       .sortWithinPartitions("shard", "h", "label", "words"))


def unpacked(words: bytes, params: Params) -> np.ndarray:
    return np.frombuffer(words, np.uint16 if params.buckets <= 1 << 16 else np.int32).reshape(-1, 4)


def mixed(rows: Iterator[tuple], rng: np.random.Generator, epoch: int) -> Iterator[tuple]:
    """All rows ``(.., .., bytes)``, in a random order within stretches of
    bounded size; the order of one stretch goes on from epoch to epoch as in ``train``."""
    held, size = [], 0

    def order() -> list[int]:
        return [rng.permutation(len(held)) for _ in range(epoch + 1)][-1].tolist()

    for row in rows:
        held.append(row)
        size += len(row[2])
        if len(held) >= MIXED or size >= MIXED_BYTES:
            yield from (held[i] for i in order())
            held, size = [], 0
    yield from (held[i] for i in order())


def epoch_changes(table: DataFrame, learner: Learner, epoch: int) -> DataFrame:
    """``k, n, v0, v1, ...``: the summed changes of each row of weights after a
    pass over every shard of ``table``, each from ``learner``'s weights."""
    spark, wide, rate = table.sparkSession, learner.params.dim + 1, learner.params.rate / (1 + epoch)
    start = spark.sparkContext.broadcast((learner.params, learner.weight, *learner.state()))
    names = ["k", "n", *(f"v{i}" for i in range(wide))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, weight, words, rest = start.value
        every = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in range(3))))
        for _, shard in itertools.groupby(every, key=lambda row: row[0]):
            own, many = Learner(params, 0.5), 0
            own.weight = weight
            own.restore(words, rest)
            for _, label, text in mixed(shard, own.rng, epoch):
                own.learn(unpacked(text, params), label, rate)
                many += 1
            k, n, v = own.changes(words, rest, many)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), *(pa.array(v[:, i]) for i in range(wide))], names)

    return table.select("shard", "label", "words").mapInArrow(run, ", ".join(f"{c} bigint" for c in names)) \
        .groupBy("k").agg(*(F.sum(c).alias(c) for c in names[1:]))


def learnt(table: DataFrame, params: Params, share: float) -> Model:
    """The model of the rows ``shard, label, words``: each epoch starts from
    the shards' averaged changes."""
    learner = Learner(params, share)
    for epoch in range(params.epochs):
        words, rest = learner.state()
        every = np.concatenate([words, rest]).astype(np.float64)
        got = epoch_changes(table, learner, epoch).toArrow()
        k, n, *v = (c.to_numpy() for c in got.columns)
        if len(k):
            every[k] += np.column_stack(v) / (n[:, None] * float(SCALE))
        learner.restore(every[:len(words)], every[len(words):])
    return learner.model


def calibrate(model: Model, table: DataFrame) -> None:
    """Sets the thresholds by the rows ``label, lang, words``: scored where
    they lie, counted by language and bin."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [score(shared.value, unpacked(w, shared.value.params)) for w in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], ["label", "lang", "score"])

    totals = (F.sum("many").alias("many"), F.sum("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high"))
    binned = table.select("label", "lang", "words").mapInArrow(run, "label int, lang string, score double") \
        .groupBy("lang", F.floor(F.col("score") * BINS).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("many"), F.sum("label").alias("bad"), F.min("score").alias("low"), F.max("score").alias("high"))
    binned = materialize(binned)
    parts = ("bin", "many", "bad", "low", "high")
    model.threshold = best_cut(*(c.to_numpy() for c in binned.groupBy("bin").agg(*totals).select(*parts).toArrow().columns))
    own = binned.groupBy("lang").agg(F.sum("many").alias("all"), F.sum("bad").alias("all_bad")) \
        .where(F.col("lang").isNotNull() & (F.col("lang") != "") & (F.col("all") >= model.params.calibration_rows)
               & (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all"))).select("lang")

    def cut(rows):
        return rows[["lang"]].head(1).assign(cut=best_cut(*(rows[c].to_numpy() for c in parts)))

    found = binned.join(own, "lang", "left_semi").groupBy("lang").applyInPandas(cut, "lang string, cut double")  # a group has BINS + 1 rows at most
    model.by_language = {r["lang"]: r["cut"] for r in found.orderBy("lang").collect()}
    drop_checkpoint(binned)


def fit(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> Model | None:
    """``docs``: doc_id, text, lang; ``labels``: doc_id, label (0 or 1). None
    when a class has no row."""
    params = params or Params()
    table = lessons(docs, labels, params)
    many = {(r["held"], r["label"]): r["count"] for r in table.groupBy("held", "label").count().collect()}
    model = None
    if {c for _, c in many} == {0, 1}:
        kept = {c: many.get((False, c), 0) for c in (0, 1)}
        apart = all(kept.values())  # otherwise every row is learnt from, and none calibrates
        if not apart:
            kept = {c: kept[c] + many.get((True, c), 0) for c in (0, 1)}
        model = learnt(table.where(~F.col("held")) if apart else table, params, kept[1] / sum(kept.values()))
        if apart:
            calibrate(model, table.where("held"))
    drop_checkpoint(table)
    return model


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` per row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # a few MB, whatever the data
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Scorer(shared.value).score if shared.value else lambda text: 0.0
        for batch in batches:
            s = [of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["row_id", "score"])

    return docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"row_id {kind}, score double").withColumnRenamed("row_id", id_col)


def threshold_of(model: Model | None, lang: Column) -> Column:
    """The language's threshold; of all rows for an unknown or null language."""
    if model is None:
        return F.lit(1.1)
    out = F.lit(model.threshold)
    for name, value in model.by_language.items():
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def keep_clean(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (columns of documents) without the rows whose score reaches
    their language's threshold. Scored row by row, without a join."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Scorer(shared.value).score if shared.value else lambda text: 0.0
        at = columns.index("text")
        for batch in batches:
            limits = batch.column(len(columns)).to_pylist()
            keep = [of(t) < x for t, x in zip(batch.column(at).to_pylist(), limits)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(range(len(columns)))

    limited = docs.withColumn("__reject_at", threshold_of(model, F.col("lang")))
    return limited.mapInArrow(run, docs.schema)
