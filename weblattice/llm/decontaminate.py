"""Benchmark decontamination by the CGK embedding and bit-sampling LSH.

Texts and benchmark items are sequences of words (``\\w+``, small letters; of
scripts that are written without blanks, each letter is a word). An item is
found in a text when some passage is within ``1 - similarity`` of the item's
length in word edits. At 0.8 that leaves items of fewer than five words no
edit: items below ``min_words`` are found where all their words stand in order.

1. Items are cut into pieces of at least ``piece`` words, and less than twice
   as many: one piece holds no greater share of edits than the whole. Piece
   sizes fall into classes. A window of a class has its number of words. Each edit breaks at most two word pairs, so a passage must hold a known
   number of its item's pairs, the first of them at most two words on for each
   edit. A bitmap of all pairs and a table of the lots of items that hold them
   (both bounded, whatever the benchmark's size) drop the starts that do not;
   every other start is tried. Nothing that could match is lost here.
2. The CGK walk embeds what is left, and each piece's head of the class size:
   at step j it writes the current word and moves on if a random bit of
   (j, word) is set, so that edit distance becomes Hamming distance. Several
   walks, and several samples of positions of each, give the signatures: as
   many walks of a class as find the target share of trial passages that have
   all the edits which a piece may have.
3. Windows meet items with an equal signature in a join; the passage around a
   window is verified by the exact edit distance (bit-parallel).
4. An item below ``min_words`` has one signature, the hash of its words. Every
   window of as many words is looked up in a bitmap of these, and the first of
   equal windows of a text goes through the same join and verification.

Null and empty texts match nothing; nor do items that are null or have no
word. Repeated rows of documents or items each match;
rows that share an id give one result for it. Null ids are kept as ids. Texts are
searched whole, however long. Of several passages as near to an item, the one
found at the smallest place counts. An empty table of documents or items gives
no matches. ``matches`` reads no other columns, whatever their names;
``keep_clean`` hands the columns of documents on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_id, ship, written
from .ngram_join import WordHash, mixed

WORD = re.compile(r"\w+")
#: Thai, Lao, Myanmar, Khmer, kana and ideographs: letters that no blank parts into words.
_BLANKLESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
BLANKLESS = re.compile(f"[{_BLANKLESS}]")
LETTER_OR_WORD = re.compile(rf"(?=\w)[{_BLANKLESS}]|[^\W{_BLANKLESS}]+")
DEALT = 16               # shares of a signature's or an item's rows in a join by shuffle
_M1 = np.uint64(0x9E3779B97F4A7C15)
MAX_BITS = 24            # a bitmap has 2**24 bits (2 MB) at most; a fuller one only lets more through
LOT_BITS = 18            # the table of lots has 2**18 rows of 64 bits (2 MB)
BATCH_WORDS = 1 << 19    # of texts that are searched at once
BROADCAST_BYTES = 1 << 23  # of items' words that may be broadcast; beyond, they are joined by shuffle


@dataclass(frozen=True)
class Params:
    similarity: float = 0.8
    min_words: int = 5
    growth: float = 1.25     # of the window classes
    piece: int = 20          # words
    target: float = 0.99     # recall of a piece with all its edits
    walks: int = 8           # at least
    samples: int = 6         # of each walk
    sampled: int = 4         # positions in a sample
    seed: int = 17

    def edits(self, words: int) -> int:
        return int((1 - self.similarity) * words + 1e-9)

    def class_of(self, words: int) -> int:
        return self.grid(words)[0]

    def grid(self, words: int) -> tuple[int, int]:
        """The class of an item, and the next larger one."""
        low = self.min_words
        while (up := max(low + 1, int(low * self.growth))) <= words:
            low = up
        return low, up

    @property
    def least_piece(self) -> int:
        return max(self.piece, self.min_words)

    def cuts(self, words: int) -> list[int]:
        """Where the pieces of an item start, and its end."""
        n = max(1, words // self.least_piece)
        return [k * words // n for k in range(n + 1)]

    def least_pairs(self, size: int, up: int) -> int:
        """Word pairs of an item of the class that a match must keep."""
        return max(1, min(n - 1 - 2 * self.edits(n) for n in range(size, up)))


def unit(low: str) -> re.Pattern:
    """What a word is in a text of small letters."""
    return WORD if low.isascii() or not BLANKLESS.search(low) else LETTER_OR_WORD


def word_hashes(text: str | None, known: WordHash) -> np.ndarray:
    low = (text or "").lower()
    words = unit(low).findall(low)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """One hash of the words of each window."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mixed(out * _M1 + h[k:k + n])
    return out


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mixed(h[:-1] * _M1 + h[1:])


@lru_cache(maxsize=256)
def walk_plan(params: Params, size: int, walks: int) -> list[tuple[np.uint64, frozenset[int], np.ndarray]]:
    """Per walk of a class: its salt, the steps that are sampled, the samples."""
    rng = np.random.default_rng([params.seed, size])
    places = rng.integers(0, 2 * size, (walks, params.samples, params.sampled))
    salts = mixed((np.arange(walks, dtype=np.uint64) + np.uint64(params.seed * 1000)) * _M1)
    return [(salts[k], frozenset(places[k].ravel().tolist()), places[k]) for k in range(walks)]


def signatures(windows: np.ndarray, params: Params, walks: int | None = None) -> np.ndarray:
    """Signatures of windows of one class: rows x (walks * samples)."""
    rows, size = windows.shape
    walks = walks or params.walks
    flat = np.concatenate([windows, np.zeros((rows, 1), np.uint64)], axis=1).ravel()
    out = np.empty((rows, walks * params.samples), np.uint64)
    one, first = np.uint64(1), np.arange(rows) * (size + 1)
    end = first + size
    for walk, (salt, steps, places) in enumerate(walk_plan(params, size, walks)):
        bits = mixed(flat ^ salt)                  # 64 random bits of each word
        here, wanted = first.copy(), {}
        for j in range(max(steps) + 1):
            if j in steps:
                wanted[j] = flat[here]
            # Step j reads bit j % 64 of the word, scrambled anew every 64 steps.
            if j and j % 64 == 0:
                bits = mixed(bits + np.uint64(j))
            here += ((bits[here] >> np.uint64(j % 64)) & one).astype(np.int64)
            np.minimum(here, end, out=here)
        for k, sample in enumerate(places.tolist()):
            total = np.full(rows, salt + np.uint64((k + 1) * size), np.uint64)
            for j in sample:
                total = mixed(total * _M1 + wanted[j])
            out[:, walk * params.samples + k] = total
    return out


@lru_cache(maxsize=256)
def walks_for(params: Params, size: int, trials: int = 300) -> int:
    """Walks of a class that find the target share of random passages with
    all the edits that its largest piece may have: of substitutions alone, and
    of all kinds. A window may start two words beside the passage."""
    n, around, side = params.grid(size)[1] - 1, 2 * size + 4, 2
    rng = np.random.default_rng([params.seed, size, 1])
    own = rng.integers(1, 1 << 63, (2 * trials, n), dtype=np.uint64)
    texts = rng.integers(1, 1 << 63, (2 * trials, around), dtype=np.uint64)
    for t, words in enumerate(own):
        at, out = set(rng.permutation(n)[:params.edits(n)].tolist()), []
        for k, word in enumerate(words):
            kind = 0 if k not in at else 1 if t < trials else rng.integers(1, 4)
            out += [[word], [~word], [~word, word], []][kind]
        texts[t, side:side + len(out)] = out[:around - side]
    walks = params.walks
    while walks <= 1000:
        heads = signatures(own[:, :size], params, walks)
        found = np.zeros(2 * trials, bool)
        for at in range(2 * side + 1):
            found |= (signatures(texts[:, at:at + size], params, walks) == heads).any(1)
        if min(found[:trials].mean(), found[trials:].mean()) >= params.target:
            return walks
        walks += max(1, walks // 2)
    raise ValueError(f"windows of {size} words do not reach a recall of {params.target} at similarity {params.similarity}")


def edit_scan(masks: dict[int, int], size: int, text: list[int], anchored: bool) -> list[int]:
    """Edit distances of the pattern to the texts that end at each place: from
    any start, or (``anchored``) from the first place."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, out = full, 0, size, []
    for c in text:
        equal = masks.get(c, 0)
        x = equal | down
        h = (((equal & up) + up) ^ up) | equal
        plus, minus = down | (full & ~(h | up)), up & h
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) | anchored, minus << 1
        up, down = full & (minus | ~(x | plus)), plus & x & full
        out.append(score)
    return out


def best_passage(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """Least edit distance of the item to a passage of the text, the
    passage's first word and the word after its last."""
    masks: dict[int, int] = {}
    for k, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << k
    found = edit_scan(masks, len(item), text, False)
    least = min(found, default=len(item))
    if not found or least >= len(item):
        return len(item), 0, 0
    end = found.index(least) + 1
    back = {c: int(format(m, f"0{len(item)}b")[::-1], 2) for c, m in masks.items()}
    return least, end - 1 - edit_scan(back, len(item), text[:end][::-1], True).index(least), end


def items_table(benchmark: DataFrame, params: Params, item_id: str, text_col: str) -> DataFrame:
    """A row for each piece of the items: ``item_id, size, before, after``
    (words of the passage before and from the piece's start), ``words`` (of
    the whole item, at its first piece), ``lot, pairs, sigs``. The size of an
    item below ``min_words`` is its number of words."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    walks = {size: walks_for(params, size) for size in {params.class_of(n) for n in range(params.min_words, 2 * params.least_piece)}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0), batch.column(1).to_pylist()):
                h = word_hashes(t, known)
                if 0 < len(h) < params.min_words:
                    rows.append((i.as_py(), len(h), 0, len(h), h.tobytes(), 0, [], window_hashes(h, len(h)).view(np.int64)))
                    continue
                cuts, spare = params.cuts(len(h)), 2 * params.edits(len(h))
                for at, end in zip(cuts, cuts[1:]) if len(h) else ():
                    piece, size = h[at:end], params.class_of(end - at)
                    rows.append((i.as_py(), size, at + spare, len(h) - at + spare, None if at else h.tobytes(), zlib.crc32(piece.tobytes()) % 64,
                                 np.unique(pair_hashes(piece)).view(np.int64),
                                 np.unique(signatures(piece[None, :size], params, walks[size])[0]).view(np.int64)))
            kinds = (batch.schema.types[0], *(pa.int32(),) * 3, pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                             ["item_id", "size", "before", "after", "words", "lot", "pairs", "sigs"])

    return benchmark.select(F.col(item_id).alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"item_id {kind}, size int, before int, after int, words binary, lot int, pairs array<bigint>, sigs array<bigint>")


def bitmap(values: DataFrame, column: str, count: int, room: int) -> np.ndarray:
    """Hashed bitmap of a column of 64-bit values, combined on the executors:
    ``room`` bits for each value, 2**MAX_BITS bits at most."""
    bits = min(MAX_BITS, max(16, (room * max(count, 1)).bit_length()))
    at = F.pmod(F.col(column), F.lit(1 << bits))
    rows = values.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set")).collect()
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows:
        out[r["word"]] = r["set"]
    return out.view(np.uint64)


def lots_table(items: DataFrame) -> np.ndarray:
    """Of each hashed word pair the lots of items that hold it, as 64 bits."""
    rows = items.select(F.explode("pairs").alias("v"), "lot") \
        .groupBy(F.shiftrightunsigned("v", 64 - LOT_BITS).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, lot)")).alias("set")).collect()
    out = np.zeros(1 << LOT_BITS, np.int64)
    for r in rows:
        out[r["at"]] = r["set"]
    return out.view(np.uint64)


def holds(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def search_plan(items: DataFrame, params: Params) -> dict:
    """What the tasks need of the benchmark; bounded whatever its size."""
    every = items.groupBy("size").agg(F.count("*").alias("n"), F.sum(F.size("pairs")).alias("pairs"),
                                      F.sum(F.size("sigs")).alias("sigs"), F.max("before").alias("before"),
                                      F.max("after").alias("after"), F.sum(F.octet_length("words")).alias("bytes")).orderBy("size").collect()
    short, sizes = ([r for r in every if (r["size"] < params.min_words) == below] for below in (True, False))
    pieces = items.where(F.col("size") >= params.min_words)
    return {
        "short": [r["size"] for r in short],
        "whole": bitmap(items.where(F.col("size") < params.min_words).select(F.explode("sigs").alias("v")), "v", sum(r["sigs"] for r in short), 4096),
        "sizes": [(size, params.edits(up - 1), up, params.least_pairs(size, up)) for size, up in (params.grid(r["size"]) for r in sizes)],
        "reach": {r["size"]: (r["before"], r["after"], walks_for(params, r["size"])) for r in sizes},
        "n_sigs": sum(r["sigs"] for r in every),
        "n_bytes": sum(r["bytes"] or 0 for r in every),
        "lots": lots_table(pieces),
        "pairs": bitmap(pieces.select(F.explode("pairs").alias("v")), "v", sum(r["pairs"] for r in sizes), 64),
        "sigs": bitmap(pieces.select(F.explode("sigs").alias("v")), "v", sum(r["sigs"] for r in sizes), 4096),
    }


def candidate_starts(flagged: np.ndarray, lots: np.ndarray, edits: int, up: int, least: int) -> np.ndarray:
    """All places that a passage can start at: enough of the places of
    benchmark word pairs, of one lot, follow within its greatest length, the
    first at most ``2 * edits`` on, as each edit keeps it two words away at most."""
    reach, out = up - 1 + edits - 1, [np.empty(0, np.int64)]
    for low in range(0, len(flagged), 1 << 16):
        own = flagged[low:low + (1 << 16)]
        stop = np.searchsorted(flagged, own + reach) - low
        near = np.flatnonzero(stop - np.arange(len(own)) >= least)
        if not len(near):
            continue
        each = np.unpackbits(lots[low:low + stop[-1], None].view(np.uint8), axis=1)
        counts = np.zeros((len(each) + 1, 64), np.int32)
        np.cumsum(each, axis=0, out=counts[1:])
        near = near[(counts[stop[near]] - counts[near]).max(1) >= least]
        # Starts before a place, after the place before: the same first pair.
        before = np.full(len(near), -1, np.int64)
        before[low + near > 0] = flagged[(low + near - 1)[low + near > 0]]
        for back in range(2 * edits + 1):
            at = own[near] - back
            stop = np.searchsorted(flagged, at + reach) - low
            ok = (at > before) & (stop - near >= least)
            near, before, at, stop = near[ok], before[ok], at[ok], stop[ok]
            if not len(near):
                break
            ok = (counts[stop] - counts[near]).max(1) >= least
            near, before = near[ok], before[ok]
            out.append(at[ok])
    return np.sort(np.concatenate(out))


def windows_of(texts: list[np.ndarray], plan: dict, params: Params) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """``(text, size, first, last, signatures)`` of the windows that have a
    signature of some item; first to last is the passage around them."""
    for k, h in enumerate(texts):
        for size in plan["short"]:
            sigs = window_hashes(h, size)
            at = np.flatnonzero(holds(plan["whole"], sigs))
            for sig, first in zip(*np.unique(sigs[at], return_index=True)):
                yield k, size, int(at[first]), int(at[first]) + size, np.array([sig])
    if not plan["sizes"]:
        return
    low = 0
    while low < len(texts):
        high, words = low + 1, len(texts[low])
        while high < len(texts) and words + len(texts[high]) <= BATCH_WORDS:
            words += len(texts[high])
            high += 1
        for k, *row in _windows(texts[low:high], plan, params):
            yield (low + k, *row)
        low = high


def _windows(texts: list[np.ndarray], plan: dict, params: Params) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    # Texts end to end, with so many words between them that no passage reaches the next.
    pad = np.zeros(max((up + 2 * edits for _, edits, up, _ in plan["sizes"]), default=1), np.uint64)
    base = np.concatenate([[0], np.cumsum([len(h) + len(pad) for h in texts])])
    flat = np.concatenate([x for h in texts for x in (h, pad)])
    inner = np.ones(len(flat), bool)
    for k, h in enumerate(texts):
        inner[max(base[k] + len(h) - 1, base[k]):base[k + 1]] = False
    pairs = pair_hashes(flat)
    flagged = np.flatnonzero(holds(plan["pairs"], pairs) & inner[:-1])
    lots = plan["lots"][(pairs[flagged] >> np.uint64(64 - LOT_BITS)).astype(np.int64)]
    flagged, lots = flagged[lots > 0], lots[lots > 0]
    starts = {}
    for size, edits, up, least in plan["sizes"]:
        at = candidate_starts(flagged, lots, edits, up, least)
        of = np.searchsorted(base, at, "right") - 1
        at -= base[of]
        ok = at < np.array([len(h) for h in texts], np.int64)[of]  # else it lies between texts
        starts[size] = np.stack([of[ok], at[ok]], axis=1)
    for size, (before, after, walks) in plan["reach"].items():
        every = starts[size]
        found: list[tuple[int, int, np.ndarray]] = []
        for low in range(0, len(every), 8192):
            own = every[low:low + 8192]
            s = signatures(flat[(base[own[:, 0]] + own[:, 1])[:, None] + np.arange(size)], params, walks)
            hit = holds(plan["sigs"], s)
            found += [(*own[row].tolist(), s[row][hit[row]]) for row in np.flatnonzero(hit.any(1))]
        yield from _joined(found, size, before, after, texts)


def _joined(found: list, size: int, before: int, after: int, texts: list[np.ndarray]) -> Iterator[tuple]:
    """Windows of a class whose passages overlap become one row."""
    open_ = None
    for k, start, sigs in found:
        first, last = max(0, start - before), min(len(texts[k]), start + after)
        if open_ and open_[0] == k and first <= open_[3]:
            open_[3] = max(open_[3], last)
            open_[4].append(sigs)
            continue
        if open_:
            yield (*open_[:4], np.unique(np.concatenate(open_[4])))
        open_ = [k, size, first, last, [sigs]]
    if open_:
        yield (*open_[:4], np.unique(np.concatenate(open_[4])))


def matches(docs: DataFrame, benchmark: DataFrame, params: Params | None = None, id_col: str = "doc_id",
            text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id_col, item_id, distance, item_words, begin, end``: the items found
    in each document, with the characters of the closest passage."""
    params = params or Params()
    spark = docs.sparkSession
    ship(spark)
    items = written(items_table(benchmark, params, item_id, item_text), "benchmark-items")
    searched = search_plan(items, params)
    plan = spark.sparkContext.broadcast(searched)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, rows, spans = batch.slice(at, 1000), [], {}
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                words = [word_hashes(t, known) for t in texts]
                for k, size, first, last, sigs in windows_of(words, plan.value, params):
                    if k not in spans:
                        spans[k] = word_spans(texts[k])
                    rows.append((ids[k], size, first, words[k][first:last].tobytes(), spans[k][first:last].tobytes(), sigs.view(np.int64)))
                kinds = (part.schema.types[0], pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], x) for k, x in enumerate(kinds)],
                                                 ["id", "size", "first", "passage", "spans", "sigs"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, size int, first int, passage binary, spans binary, sigs array<bigint>")
    sig = items.select(F.col("size").alias("item_size"), F.explode("sigs").alias("item_sig"), "item_id").distinct()
    words = items.where("words IS NOT NULL").select(F.col("item_id").alias("of_item"), F.col("words").alias("item")).distinct()
    pairs = met(found.select("id", "size", "first", "passage", "spans", F.explode("sigs").alias("sig")), sig,
                (F.col("size") == F.col("item_size")) & (F.col("sig") == F.col("item_sig")), searched["n_sigs"] <= BROADCAST_IDS) \
        .groupBy("id", "first", "passage", "spans", "item_id").agg(F.lit(1).alias("one"))
    pairs = met(pairs, words, F.col("item_id").eqNullSafe(F.col("of_item")), searched["n_bytes"] <= BROADCAST_BYTES) \
        .select("id", "item_id", "item", "passage", "spans")
    item_kind = items.schema["item_id"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            for item, passage, spans in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                item = np.frombuffer(item, np.uint64).tolist()
                distance, a, b = best_passage(item, np.frombuffer(passage, np.uint64).tolist())
                keep.append(good := distance <= params.edits(len(item)))
                if good:
                    where = np.frombuffer(spans, np.int32).reshape(-1, 2)
                    rows.append((distance, len(item), int(where[a, 0]), int(where[b - 1, 1])))
            ids = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [ids.column(0), ids.column(1), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))],
                ["id", "item_id", "distance", "item_words", "begin", "end"])

    verified = pairs.mapInArrow(verify, f"id {kind}, item_id {item_kind}, distance bigint, item_words bigint, begin bigint, end bigint")
    best = verified.groupBy("id", "item_id").agg(F.min(F.struct("distance", "begin", "end", "item_words")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item_id").alias(item_id), "b.distance", "b.item_words", "b.begin", "b.end")


def met(rows: DataFrame, listed: DataFrame, on: Column, few: bool) -> DataFrame:
    """``rows`` joined with what is listed of the benchmark: by broadcast if
    that is small, else by shuffle, the rows of each key in DEALT shares, as a
    common short item can have a third of them."""
    if few:
        return rows.join(F.broadcast(listed), on)
    rows = rows.withColumn("share", F.pmod(F.xxhash64("id", "first"), F.lit(DEALT)))
    listed = listed.withColumn("of_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(DEALT - 1).cast("bigint"))))
    return rows.join(listed, on & (F.col("share") == F.col("of_share"))).drop("share", "of_share")


def word_spans(text: str) -> np.ndarray:
    """First and last + 1 character of each word that is hashed. Small letters
    can be longer than their capitals; the places are those of the text itself."""
    low = text.lower()
    found = np.array([m.span() for m in unit(low).finditer(low)], np.int32)
    if len(low) == len(text):
        return found
    back = np.array([k for k, c in enumerate(text) for _ in c.lower()], np.int32)
    return np.stack([back[found[:, 0]], back[found[:, 1] - 1] + 1], axis=1)


def keep_clean(docs: DataFrame, benchmark: DataFrame, params: Params | None = None) -> DataFrame:
    """``docs`` without the rows whose id has a match."""
    found = written(matches(docs, benchmark, params).select("doc_id").distinct(), "contaminated")
    return by_id(docs, found, "left_anti")
