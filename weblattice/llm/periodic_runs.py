"""Detection of periodic runs of words, by maximal pairs.

A *run* is a stretch of words with smallest period q (words q apart are the
same) and a length of at least ``exponent`` times q and at least ``shortest``,
which no neighbouring word extends keeping q. A run from word s to e is the
maximal pair (s, s + q): its words s to e - q equal those from s + q to e, and
neither side can grow. So no extension step is needed, only the pairs:

1. *Repeats.* A run of these lengths holds only words that occur ``exponent``
   times in the text, word pairs and groups of four that occur twice. Stretches
   of such groups are cut out; a run lies inside one of them and is maximal
   there. The rest of the text cannot be part of a run.
2. *Suffix order* of the stretches of many texts at once, by prefix doubling;
   only prefixes that are still shared are sorted again. Lengths of common
   prefixes (LCP) are compared word by word only where the words to the left
   differ; elsewhere each is one less than its neighbour's.
3. *LCP intervals* bottom up. An interval of depth l holds the places that
   share l words. Its class lists are one list by place, each entry with the
   class of its left word, as only neighbours in the list can be the smallest
   period of a run. When two children meet, the places of the smaller list look
   up their neighbours in the larger: different children (so the pair cannot
   grow to the right), different left-word classes (nor to the left), and a
   distance d with l >= (exponent - 1) * d and l + d >= ``shortest``. These
   pairs are exactly the runs; a multiple of a run's period that shows up
   before the list is whole has the run's own span and gives way to it.

Words are runs other than blanks and control spaces, as in
``[^\\x20\\x09-\\x0D]+``, with letters as they are. Null, empty and blank texts
have no word and no run. Texts are processed whole; memory grows with the
longest text, as no state outlives a few texts. Rows that repeat an id each
have their result; a null id stays null. An empty table gives no rows. Other
columns of the table are never read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

CHUNK_WORDS = 200_000  # texts are analysed together up to so many words
RUN = "struct<start: bigint, length: bigint, period: bigint>"


@dataclass(frozen=True)
class Params:
    exponent: int = 4   # length over period, at least
    shortest: int = 6   # words of a run, at least

    def __post_init__(self) -> None:
        if self.exponent < 4 or self.shortest < 5:
            raise ValueError("runs need an exponent of 4 and a length of 5 at least")

    @property
    def least_depth(self) -> int:
        """Words that the pair of any run shares."""
        return min(max(self.shortest - d, (self.exponent - 1) * d) for d in range(1, self.shortest + 1))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def stretches(ids: np.ndarray, params: Params) -> list[tuple[int, int]]:
    """Stretches (begin, end) that hold all runs. ``ids``: words of texts in a
    row, where no two texts share an id."""
    if len(ids) < params.shortest:
        return []
    often = np.bincount(ids)[ids] >= params.exponent
    pair_at = np.flatnonzero(often[:-1] & often[1:])
    wide = int(ids.max()) + 1
    pairs = ids[pair_at].astype(np.int64) * wide + ids[pair_at + 1]
    twice = repeated(pairs)
    pair_at, pairs = pair_at[twice], pairs[twice]
    if not len(pair_at):
        return []
    names, named = np.unique(pairs, return_inverse=True)
    pair = np.full(len(ids), -1, np.int64)
    pair[pair_at] = named
    four_at = pair_at[pair_at + 2 < len(ids)]
    four_at = four_at[pair[four_at + 2] >= 0]
    four_at = four_at[repeated(pair[four_at] * len(names) + pair[four_at + 2])]
    if not len(four_at):
        return []
    breaks = np.flatnonzero(np.diff(four_at) > 1)
    begin = four_at[np.concatenate([[0], breaks + 1])]
    end = four_at[np.concatenate([breaks, [len(four_at) - 1]])] + 4
    long = end - begin >= params.shortest
    return list(zip(begin[long].tolist(), end[long].tolist()))


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` in order. Each shared prefix must end in ``s``."""
    m = len(s)
    order = np.argsort(s, kind="stable")
    slots, places, key = np.arange(m), order.copy(), s[order].astype(np.int64)
    rank = np.empty(m, np.int64)
    h = 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(key)))
        rank[places] = np.repeat(slots[head], size)
        shared = np.repeat(size > 1, size)
        slots, places = slots[shared], places[shared]
        if not len(slots):
            return order
        key = rank[places] * m + rank[places + h]
        by = np.argsort(key, kind="stable")
        places, key = places[by], key[by]
        order[slots] = places
        h *= 2


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """``lcp[k]``: words that the suffixes at slots k - 1 and k share."""
    m = len(s)
    before = np.full(m, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(m)
    follows = (at > 0) & (before > 0) & (before[np.maximum(at - 1, 0)] >= 0)
    follows[follows] = s[at[follows] - 1] == s[before[follows] - 1]
    own = np.flatnonzero(~follows & (before >= 0))
    length = np.zeros(m, np.int64)
    todo, other, l = own, before[own], 0
    while len(todo) and l < 32:
        same = s[todo + l] == s[other + l]
        length[todo[~same]] = l
        todo, other = todo[same], other[same]
        l += 1
    for i, j in zip(todo.tolist(), other.tolist()):
        l, block = 32, 64
        while True:
            upto = min(block, m - max(i, j) - l)
            same = s[i + l:i + l + upto] == s[j + l:j + l + upto]
            if not same.all():
                length[i] = l + int(same.argmin())
                break
            l, block = l + upto, min(2 * block, 1 << 16)
    source = np.maximum.accumulate(np.where(follows, 0, at))
    length = np.where(follows, length[source] - (at - source), length)
    return length[order]


def maximal_pairs(s: np.ndarray, params: Params) -> dict[tuple[int, int], int]:
    """``(start, length) -> period`` of the runs of ``s``, which ends each
    stretch with an entry that occurs nowhere else."""
    order = suffix_order(s)
    depth_at = common_prefixes(s, order)
    least, times, shortest = params.least_depth, params.exponent - 1, params.shortest
    left = np.concatenate([[-1], s[:-1]]).tolist()
    found: dict[tuple[int, int], int] = {}

    def pair(i: int, j: int, depth: int) -> None:
        d = j - i
        if d * times <= depth and depth + d >= shortest and left[i] != left[j]:
            span = (i, depth + d)
            found[span] = min(d, found.get(span, d))

    def met(a: list[int], b: list[int], depth: int) -> list[int]:
        """Two children of an interval, as one list; their pairs are noted."""
        if len(a) < len(b):
            a, b = b, a
        if b[0] > a[-1]:
            pair(a[-1], b[0], depth)
            a.extend(b)
            return a
        near = [bisect_left(a, x) for x in b]
        for x, k in zip(b, near):
            if k:
                pair(a[k - 1], x, depth)
            if k < len(a):
                pair(x, a[k], depth)
        if 16 * len(b) < len(a):
            for x, k in zip(reversed(b), reversed(near)):
                a.insert(k, x)
            return a
        return sorted(a + b)

    stack: list[tuple[int, list[int]]] = []  # open intervals: depth, places by now
    places, depths = order.tolist(), [*depth_at.tolist()[1:], 0]
    for place, depth in zip(places, depths):
        if depth < least and not stack:
            continue
        here = [place]
        while stack and stack[-1][0] > depth:
            above, members = stack.pop()
            here = met(members, here, above)
        if depth >= least:
            if stack and stack[-1][0] == depth:
                above, members = stack.pop()
                here = met(members, here, depth)
            stack.append((depth, here))
    return found


def runs_of(texts: list[np.ndarray], params: Params | None = None) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of all runs of each text (word ids from 0),
    by start, then period."""
    params = params or Params()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    highs = np.array([int(t.max()) + 1 if len(t) else 0 for t in texts], np.int64)
    first, base = np.cumsum(sizes) - sizes, np.cumsum(highs) - highs
    if not sizes.sum():
        return out
    ids = np.concatenate([t.astype(np.int64) + b for t, b in zip(texts, base)])
    cut = stretches(ids, params)
    if not cut:
        return out
    # Stretches end to end; words of different stretches differ, and an entry
    # of its own ends each one.
    wide, parts, begins = int(ids.max()) + 2, [], []
    total = 0
    for k, (low, high) in enumerate(cut):
        parts += [ids[low:high] + k * wide, np.array([(k + 1) * wide - 1])]
        begins.append(total)
        total += high - low + 1
    begins = np.array(begins)
    for (place, length), period in maximal_pairs(np.concatenate(parts), params).items():
        k = int(np.searchsorted(begins, place, side="right")) - 1
        at = cut[k][0] + place - int(begins[k])
        of = int(np.searchsorted(first, at, side="right")) - 1
        out[of].append((at - int(first[of]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    if runs:
        stays = np.ones(len(words), bool)
        for start, length, period in runs:
            stays[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def find(docs: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` per row of ``docs``: all runs as
    ``start, length, period`` by start, then period, and the text with each run
    cut down to its first period, words joined by single blanks."""
    params = params or Params()
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def answered(rows: pa.RecordBatch, low: int, texts: list[list[bytes]], ids: list[np.ndarray]) -> pa.RecordBatch:
        found = runs_of(ids, params)
        flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
        ends = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]), pa.int32())
        structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(fields))
        return pa.RecordBatch.from_arrays(
            [rows.column(0).slice(low, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
             pa.ListArray.from_arrays(ends, structs),
             pa.array([collapsed(t, r) for t, r in zip(texts, found)], pa.binary())],
            ["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, texts, ids, size = 0, [], [], 0
            for cell in batch.column(1):
                words = (cell.as_py() or b"").split()  # of bytes: at the blanks named above
                name = defaultdict(count().__next__)
                texts.append(words)
                ids.append(np.fromiter(map(name.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= CHUNK_WORDS or len(texts) >= 1000:
                    yield answered(batch, low, texts, ids)
                    low, texts, ids, size = low + len(texts), [], [], 0
            if texts:
                yield answered(batch, low, texts, ids)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
        .mapInArrow(run, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed binary") \
        .withColumn("collapsed", F.col("collapsed").cast("string")).withColumnRenamed("id", id_col)
