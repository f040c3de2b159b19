"""N-gram Jaccard join: exact links and classes of near-equal word sets.

A text's set holds its distinct shingles of ``words`` words. Two texts link
when ``100 * |A & B| >= percent * |A | B|``. The join loses no link:

1. *Keys.* Shingles have one order for all texts: first those of a hashed
   share of the shingle space, rare before frequent; then the others. Of two
   linked sets of n shingles or fewer, both hold a common shingle among their
   first ``n - ceil(percent * n / 100) + 1``. Those of them that another set
   holds too are the keys. Shingles that no other set holds come first, need no
   key, and use up places, so a passage that many documents share gives keys to
   those texts only that hardly hold anything else.
2. *Families.* Sets that share a key meet there with their sizes and sketches
   (parities of hashed shingles; sets whose sketches differ in k bits differ in
   at least k shingles). Those that may link by both are tied, and form families
   (connected components). Every link lies inside a family. Texts that share
   phrases by chance, which in a large table nearly all do, are not tied.
3. *Tiles.* A family is dealt into tiles by size band and hash. Only tiles of
   a band meet, and sets near its upper end are guests in the next. In a pair of tiles, hashed bitmaps
   bound the overlap from above: sets that differ in k bits differ in at least
   k shingles. Pairs that pass are intersected as sorted arrays. Sets that
   are already connected inside the pair of tiles are not compared again.
4. *Classes* are the connected components over all links. Equal sets share a
   class without pairs.

Words are runs other than blanks and control spaces, with A-Z in small
letters; fewer than ``words`` words form one shingle. A null, empty or blank
text has an empty set and a class of its own. Rows that repeat an id are
separate texts of one class id. A row with a null id links with nothing and
has a null class. Texts are
processed whole, however long. Of a class the smallest id names it; the order
of equal sets does not matter. An empty table gives no rows. ``classes`` reads
no other columns, whatever their names; ``one_of_each`` hands the columns of
documents on.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_id, discard, ship, written
from .components import components

COUNTED = 1.6            # share of the shingles that are counted, in shares that linked sets may miss
TILE_SHINGLES = 2_000_000  # a tile of a family holds about so many (16 MB), where
TILE_BAND = 4              # size band of tiles, in ratios of linked sizes
SET_WEIGHT = 100           # a set counts as so many more
SKETCH_BITS = 256, 4096    # of a set's sketch, at least and at most
HOT_SAMPLED = 64           # rows of a hashed 1/64 that make a key hot
CACHE_WORDS = 400_000    # words whose hashes a Python worker keeps

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Measure:
    """``words`` of a shingle; link when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    def prefix(self, size: int) -> int:
        """Shingles of a set of which a linked set holds one, in any order that
        is the same for both."""
        return size - -(-size * self.percent // 100) + 1

    def apart(self, size: int) -> int:
        """Shingles by which a set and a linked one of its size can differ."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    @property
    def counted_below(self) -> int:
        """Shingle hashes below this are counted over all texts."""
        return min(int(COUNTED * (100 - self.percent) / 100 * (1 << 64)), (1 << 64) - 1)


class WordHash(dict):
    """Word -> 64-bit hash, filled on demand, bounded."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int, known: WordHash) -> np.ndarray:
    """The text's set: sorted distinct 64-bit shingle hashes."""
    found = WORDS.findall((text or "").translate(LOWER) if not (text or "").isascii() else (text or "").lower())
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = max(len(h) - words + 1, 1)
    total = np.full(n, len(h) if len(h) < words else words, np.uint64)
    for k in range(min(words, len(h))):
        total = mixed(total * _M1 + h[k:n + k])
    return np.unique(total)


def digest(h: np.ndarray) -> int:
    """Of a set, as a signed 64-bit integer."""
    d = hashlib.blake2b(h.tobytes(), digest_size=8).digest()
    return int.from_bytes(d, "little", signed=True)


def lowest(h: np.ndarray, measure: Measure) -> np.ndarray:
    """Of a set (sorted): the counted shingles, or its prefix if that is more,
    as signed 64-bit integers."""
    counted = int(np.searchsorted(h, np.uint64(measure.counted_below)))
    return h[:max(counted, measure.prefix(len(h)))].view(np.int64)


def sketch(h: np.ndarray, measure: Measure) -> bytes:
    """Of a set: for each value of its shingles' low bits, whether their number
    is odd. So many bits that sets without much in common differ in more of
    them than linked ones can, up to a most. Halves of a sketch, xored, are the
    sketch of half the bits."""
    bits, most = SKETCH_BITS
    while bits < most and bits < 3 * measure.apart(len(h)):
        bits *= 2
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def features(docs: DataFrame, measure: Measure, id_col: str, text_col: str, lowest_only: bool) -> DataFrame:
    """``id, text_hash, n_shingles, set_id`` and the sketch and lowest shingles,
    or all shingles, of each row. The empty set has a null set id."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    last = "sketch binary, lowest array<bigint>" if lowest_only else "shingles binary"
    names = ["id", "text_hash", "n_shingles", "set_id", *(c.split()[0] for c in last.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                sets = [shingles(t, measure.words, known) for t in part.column(1).to_pylist()]
                ids = pa.array([digest(h) if len(h) else None for h in sets], pa.int64())
                if lowest_only:
                    own = [lowest(h, measure) if len(h) else np.empty(0, np.int64) for h in sets]
                    ends = np.concatenate([[0], np.cumsum([len(k) for k in own])])
                    more = [pa.array([sketch(h, measure) if len(h) else None for h in sets], pa.binary()),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own), pa.int64()))]
                else:
                    more = [pa.array([h.tobytes() for h in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(h) for h in sets], pa.int64()), ids, *more], names)

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")) \
        .mapInArrow(run, f"id {kind}, text_hash bigint, n_shingles bigint, set_id bigint, {last}")


def first_ids(feats: DataFrame) -> DataFrame:
    """``set_id, least_id``: the smallest id of each set; copies are
    pre-aggregated before they meet."""
    return feats.where("set_id is not null").groupBy("set_id").agg(F.min("id").alias("least_id"))


def hot_shingles(rows: DataFrame) -> DataFrame:
    """``hot``: shingles that very many rows hold, by a count over a hashed 1/64
    of the rows; at most ``BROADCAST_IDS``, the most frequent. Which shingles
    are hot changes where their rows meet, not the result."""
    return written(rows.where(F.pmod(F.xxhash64("id", "text_hash"), F.lit(64)) == 0)
                   .select(F.explode("lowest").alias("hot")).groupBy("hot").count().where(F.col("count") >= HOT_SAMPLED)
                   .orderBy(F.desc("count"), "hot").limit(BROADCAST_IDS).select("hot"), "hot-shingles")


def keys(feats: DataFrame, hot: DataFrame, measure: Measure) -> DataFrame:
    """``set_id, key, is_hot``: of each set's prefix, the shingles that other
    sets hold too.

    Counted shingles cross the network once, to the task that counts them;
    those of a single set end there. Hot ones stay where they are: their counts
    are pre-aggregated and broadcast to the rows. Shared shingles then go to
    their set, which ranks them: rare first, hot last.
    """
    rows = feats.where("set_id is not null")
    entry = rows.select("set_id", F.explode("lowest").alias("key"))
    whole = Window.partitionBy("key")
    cold = entry.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left_anti") \
        .withColumn("n", F.count("*").over(whole)).withColumn("least", F.min("set_id").over(whole)) \
        .withColumn("most", F.max("set_id").over(whole)).where("least <> most") \
        .dropDuplicates(["key", "set_id"]).select("set_id", "key", "n", F.lit(False).alias("is_hot"))
    held = entry.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left_semi")
    known = held.groupBy(F.col("key").alias("hot")).agg(F.count("*").alias("n"), F.min("set_id").alias("least"), F.max("set_id").alias("most")) \
        .where("least <> most").select("hot", "n")
    often = held.join(F.broadcast(known), F.col("key") == F.col("hot")).select("set_id", "key", "n", F.lit(True).alias("is_hot")).distinct()
    size = F.col("n_shingles")
    prefix = size - F.ceil(size * measure.percent / F.lit(100)) + 1
    places = rows.select(F.col("set_id").alias("of_set"), (F.size("lowest") - prefix).alias("spare")).distinct()
    by_set = Window.partitionBy("set_id")
    ranked = cold.unionByName(often) \
        .withColumn("place", F.row_number().over(by_set.orderBy("is_hot", "n", "key"))) \
        .withColumn("shared", F.count("*").over(by_set))
    return ranked.join(places, F.col("set_id") == F.col("of_set")).where("place <= shared - spare").select("set_id", "key", "is_hot")


def near_pairs(key: np.ndarray, size: np.ndarray, sketches: list[bytes], measure: Measure) -> list[tuple[int, int]]:
    """Of rows in order of key, then size: a spanning forest of the pairs of one
    key that may link by their sizes and sketches, as pairs of places."""
    n = len(key)
    length = np.array([len(s) for s in sketches])
    own = {w: np.frombuffer(b"".join(sketches[i] for i in np.flatnonzero(length == w)), np.uint64).reshape(-1, w // 8)
           for w in np.unique(length).tolist()}

    def as_long(w: int) -> np.ndarray:
        """The sketches of that length or more, folded to it; one row for each of ``key``."""
        out = np.zeros((n, w // 8), np.uint64)
        for longer, m in own.items():
            if longer >= w:
                while m.shape[1] > w // 8:
                    m = m[:, :m.shape[1] // 2] ^ m[:, m.shape[1] // 2:]
                out[length == longer] = m
        return out

    folded = {w: as_long(w) for w in own}

    def may_link(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = np.zeros(len(a), np.int64)
        for w, m in folded.items():  # the smaller set's sketch is no longer than the other's
            of = length[a] == w
            differ[of] = np.bitwise_count(m[a[of]] ^ m[b[of]]).sum(1, dtype=np.int64)
        both = size[a] + size[b]
        shared = (both - differ) // 2
        return 100 * shared >= measure.percent * (both - shared)

    at = np.arange(n - 1)
    at = at[(key[at] == key[at + 1]) & (100 * size[at] >= measure.percent * size[at + 1])]
    at = at[may_link(at, at + 1)]
    out = list(zip(at.tolist(), (at + 1).tolist()))
    new = np.ones(n, np.int64)
    new[at + 1] = 0
    root = np.cumsum(new)  # runs of neighbours that may link
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first = np.repeat(starts, np.diff(np.append(starts, n)))
    last = np.repeat(np.append(starts[1:], n) - 1, np.diff(np.append(starts, n)))
    at, step = np.flatnonzero(root[first] != root[last]), 1
    while len(at):
        step += 1
        at = at[at + step <= last[at]]
        at = at[100 * size[at] >= measure.percent * size[at + step]]
        apart = at[root[at] != root[at + step]]
        for a in apart[may_link(apart, apart + step)].tolist():
            if root[a] != root[a + step]:
                out.append((a, a + step))
                group = root[first[a]:last[a] + 1]
                group[group == root[a + step]] = root[a]
    return out


def near_edges(rows: DataFrame, measure: Measure) -> DataFrame:
    """``src, dst``: sets of one key that may link, of ``set_id, key,
    n_shingles, sketch``. The rows of a key meet in one task, as arrays."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> pa.RecordBatch:
            ids = t.column("set_id").to_numpy()
            pairs = near_pairs(t.column("key").to_numpy(), t.column("n_shingles").to_numpy(), t.column("sketch").to_pylist(), measure)
            return pa.RecordBatch.from_arrays([pa.array(ids[[p[k] for p in pairs]], pa.int64()) for k in (0, 1)], ["src", "dst"])

        held: list[pa.RecordBatch] = []  # of a key that the next batch may go on with
        for batch in batches:
            key = batch.column(batch.schema.get_field_index("key")).to_numpy()
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut or held and held[-1].column("key")[-1].as_py() != key[-1]:
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield found(pa.Table.from_batches(held))

    return rows.select("set_id", "key", "n_shingles", "sketch").repartition("key").sortWithinPartitions("key", "n_shingles") \
        .mapInArrow(run, "src bigint, dst bigint")


def families(feats: DataFrame, measure: Measure) -> DataFrame:
    """``node, component`` over set ids that may link with another set of a key.
    Of a hot key each set is tied to the first, which is broadcast to the rows."""
    hot = hot_shingles(feats.where("set_id is not null"))
    key = written(keys(feats, hot, measure), "ngram-keys")
    often = key.where("is_hot")
    hubs = often.groupBy(F.col("key").alias("hub_key")).agg(F.min("set_id").alias("hub"))
    sketches = feats.where("set_id is not null").select(F.col("set_id").alias("of_set"), "n_shingles", "sketch").dropDuplicates(["of_set"])
    edges = near_edges(key.where("not is_hot").join(sketches, F.col("set_id") == F.col("of_set")), measure) \
        .unionByName(often.join(F.broadcast(hubs), F.col("key") == F.col("hub_key")).where("set_id <> hub")
                     .select(F.col("set_id").alias("src"), F.col("hub").alias("dst")))
    out = components(edges, label="families")
    discard(hot, key)
    return out


def tile_links(sets: list[np.ndarray], measure: Measure, side: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` (distinct, sorted arrays)
    as pairs of their places, exact. With ``side`` (0 or 1 for each set), of
    the links between the two sides."""
    n = len(sets)
    order = sorted(range(n), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order], np.int64)
    bits = 64
    while bits < 4 * int(np.median(size)) and bits < 1 << 14:
        bits *= 2
    maps = np.zeros((n, bits // 64), np.uint64)
    for row, i in enumerate(order):
        at = (sets[i] >> np.uint64(3)) % np.uint64(bits)
        np.bitwise_or.at(maps[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    root = np.arange(n)
    of = np.array([side[i] for i in order]) if side and len(set(side)) > 1 else None
    out = []
    for row in range(1, n):
        low = int(np.searchsorted(size, -(-size[row] * measure.percent // 100)))
        if low >= row:
            continue
        differ = np.bitwise_count(maps[low:row] ^ maps[row]).sum(1, dtype=np.int64)
        both = size[low:row] + size[row]
        near = low + np.flatnonzero(100 * ((both - differ) // 2) >= measure.percent * (both - (both - differ) // 2))
        if of is not None:
            near = near[of[near] != of[row]]
        while len(near):
            near = near[root[near] != root[row]]
            if not len(near):
                break
            other = int(near[0])
            near = near[1:]
            a, b = sets[order[other]], sets[order[row]]
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * shared >= measure.percent * (len(a) + len(b) - shared):
                out.append((order[row], order[other]))
                gone, stays = root[row], root[other]
                root[root == gone] = stays
    return out


def _small(table: DataFrame, rows: int) -> DataFrame:
    """To be broadcast if its count allows; else joined by shuffle."""
    return F.broadcast(table) if rows <= BROADCAST_IDS else table


def linked(docs: DataFrame, feats: DataFrame, family: DataFrame, measure: Measure, id_col: str, text_col: str) -> DataFrame:
    """``node, component`` of the set ids that link with another."""
    spark = docs.sparkSession
    member = family.select(F.col("node").alias("set_id"), F.col("component").alias("family"))
    # One text of each set that belongs to a family; copies need no second look.
    sizes = feats.where("set_id is not null").groupBy("set_id").agg(
        F.min("id").alias("text_id"), F.first("n_shingles").alias("n_shingles"))
    texts = written(sizes.join(member, "set_id"), "family-texts")
    own = by_id(docs.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("text")),
                texts.select("text_id"), "left_semi", "text_id")
    # A repeated id brings several texts; the set id says which belongs.
    found = features(own, measure, "text_id", "text", lowest_only=False) \
        .select(F.col("id").alias("text_id"), "set_id", "shingles")
    sets = found.join(_small(texts, texts.count()), ["text_id", "set_id"]).select("set_id", "family", "n_shingles", "shingles")
    if feats.groupBy("id", "set_id").count().where("count > 1 and set_id is not null").head() is not None:
        sets = sets.dropDuplicates(["set_id"])  # rows that repeat id and text

    # A band spans several times the ratio of linked sizes. A set whose larger
    # partners can lie in the next band is a guest there; the margin sees to
    # it that rounding parts no pair.
    ratio = math.log(100 / measure.percent)
    log_size = F.log(F.col("n_shingles").cast("double"))
    band = F.floor(log_size / (TILE_BAND * ratio)).cast("int")
    reach = F.floor((log_size + 1.001 * ratio) / (TILE_BAND * ratio)).cast("int")
    weight = F.sum(F.col("n_shingles") + SET_WEIGHT)
    whole = texts.groupBy("family").agg(weight.alias("weight"))
    by_band = texts.groupBy("family", band.alias("band")).agg(weight.alias("in_band"))
    tiles = by_band.join(whole, "family").select(
        "family", "band", F.when(F.col("weight") <= TILE_SHINGLES, 0)
        .otherwise(F.ceil(F.col("in_band") / TILE_SHINGLES)).cast("int").alias("tiles"))
    up = tiles.select("family", (F.col("band") - 1).alias("band"), F.col("tiles").alias("above"))
    plan = written(tiles.join(up, ["family", "band"], "left").na.fill(0), "family-tiles")
    # A small family is one tile; in others a set meets every tile of its own
    # band, and as a guest every tile of the next. A pair is named by its band
    # and its two tiles, in order.
    dealt = sets.withColumn("band", band).withColumn("guest", reach > band).join(_small(plan, plan.count()), ["family", "band"]) \
        .withColumn("own", F.pmod(F.xxhash64("set_id"), F.greatest(F.col("tiles"), F.lit(1))).cast("int"))
    def meet(count: str, b: str, x: str, y: str, side: str) -> str:
        entry = f"named_struct('pair', named_struct('b', {b}, 'x', {x}, 'y', {y}), 'side', {side})"
        return f"transform(filter(sequence(0, {count}), t -> t < {count}), t -> {entry})"

    meetings = f"""if(tiles = 0, {meet("1", "-1", "0", "0", "0")}, concat(
        {meet("tiles", "band", "least(t, own)", "greatest(t, own)", "if(own <= t, 0, 1)")},
        {meet("if(guest, above, 0)", "band + 1", "t", "t", "0")}))"""
    pairs = dealt.withColumn("m", F.explode(F.expr(meetings))) \
        .select("family", F.col("m.pair").alias("pair"), F.col("m.side").alias("side"), "set_id", "shingles")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["set_id"].to_numpy()
        found = tile_links([np.frombuffer(b, np.uint64) for b in group["shingles"]], measure, group["side"].tolist())
        return pd.DataFrame({"src": [ids[a] for a, _ in found], "dst": [ids[b] for _, b in found]}, dtype="int64")

    ship(spark)
    links = pairs.groupBy("family", "pair").applyInPandas(compare, "src bigint, dst bigint")
    out = components(links, label="classes")
    discard(texts, plan)
    return out


def classes(docs: DataFrame, measure: Measure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_hash, n_shingles, component_id`` per row of ``docs``: the
    size of its set and the smallest id that links reach."""
    counted = written(features(docs, measure, id_col, text_col, lowest_only=True)
                      .withColumn("set_id", F.expr("if(id is null, null, set_id)")), "ngram-counted")
    feats = written(counted.drop("lowest", "sketch"), "ngram-set-ids")
    family = families(counted, measure)
    discard(counted)
    joined = linked(docs, feats, family, measure, id_col, text_col)
    labelled = first_ids(feats).join(joined, F.col("set_id") == F.col("node"), "left") \
        .select("set_id", F.coalesce("component", "set_id").alias("class"), "least_id")
    least = labelled.groupBy("class").agg(F.min("least_id").alias("component_id"))
    by_set = labelled.join(least, "class").select(F.col("set_id").alias("of_set"), "component_id")
    out = written(feats.join(by_set, F.col("set_id") == F.col("of_set"), "left").select(
        F.col("id").alias(id_col), "text_hash", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")), "class-of-text")
    discard(feats, family, joined)
    return out


def one_of_each(docs: DataFrame, measure: Measure) -> DataFrame:
    """``docs`` (columns of documents) with one row of each class: its
    smallest id, and of that id's rows in the class the first by a hash of the
    text. Rows with a null id all stay."""
    of = classes(docs, measure)
    pairs = of.where("component_id is not null")
    keep = pairs.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
    gone = pairs.join(keep.withColumnRenamed("component_id", "kept_class"), F.col("component_id") == F.col("kept_class")) \
        .where(F.struct("doc_id", "text_hash") != F.col("k")).select("doc_id", "text_hash")
    hashed = docs.withColumn("__row", F.struct("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash")))
    left = by_id(hashed, written(gone.select(F.struct("doc_id", "text_hash").alias("r")), "copies"), "left_anti", "__row")
    again = written(pairs.groupBy("doc_id", "text_hash").count().where("count > 1")
                    .select(F.struct("doc_id", "text_hash").alias("r")), "repeated-rows")
    if again.head() is not None:  # whole rows that repeat: one of them
        left = by_id(left, again, "left_anti", "__row").unionByName(
            by_id(left, again, "left_semi", "__row").dropDuplicates(["__row"]))
    return left.drop("__row")
