"""Byte-level BPE encoding by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds the longest token at every
position of a piece. The encoder takes the longest token that is *compatible*
with the token before it and backs up where none is. A pair of tokens is
compatible when merging their joined bytes from scratch gives the same two
tokens again; the first sequence whose neighbours are all compatible is the
result of the merges. Each position is abandoned at most once, so the time is
linear in the piece.

Null texts count as empty. Empty texts have no tokens. Special tokens of the
vocabulary file that occur in a text become their own ids unless
``special_as_text`` is set. Repeated rows are encoded row by row. A null
id stays null. Long texts are encoded whole, piece by piece. An empty table
gives no rows. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# The split pattern of byte-level vocabularies and the same in
# the classes of ``re``, used where both agree on every character of a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_RE = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"

CACHE_PIECES = 200_000      # entries per generation of a Python worker's cache
CACHE_PIECE_CHARS = 40      # longer pieces are encoded each time
CACHE_PAIRS = 250_000


def byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that stands for it in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Piece -> packed ids, filled on demand and bounded: the full cache
    becomes the older generation, from which pieces still in use return."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = self.encode(piece)
        if len(piece) <= CACHE_PIECE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Bpe:
    """A vocabulary with its automaton and pair table. Tokens are numbered
    internally by merge order, with the single bytes before all merges."""

    def __init__(self, vocab_json: str, special_as_text: bool = False):
        import ahocorasick
        import regex

        data = json.loads(vocab_json)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = [a + b for a, b in merges]
        alphabet = byte_alphabet()
        base = [alphabet[b] for b in range(256)]
        if len(set(made)) != len(made) or set(made) & set(base):
            raise ValueError("a token that two merges make has no single merge order")
        number = {t: i for i, t in enumerate([*base, *made])}
        self.left = [-1] * 256 + [number[a] for a, _ in merges]
        self.right = [-1] * 256 + [number[b] for _, b in merges]
        self.merged = {(a, b): i for i, (a, b) in enumerate(zip(self.left, self.right)) if a >= 0}
        self.size = [len(t) for t in number]
        self.ids = np.array([vocab[t] for t in number], dtype="<u4")
        self.packed = [int(i).to_bytes(4, "little") for i in self.ids]
        self.shorter = [-1] * len(number)  # the longest other token that a token starts with
        for t, i in number.items():
            self.shorter[i] = next((number[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in number), -1)
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.to_alphabet = str.maketrans({b: c for b, c in alphabet.items()})

        # Decoding: all tokens' bytes end to end, and where each id's begin.
        back = {c: b for b, c in alphabet.items()}
        special = {t["id"]: t["content"] for t in data.get("added_tokens", [])}
        by_id = {v: bytes(back[c] for c in t) for t, v in vocab.items()}
        by_id |= {i: s.encode() for i, s in special.items()}
        parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

        self.special = {} if special_as_text else {s: int(i).to_bytes(4, "little") for i, s in special.items()}
        self.special_split = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.exact_split = regex.compile(SPLIT)
        self.fast_split = re.compile(SPLIT_RE)
        self.odd = _odd_characters()
        self.pair_cache: dict[int, bool] = {}
        self.pieces = _Pieces(self._encode_piece)

    def compatible(self, a: int, b: int) -> bool:
        """Would merging the bytes of ``a`` and ``b`` from scratch keep the
        boundary between them? Undo the later of the two tokens step by step;
        a merge across the boundary that comes before the undone one breaks it."""
        key = a * len(self.left) + b
        limit = len(self.left)
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                good = False
                break
            if a > b:
                limit, a = a, self.right[a]
                if a < 0:
                    good = True
                    break
            else:
                limit, b = b + 1, self.left[b]
                if b < 0:
                    good = True
                    break
        if len(self.pair_cache) >= CACHE_PAIRS:
            self.pair_cache.clear()
        self.pair_cache[key] = good
        return good

    def tokens(self, piece: str) -> list[int]:
        """Internal token numbers of one piece, written in the byte alphabet."""
        n, size, shorter, known, every = len(piece), self.size, self.shorter, self.pair_cache.get, len(self.left)
        longest = [0] * n
        for end, t in self.automaton.iter(piece):
            longest[end - size[t] + 1] = t  # later ends are longer
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else -1
            while True:
                end = at + size[token]
                if dead[end]:
                    fits = False
                elif last < 0:
                    fits = True
                else:
                    fits = known(last * every + token)
                    if fits is None:
                        fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                token = shorter[token]
                if token < 0:  # nothing fits here: the token before must be a shorter one
                    dead[at] = 1
                    token = out.pop()
                    at -= size[token]
                    break
        return out

    def _encode_piece(self, piece: str) -> bytes:
        text = piece.encode("utf-8").decode("latin-1").translate(self.to_alphabet)
        packed = self.packed
        return b"".join([packed[t] for t in self.tokens(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_split is None:
            return self._encode_plain(text)
        return b"".join([self.special.get(part) or self._encode_plain(part)
                         for part in self.special_split.split(text) if part])

    def _encode_plain(self, text: str) -> bytes:
        split = self.exact_split if self.odd.search(text) else self.fast_split
        return b"".join(map(self.pieces.__getitem__, split.findall(text)))

    def decode(self, packed: bytes) -> str:
        """Text of packed ids: gather each id's bytes through the offset table."""
        ids = np.frombuffer(packed, dtype="<u4")
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        where = np.repeat(starts - (ends - sizes), sizes) + np.arange(total)
        return self.flat[where].tobytes().decode("utf-8", errors="replace")


def _odd_characters() -> re.Pattern:
    """Matches every character on which the two split patterns disagree, and
    all beyond the basic plane."""
    import regex

    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    joined = "".join(every)
    classes = ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))
    odd = sorted(set().union(*(set(regex.findall(a, joined)) ^ set(re.findall(b, joined)) for a, b in classes)))
    return re.compile("[" + "".join(map(re.escape, odd)) + "\U00010000-\U0010ffff]")


_LOADED: dict[tuple, Bpe] = {}


def load(file_name: str, special_as_text: bool) -> Bpe:
    """The vocabulary inside a task, built once per Python worker."""
    key = (file_name, special_as_text)
    if key not in _LOADED:
        with open(SparkFiles.get(file_name), encoding="utf-8") as f:
            _LOADED[key] = Bpe(f.read(), special_as_text)
    return _LOADED[key]


def ship_vocabulary(spark, vocab_path: str) -> str:
    """Send the vocabulary file (a few MB) to the executors; its name there."""
    ship(spark)
    if vocab_path not in (sent := spark.sparkContext.__dict__.setdefault("_weblattice_files", set())):
        spark.sparkContext.addFile(vocab_path)
        sent.add(vocab_path)
    return vocab_path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           special_as_text: bool = False, with_text: bool = True) -> DataFrame:
    """``id_col, n_tokens, ids (binary, little-endian u32), decoded`` per row.

    Rows keep their multiplicity; other columns of ``docs`` are not read. With
    ``with_text=False`` nothing is decoded and the last column is left out.
    """
    name = ship_vocabulary(docs.sparkSession, vocab_path)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"row_id {kind}, n_tokens long, ids binary" + ", decoded string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(name, special_as_text)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            cols = [batch.column(0), pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(ids, pa.binary())]
            if with_text:
                cols.append(pa.array([bpe.decode(b) for b in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["row_id", "n_tokens", "ids", *["decoded"] * with_text])

    out = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, fields)
    return out.withColumnRenamed("row_id", id_col)


def digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``. The ids and the
    decoded text of a document are hashed where they are made, so neither
    leaves its task."""
    name = ship_vocabulary(docs.sparkSession, vocab_path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(name, False)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
