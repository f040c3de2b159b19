"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans, each kind leftmost and non-overlapping. The
field tags a text's tokens (runs without white space) as secret begin, inside
or outside, from the shape of a token, the shapes and words of its neighbours
and features of the whole text. It is trained here by gradient steps on the
likelihood, on a bounded sample, and decoded by Viterbi. The sample's tags come
from the base spans. So that the field learns more than the patterns say, each
text with base spans is also learnt from with every span replaced by a made
secret of one of FORMS, mostly without its keyword, and any other text with a
decoy put in: a token of DECOYS, which looks like a secret and is none. Both
are also learnt from as snippets of a few words. Spans that it finds apart from the base ones are added;
base spans always stay.

Decoding is exact but skips what cannot matter: where the score of "outside"
beats each other tag by more than the two moves around it could give back,
the tag is outside whatever its neighbours are, and the chain falls apart
there. In a text of plain words alone all scores are alike; that no stretch of
other tags gains there is checked once on the model.

Null texts count as empty. Offsets are code points, ends exclusive. Rows that
repeat, and rows with null ids, are scanned row by row. Texts
are scanned whole, however long. Of equally likely taggings one is taken by a
fixed order of the tags. An empty table gives no rows; without a base span the
field adds none. ``scans`` reads no other columns, whatever their names;
``redacted`` hands the columns of documents on.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# The base patterns, the least length of what they find, and
# the words that the first one starts with.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the same matches as KINDS' hex that are long enough

TOKEN = re.compile(r"\S+")
MARKED = re.compile(r"[^\w\s.,;!?'’-]|[\d_]")
#: ASCII that MARKED never is.
UNMARKED = bytes(c for c in range(128) if not MARKED.search(chr(c)))
#: Of a text without marks, what is not a plain word: capitals, and tokens of punctuation alone.
CAPITALS = re.compile(r"[A-Z][A-Z]{15}")
BARE = re.compile(r"[^\w\s](?<!\S.)[^\w\s]*(?!\S)")
EDGE = "\"'`()[]{}<>,;.!?"
OUT, BEGIN, INSIDE = 0, 1, 2
ADDED = "crf"

SHAPES = ("plain", "keyword", "assign", "number", "hex", "short_mix", "mix", "long_mix",
          "keyword_value", "address", "symbols", "marked", "capitals", "key_value", "random", "login")
WORD_BUCKETS = 256
RUN = re.compile(r"[A-Za-z0-9]{16,}")
ALIKE = re.compile(r"[a-z]+|[A-Z]+|[0-9]+")   # stretches of one class
LOGIN = re.compile(r"://[^/\s:@]+:[^/\s@]+@")
FORMS = ("random", "prefixed", "grouped", "login", "capital_hex")
DECOYS = ("uuid", "slug", "camel", "number", "address", "file")
CACHE_TOKENS = 100_000


@dataclass(frozen=True)
class Params:
    """About ``sample_rows`` rows are learnt from, half of them with a base
    span where there are so many, and never more than twice as many;
    ``sample_chars`` bounds the length of one. Of a text, the tokens that are
    not plain (``odd_tokens`` of them at most, beside all its secrets) and two
    others are learnt from, each with ``reach`` neighbours on either side; of
    such stretches without a secret, ``rest`` for each with one, and
    ``rest_least`` more. A text with spans of ``kinds`` has ``swaps`` copies with
    made secrets of ``forms``. A gradient step takes ``batch`` chains."""

    sample_rows: int = 1500
    sample_chars: int = 20_000
    odd_tokens: int = 40
    reach: int = 3
    rest: int = 4
    rest_least: int = 500
    swaps: int = 4
    kinds: tuple[str, ...] = KINDS
    forms: tuple[str, ...] = FORMS
    epochs: int = 6
    batch: int = 8
    rate: float = 0.5
    decay: float = 1e-4
    seed: int = 3


@dataclass
class Model:
    own: np.ndarray      # shapes x tags
    before: np.ndarray   # shape of the token before
    after: np.ndarray
    word_before: np.ndarray   # hashed words of the neighbours, for tokens that are not plain
    word_after: np.ndarray
    file: np.ndarray     # share of marked tokens, in four steps
    moves: np.ndarray    # tags x tags
    plain_is_out: bool = False


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", *m.span()) for m in PATTERNS["assign"].finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in PATTERNS["access"].finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", *m.span()) for m in LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(token: str) -> int:
    """Index into SHAPES."""
    t = token.strip(EDGE)
    low = t.lower()
    word = any(k in low for k in KEYWORDS)
    if word:
        return SHAPES.index("keyword_value" if re.search(r"[:=].{6}", t) else "keyword")
    if t in ("=", ":", ":=", "=>") or token in ("=", ":", ":=", "=>"):
        return SHAPES.index("assign")
    if not t:
        return SHAPES.index("symbols")
    if "@" in t or "://" in t:
        return SHAPES.index("login" if LOGIN.search(t) else "address")
    digits = sum(c.isdigit() for c in t)
    letters = sum(c.isalpha() for c in t)
    if re.fullmatch(r"[A-Za-z_]\w*[:=].{6,}", t, re.A) and digits:
        return SHAPES.index("key_value")
    if re.fullmatch(r"[0-9a-fA-F]{16,}", t) and digits and digits < len(t):
        return SHAPES.index("hex")
    if digits and not letters:
        return SHAPES.index("number")
    if digits and any(random_like(m[0]) for m in RUN.finditer(t)):
        return SHAPES.index("random")
    if digits:
        return SHAPES.index("long_mix" if len(t) >= 20 else "mix" if len(t) >= 12 else "short_mix")
    if len(t) >= 16 and t.isascii() and t.isalpha() and t.isupper():
        return SHAPES.index("capitals")
    if not letters:
        return SHAPES.index("symbols")
    return SHAPES.index("marked" if MARKED.search(t) else "plain")


def random_like(run: str) -> bool:
    """Whether letters and digits change class as often as in random strings:
    names in camel case hold few digits and change twice a word (of very short words they pass, too)."""
    digits, parts = sum(c.isdigit() for c in run), len(ALIKE.findall(run))
    return 0 < digits < len(run) and (2 * parts >= len(run) or 8 * digits >= len(run) and 10 * parts >= 3 * len(run))


class Tokens(dict):
    """Token -> (shape, bucket of the word), filled on demand, bounded."""

    def __missing__(self, token: str) -> tuple[int, int]:
        found = shape(token), zlib.crc32(token.strip(EDGE).lower().encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        if len(self) >= CACHE_TOKENS:
            self.clear()
        self[token] = found
        return found


def columns(tokens: list[str], known: Tokens) -> tuple[np.ndarray, np.ndarray, int]:
    """Shapes and words with a neutral neighbour at either end, and the file step."""
    got = np.array([known[t] for t in tokens], np.int64).reshape(-1, 2)
    edge = np.zeros((1, 2), np.int64)
    got = np.concatenate([edge, got, edge])
    share = float((got[1:-1, 0] != 0).mean()) if len(tokens) else 0.0
    return got[:, 0], got[:, 1], 0 if share < 0.002 else 1 if share < 0.02 else 2 if share < 0.2 else 3


def unary(model: Model, shapes: np.ndarray, words: np.ndarray, step: int) -> np.ndarray:
    here = shapes[1:-1]
    u = model.own[here] + model.before[shapes[:-2]] + model.after[shapes[2:]] + model.file[step]
    odd = np.flatnonzero(here)
    u[odd] += model.word_before[words[:-2][odd]] + model.word_after[words[2:][odd]]
    return u


def slack(moves: np.ndarray) -> np.ndarray:
    """What the moves around a token can give back, for each tag but "outside",
    whatever the tags beside it; at the ends of a text one move is missing."""
    before, after = (moves - moves[:, [OUT]]).max(0), (moves - moves[[OUT]]).max(1)
    return (np.maximum(before, 0) + np.maximum(after, 0))[1:]


def stays_out(scores: np.ndarray, moves: np.ndarray) -> bool:
    """Whether a text whose tokens all have these scores decodes to "outside":
    no stretch of other tags, of any length, gains on it."""
    gain, more = float((scores[1:] - scores[OUT]).max()), moves - moves[OUT, OUT]
    ends = max(0.0, float(more[OUT, 1:].max())) + max(0.0, float(more[1:, OUT].max()))
    return gain + ends < 0 and gain + float(more[1:, 1:].max()) <= 0


def viterbi(u: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of a text; only stretches that can leave "outside" are walked."""
    n = len(u)
    tags = np.zeros(n, np.int64)
    open_ = np.flatnonzero((u[:, [OUT]] - u[:, 1:] <= slack(moves)).any(1))
    if not len(open_):
        return tags
    t = moves.tolist()
    for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
        first, last = int(run[0]), int(run[-1])
        rows = u[first:last + 1].tolist()
        best = [rows[0][k] + (t[OUT][k] if first else 0.0) for k in range(3)]
        back = [None]
        for row in rows[1:]:
            came, new = [], []
            for k in range(3):
                scores = (best[0] + t[0][k], best[1] + t[1][k], best[2] + t[2][k])
                j = scores.index(max(scores))
                came.append(j)
                new.append(scores[j] + row[k])
            best = new
            back.append(came)
        if last + 1 < n:
            best = [best[k] + t[k][OUT] for k in range(3)]
        k = best.index(max(best))
        for i in range(last, first - 1, -1):
            tags[i] = k
            if back[i - first]:
                k = back[i - first][k]
    return tags


def tag_runs(tags: np.ndarray) -> list[tuple[int, int]]:
    """First token and the one after the last of each tagged secret."""
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(tags).tolist():
        if out and out[-1][1] == i and tags[i] == INSIDE:
            out[-1] = (out[-1][0], i + 1)
        else:
            out.append((i, i + 1))
    return out


def is_plain(text: str) -> bool:
    """Whether every token's shape is plain, at a glance: no mark, no keyword, nothing odd, no ² or ½."""
    rest = text.encode("utf-8", "surrogatepass").translate(None, UNMARKED).decode("utf-8", "surrogatepass")
    if MARKED.search(rest) or not all(c.isalpha() or not c.isalnum() for c in set(rest)):
        return False
    low = text.lower()
    return not any(k in low for k in KEYWORDS) and not CAPITALS.search(text) and not BARE.search(text)


def added_spans(text: str, model: Model | None, base: list[tuple[str, int, int]], known: Tokens) -> list[tuple[str, int, int]]:
    """Spans of the field that touch no base span, without quotes and brackets at their ends."""
    if model is None:
        return []
    if model.plain_is_out and is_plain(text):
        return []
    found = list(TOKEN.finditer(text))
    tags = viterbi(unary(model, *columns([m[0] for m in found], known)), model.moves)
    out = []
    for a, b in tag_runs(tags):
        start, end = found[a].start(), found[b - 1].end()
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        if start < end and not any(s < end and start < e for _, s, e in base):
            out.append((ADDED, start, end))
    return out


def scan(text: str | None, model: Model | None, known: Tokens) -> tuple[list, list]:
    """Base spans, and all spans in order."""
    base = base_spans(text or "")
    more = added_spans(text, model, base, known) if text else []
    return base, sorted(base + more, key=lambda s: (s[1], (*KINDS, ADDED).index(s[0])))


def written_out(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def gradient(u: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gradients`` of one chain."""
    du, dm = gradients(u[:, None], moves, tags[:, None], np.ones((len(u), 1), bool))
    return du[:, 0], dm


def gradients(u: np.ndarray, moves: np.ndarray, tags: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log likelihood of ``tags``, summed over chains for the moves:
    forward-backward over chains side by side. ``u`` is places x chains x tags;
    a chain has the places that are ``held``, the first ones."""
    alpha, beta = np.empty_like(u), np.zeros_like(u)
    alpha[0] = u[0]
    for i in range(1, len(u)):
        alpha[i] = np.where(held[i, :, None], _sum_exp(alpha[i - 1][:, :, None] + moves, 1) + u[i], alpha[i - 1])
    for i in range(len(u) - 2, -1, -1):
        beta[i] = np.where(held[i + 1, :, None], _sum_exp(moves + (u[i + 1] + beta[i + 1])[:, None, :], 2), 0)
    total = _sum_exp(alpha[-1], 1)[:, None]
    du = np.where(held[..., None], -np.exp(alpha + beta - total), 0)
    place, chain = np.nonzero(held)
    du[place, chain, tags[place, chain]] += 1
    place, chain = np.nonzero(held[1:])
    both = alpha[place, chain][:, :, None] + moves + (u + beta)[place + 1, chain][:, None, :] - total[chain][:, :, None]
    dm = -np.exp(both).sum(0)
    np.add.at(dm, (tags[place, chain], tags[place + 1, chain]), 1)
    return du, dm


def _letters(rng: np.random.Generator, low: int, high: int, alphabet: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), rng.integers(low, high)))


def made(form: str, rng: np.random.Generator) -> str:
    """A random token of one of FORMS or DECOYS."""
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = small + small.upper() + digits
    word = lambda: _letters(rng, 3, 9)
    value = _letters(rng, 20, 45, every)
    if form == "prefixed":
        return _letters(rng, 2, 6) + "_-"[rng.integers(2)] + value
    if form == "grouped":
        return "-".join([_letters(rng, 3, 6), *(_letters(rng, 8, 13, digits) for _ in range(rng.integers(1, 3))), value])
    if form == "login":
        return f"{word()}://{word()}:{_letters(rng, 6, 20, every)}@{word()}.{word()}/{word()}"
    if form == "capital_hex":
        return _letters(rng, 32, 41, digits + "ABCDEF")
    if form == "uuid":
        return "-".join(_letters(rng, n, n + 1, digits + "abcdef") for n in (8, 4, 4, 4, 12))
    if form == "slug":
        return "-".join([word(), *(_letters(rng, 1, 5, digits) if rng.random() < 0.4 else word() for _ in range(rng.integers(3, 8)))])
    if form == "camel":
        return "".join([word(), *(word().capitalize() for _ in range(rng.integers(2, 5))), _letters(rng, 1, 3, digits)])
    if form == "number":
        return _letters(rng, 10, 24, digits)
    if form == "address":
        return f"https://{word()}.{word()}/{word()}/{_letters(rng, 2, 8, digits)}" if rng.random() < 0.6 else f"{word()}.{_letters(rng, 1, 4, digits)}@{word()}.{word()}"
    if form == "file":
        return "/".join(word() for _ in range(rng.integers(2, 5))) + f"_v{rng.integers(1, 30)}.{_letters(rng, 2, 5)}"
    return value


def snippet(text: str, start: int, end: int, rng: np.random.Generator, secret: bool) -> tuple[str, list[tuple[int, int]]]:
    """A span with a few words around it, as a short text."""
    left = [*text[max(0, start - 200):start].split()[-int(rng.integers(1, 8)):], ""]
    right = ["", *text[end:end + 200].split()[:int(rng.integers(0, 8))]]
    first = " ".join(left)
    return first + text[start:end] + " ".join(right), [(len(first), len(first) + end - start)] if secret else []


def learnt_from(text: str, params: Params, rng: np.random.Generator) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """A text with its spans: as it is, and with made secrets or decoys."""
    base = [(a, b) for kind, a, b in base_spans(text) if kind in params.kinds]
    yield text, base
    for _ in range(params.swaps if base and params.forms else 0):
        parts, spans, done, length = [], [], 0, 0
        for a, b in base:
            if a < done:
                continue
            form = params.forms[rng.integers(len(params.forms))]
            own = made(form, rng)
            if rng.random() < 0.3:
                own = f"{KEYWORDS[rng.integers(len(KEYWORDS))]} = {own}"
            elif rng.random() < 0.3:
                own = f"{made(DECOYS[rng.integers(len(DECOYS))], rng)} {own}"
            parts += [text[done:a], own]
            length += a - done + len(own)
            spans.append((length - len(own.rsplit(" ", 1)[-1]) if " = " not in own else length - len(own), length))
            done = b
        copy = "".join(parts) + text[done:]
        yield copy, spans
        yield snippet(copy, *spans[rng.integers(len(spans))], rng, True)
    if not base:
        at, decoy = int(rng.integers(len(text) + 1)), made(DECOYS[rng.integers(len(DECOYS))], rng)
        more = f"{text[:at]} {decoy} {text[at:]}"
        if not base_spans(more):
            yield more, []
            yield snippet(more, at + 1, at + 1 + len(decoy), rng, False)


def batches_of(length: np.ndarray, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """All chains in a random order, in batches of chains of like length."""
    order = rng.permutation(len(length))
    lots = [order[k:k + 50 * size] for k in range(0, len(order), 50 * size)]
    out = [lot[np.argsort(length[lot], kind="stable")][k:k + size] for lot in lots for k in range(0, len(lot), size)]
    return [out[i] for i in rng.permutation(len(out))]


def train(params: Params, texts: list[str]) -> Model:
    """Chains are cut to the neighbourhood of what is not plain; the plain
    tokens at its rim and a few other plain stretches stand for the rest."""
    rng = np.random.default_rng(params.seed)
    s = len(SHAPES)
    model = Model(*(np.zeros((n, 3)) for n in (s, s, s, WORD_BUCKETS, WORD_BUCKETS, 4)), np.zeros((3, 3)))
    known, chains = Tokens(), []
    for text, spans in (x for t in texts for x in learnt_from(t, params, rng)):
        found = list(TOKEN.finditer(text))
        if not found:
            continue
        shapes, words, step = columns([m[0] for m in found], known)
        tags = np.zeros(len(found), np.int64)
        starts, ends = np.array([m.start() for m in found]), np.array([m.end() for m in found])
        for a, b in spans:
            inside = np.flatnonzero((starts < b) & (ends > a))
            fresh = inside[tags[inside] == OUT]
            tags[fresh] = INSIDE
            if len(fresh) and (fresh[0] == 0 or tags[fresh[0] - 1] == OUT):
                tags[fresh[0]] = BEGIN
        odd = np.flatnonzero(shapes[1:-1])
        if len(odd) > params.odd_tokens:  # of a text full of marks, all its secrets and some of the rest
            odd = np.unique(np.concatenate([np.flatnonzero(tags), rng.choice(odd, params.odd_tokens, replace=False)]))
        near = np.zeros(len(found), bool)
        for k in [*odd.tolist(), *rng.integers(0, len(found), 2).tolist()]:
            near[max(0, k - params.reach):k + params.reach + 1] = True
        at = np.flatnonzero(near)
        for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            a, b = int(run[0]), int(run[-1]) + 1
            chains.append((shapes[a:b + 2], words[a:b + 2], step, tags[a:b]))
    parts = ("own", "before", "after", "word_before", "word_after", "file", "moves")
    seen = {p: np.full_like(getattr(model, p), 1e-2) for p in parts}
    secret = [c for c in chains if c[3].any()]
    rest = [c for c in chains if not c[3].any()]
    rest = [rest[i] for i in rng.permutation(len(rest))[:params.rest * len(secret) + params.rest_least]]
    both = secret + rest
    length = np.array([len(c[3]) for c in both], np.int64)
    for epoch in range(params.epochs):
        for some in batches_of(length, params.batch, rng):
            n = length[some]
            held = np.arange(n.max())[:, None] < n
            chain, place = np.nonzero(held.T)
            here, before, after, word_before, word_after = (np.concatenate(c) for c in zip(*(
                (both[i][0][1:-1], both[i][0][:-2], both[i][0][2:], both[i][1][:-2], both[i][1][2:]) for i in some)))
            step, odd = np.repeat([both[i][2] for i in some], n), np.flatnonzero(here)
            u, tags = np.zeros((*held.shape, 3)), np.zeros(held.shape, np.int64)
            tags[place, chain] = np.concatenate([both[i][3] for i in some])
            flat = model.own[here] + model.before[before] + model.after[after] + model.file[step]
            flat[odd] += model.word_before[word_before[odd]] + model.word_after[word_after[odd]]
            u[place, chain] = flat
            du, dm = gradients(u, model.moves, tags, held)
            du = du[place, chain]
            for part, index, value in (("own", here, du), ("before", before, du), ("after", after, du), ("file", step, du),
                                       ("word_before", word_before[odd], du[odd]), ("word_after", word_after[odd], du[odd]), ("moves", None, dm)):
                weights = getattr(model, part)
                g = value if index is None else np.zeros_like(weights)
                if index is not None:
                    np.add.at(g, index, value)
                g = g - params.decay * len(some) * weights
                seen[part] += g * g
                weights += params.rate / math.sqrt(1 + epoch) * g / np.sqrt(seen[part])
    model.plain_is_out = stays_out(model.own[0] + model.before[0] + model.after[0] + model.file[0], model.moves)
    return model


def fit(docs: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """None if no sampled text has a token. One pass counts the rows with and
    without base spans; one draws both kinds, testing only the rows whose hash
    could be drawn."""
    params = params or Params()
    hit = F.col("t").rlike(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""") \
        | F.col("t").rlike("AKIA[A-Z0-9]{16}") | F.col("t").rlike("[0-9a-f]{24}")
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")) \
        .where(F.length("t").between(1, params.sample_chars))
    hits, every = rows.agg(F.count(F.when(hit, 1)), F.count("*")).first()
    share = [int(min(1.0, params.sample_rows / 2 / max(n, 1)) * (1 << 30)) for n in (hits, every - hits)]
    place = F.pmod(F.xxhash64("i", "t", F.lit(params.sample_rows)), F.lit(1 << 30))
    drawn = rows.where(place < max(share)).where(place < F.when(hit, share[0]).otherwise(share[1])).select("i", "t", hit.alias("hit"))
    found = drawn.limit(2 * params.sample_rows).collect()
    texts = [r["t"] for r in sorted(found, key=lambda r: (not r["hit"], r["t"], str(r["i"])))]
    return train(params, texts) if any(TOKEN.search(t) for t in texts) else None


def scans(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_assign, n_access, n_hex, base_sha256, spans, n_added`` per row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # some hundred weights
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = scan(text, shared.value, known)
                rows.append((*(sum(k == kind for k, _, _ in base) for kind in KINDS),
                             hashlib.sha256(written_out(base).encode()).hexdigest(), written_out(every), len(every) - len(base)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                ["row_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])

    return docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"row_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_added bigint") \
        .withColumnRenamed("row_id", id_col)


def redacted(docs: DataFrame, model: Model | None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (columns of documents) with every span of their texts replaced
    by ``mark``; overlapping spans become one. Null texts stay null."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                spans = scan(text, shared.value, known)[1] if text else []
                done, parts = 0, []
                for _, a, b in spans:
                    if a >= done:
                        parts += [text[done:a], mark]
                    done = max(done, b)
                texts.append("".join(parts) + text[done:] if spans else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.types[at]))

    return docs.mapInArrow(run, docs.schema)
