"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens.

Patterns find the base spans. The field tags every token of a text as begin, inside or outside of a
secret; it learns from a bounded sample of texts whose tokens are tagged by the base spans, from the
same texts with other values in their place and the key words before them masked, and from texts without a
base span, every second one also with an invented value put into it, so that shape and neighbours carry
the tag where no pattern matches. The best path is the verdict: each of its runs is added as a span of
kind ``crf``, unless it lies within base spans (a run that reaches beyond them is added whole).

Decoding is exact: tokens whose outside score leads by more than any transitions can make good are
outside on every best path, so Viterbi runs on the stretches between such tokens only.

Defined cases: a null text counts as empty and has no spans; texts without a token are skipped; a corpus
without any base span is judged by invented values alone, one without texts of ``LEAST_PLANTED`` tokens gives a
field that tags nothing; repeated rows give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .bpe import Memo
from .common import appended, table

#: Base patterns (fixed values) in the order of their kinds, each with the group that has a least length.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so asking for the length finds the same matches
KINDS = ("assign", "access", "hex", "crf")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Most texts of either sort that the field is fitted to, characters of such a text, and tokens on either side of
#: a span (documented bounds of the fit; every whole text is scanned).
TRAIN_TEXTS = 1500
TRAIN_LENGTH = 20_000
CONTEXT = 12
#: Least tokens of a text that a value is put into for the fit.
LEAST_PLANTED = 8
SEED = 3
#: Hashed features, states: outside, begin, inside.
FEATURES = 1 << 14
STATES = 3
EPOCHS = 40
#: Weight of a transition that cannot be: from outside to inside.
ILLEGAL = -50.0
#: Tokens a worker keeps the class of.
MEMO = 30_000

_TOKENS = re.compile(r"[A-Za-z0-9+/_\-]+|[^\W\d_]+|[^\w\s]|\w")
_KEY = re.compile(r"pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|key|credentials?|auth(?:orization)?|bearer|private|access", re.I | re.A)

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base matches, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- features -------------------------------------------------------------------------------------

def _hashed(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "big") % FEATURES


def plain(token: str) -> str:
    """What stands for a token: a word of letters that is no key word by its length and case alone, a mark
    or a token with digits by itself."""
    if len(token) < 2 or not token.isalpha() or (len(token) <= 13 and _KEY.fullmatch(token)):
        return token
    n = min(len(token), 64)
    return "w" * n if token.islower() else "W" * n if token.isupper() else "W" + "w" * (n - 1) if token[1:].islower() else "wW" * (n // 2)


def shape(token: str) -> str:
    """Classes of characters in order, runs as one: ``aB3`` gives ``aA0``."""
    out = []
    for c in token[:64]:  # of a long token the rest is judged by its measures below
        s = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c if c in "+/_-=:\"'" else "x" if c.isalpha() else "."
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out[:12])


def measures(token: str) -> tuple[str, ...]:
    """Length, mix and evenness of a token, in steps."""
    n = len(token)
    digits, upper = sum(c.isdigit() for c in token), sum(c.isupper() for c in token)
    counts = np.unique(list(token), return_counts=True)[1] / n
    bits = float(-(counts * np.log2(counts)).sum())
    switches = sum(a.isalpha() != b.isalpha() for a, b in zip(token, token[1:], strict=False))
    return (f"n{min(int(math.log2(n) * 2), 14)}", f"d{int(4 * digits / n)}", f"u{int(4 * upper / n)}", f"e{int(bits)}", f"s{min(switches, 8) // 2}",
            f"n{min(int(math.log2(n) * 2), 14)}d{int(4 * digits / n)}s{min(switches, 8) // 2}")


def token_features(token: str) -> tuple[list[int], list[int]]:
    """Features of a token by itself, and those it lends to its neighbours."""
    key = _KEY.fullmatch(token)
    own = [_hashed(f"own {x}") for x in (*measures(token), "shape " + shape(token), *(["key"] if key else []), *([f"mark {token}"] if len(token) == 1 else []))]
    lent = ["key"] if key else [f"mark {token}"] if len(token) == 1 and not token.isalnum() else ["shape " + shape(token) if len(token) > 8 and not token.isalpha() else "word"]
    return own, [_hashed(f"near {x}") for x in lent]


def text_features(text: str) -> list[int]:
    """Features of the whole text: its length, and how much of it looks like settings or code."""
    marks = sum(text.count(c) for c in "={}\"")
    return [_hashed(f"text length {min(int(math.log10(len(text) + 1)), 6)}"), _hashed(f"text marks {min(int(100 * marks / (len(text) + 1)), 5)}")]


@dataclass
class Field:
    """Weights of the field: ``unary`` by feature and state for a token itself, ``before`` and ``behind`` for what its
    neighbours lend, ``whole`` for the text, ``move`` between states."""

    unary: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    whole: np.ndarray
    move: np.ndarray

    def __post_init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        """Forget the tokens met so far: their classes, and the scores a class gives to itself and its neighbours."""
        self._class: dict[str, int] = {}
        self._of = Memo(self._known, MEMO)
        self._scores = np.zeros((1024, 3, STATES), np.float32)

    def __getstate__(self) -> dict:
        return {n: getattr(self, n) for n in ("unary", "before", "behind", "whole", "move")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.reset()

    def _known(self, token: str) -> int:
        token = plain(token)
        number = self._class.get(token)
        if number is None:
            number = self._class[token] = len(self._class)
            if number == len(self._scores):
                self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
            own, lent = token_features(token)
            self._scores[number] = self.unary[own].sum(0), self.before[lent].sum(0), self.behind[lent].sum(0)
        return number

    def emissions(self, tokens: list[str], text: str) -> np.ndarray:
        if len(self._class) > MEMO:
            self.reset()
        of = np.fromiter(map(self._of.__getitem__, tokens), np.int64, len(tokens))
        own, before, behind = self._scores[:, 0], self._scores[:, 1], self._scores[:, 2]
        out = own[of] + self.whole[text_features(text)].sum(0).astype(np.float32)
        out[1:] += before[of[:-1]]
        out[:-1] += behind[of[1:]]
        return out

    def tags(self, emissions: np.ndarray) -> np.ndarray:
        """States of the best path."""
        out = np.zeros(len(emissions), np.int8)
        legal = self.move[self.move > ILLEGAL / 2]
        spread = float(legal.max() - legal.min())
        cold = 2.1 * spread + 0.5  # a cold token gives up more than its two transitions can bring
        hot = np.flatnonzero(emissions[:, 1:].max(1) - emissions[:, 0] > -cold)
        if not len(hot):
            return out
        # A secret never ends on a cold token, and never lies on cold tokens only. It runs over cold ones up to a hot
        # one only while that saves more, by being inside instead of begin there, than they cost.
        saved = max(0.0, float((emissions[hot, 2] - emissions[hot, 1]).max()))
        reach = int((saved + spread) / (cold - spread)) + 1
        edges = np.zeros(len(emissions) + 1, np.int64)
        np.add.at(edges, np.maximum(hot - reach, 0), 1)
        np.add.at(edges, hot + 1, -1)
        free = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        cuts = np.flatnonzero(np.diff(free) > 1)
        for first, last in zip(np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(free) - 1]]), strict=True):
            low, high = free[first], free[last] + 1
            out[low:high] = viterbi(emissions[low:high], self.move, high < len(emissions))
        return out


def viterbi(scores: np.ndarray, move: np.ndarray, to_outside: bool) -> np.ndarray:
    """Best path through a stretch between outside tokens; the start of a text counts as outside, its end as open."""
    best = scores[0] + move[0]
    back = np.zeros((len(scores), STATES), np.int8)
    for t in range(1, len(scores)):
        reach = best[:, None] + move
        back[t] = reach.argmax(0)
        best = reach.max(0) + scores[t]
    if to_outside:
        best = best + move[:, 0]
    path = np.zeros(len(scores), np.int8)
    path[-1] = best.argmax()
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


# ---- fitting --------------------------------------------------------------------------------------

def windows(text: str, rng: np.random.Generator) -> list[tuple[list[str], list[int], str]]:
    """Token windows of a text with their tags: around each group of base spans, or one anywhere."""
    found = list(_TOKENS.finditer(text))
    if not found:
        return []
    tokens, tags = [m[0] for m in found], [0] * len(found)
    starts = np.array([m.start() for m in found])
    spans = []
    for a, k, b in base_spans(text):
        if k == 0:  # the secret of an assignment is its value
            a = ASSIGN.match(text, a).start(2)
        low, high = int(np.searchsorted(starts, a)), int(np.searchsorted(starts, b))
        if low < high and not any(tags[low:high]):
            tags[low:high] = [1] + [2] * (high - low - 1)
            spans.append((low, high))
    out = []
    if not spans:
        at = int(rng.integers(0, len(tokens)))
        spans = [(at, at)]
        if len(tokens) >= LEAST_PLANTED and rng.random() < 0.5:
            value, marks = planted(rng)
            a, b = max(0, at - CONTEXT), min(len(tokens), at + CONTEXT)
            out.append((tokens[a:at] + value + tokens[at:b], [0] * (at - a) + marks + [0] * (b - at), text))
    for low, high in spans[:8]:
        a, b = max(0, low - CONTEXT), min(len(tokens), high + CONTEXT, low + 4 * CONTEXT)
        out.append((tokens[a:b], tags[a:b], text))
        if high > low:  # another value in its place, and no key word: neighbours or shape alone have to do
            out.append((tokens[a:low] + [invented(rng)] + tokens[high:b], tags[a:low] + [1] + tags[high:b], text))
            value = [invented(rng)] if rng.random() < 0.5 else tokens[low:high]
            left = ["the" if _KEY.fullmatch(t) or t in "=:" else t for t in tokens[a:low]]
            out.append((left + value + tokens[high:b], tags[a:low] + [1] + [2] * (len(value) - 1) + tags[high:b], text))
    return out


def invented(rng: np.random.Generator) -> str:
    """A random value as keys and tokens have them, sometimes with a short prefix."""
    letters = ("0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_")
    chosen = letters[int(rng.integers(0, len(letters)))]
    prefix = "".join("".join(rng.choice(list("abcdefghijklmnoprstvx"), int(rng.integers(2, 6)))) + "_-"[int(rng.random() < 0.3)]
                     for _ in range(int(rng.integers(1, 3)))) if rng.random() < 0.3 else ""
    return prefix + "".join(rng.choice(list(chosen), int(rng.integers(16, 49))))


def planted(rng: np.random.Generator) -> tuple[list[str], list[int]]:
    """Tokens and tags of an invented value, now and then of several parts, with or without marks around it."""
    value = [invented(rng)]
    while rng.random() < 0.2 and len(value) < 7:
        value += [".:="[int(rng.integers(0, 3))], invented(rng)]
    before, behind = [([], []), ([":"], []), (["="], []), (['"'], ['"']), (["("], [")"]), ([], ["."]), ([], [","])][int(rng.integers(0, 7))]
    return [*before, *value, *behind], [0] * len(before) + [1] + [2] * (len(value) - 1) + [0] * len(behind)


def fitted(texts: list[str]) -> Field:
    """Maximise the conditional likelihood of the windows' tags by Adagrad over padded batches."""
    rng = np.random.default_rng(SEED)
    rows = [w for t in texts for w in windows(t, rng)]
    field = Field(*[np.zeros((FEATURES, STATES)) for _ in range(4)], np.zeros((STATES, STATES)))
    if not any(any(tags) for _, tags, _ in rows):
        field.move[0] = (0, ILLEGAL, ILLEGAL)
        return field
    memo = Memo(lambda token: token_features(plain(token)), 200_000)
    most = max(len(t) for t, _, _ in rows)
    pad = FEATURES  # weight of no feature

    own = np.full((len(rows), most, 10), pad)
    near = np.full((len(rows), most, 2), pad)  # lent from the token before, from the one behind
    whole = np.array([text_features(t) for _, _, t in rows])
    tags, live = np.zeros((len(rows), most), np.int64), np.zeros((len(rows), most))
    for r, (tokens, marks, _) in enumerate(rows):
        feats = [memo[t] for t in tokens]
        for t, (mine, _) in enumerate(feats):
            own[r, t, :len(mine)] = mine
        near[r, 1:len(tokens), 0] = [f[1][0] for f in feats[:-1]]
        near[r, :len(tokens) - 1, 1] = [f[1][0] for f in feats[1:]]
        tags[r, :len(tokens)], live[r, :len(tokens)] = marks, 1
    weights = {n: np.zeros((FEATURES + 1, STATES)) for n in ("unary", "before", "behind", "whole")}
    move = np.zeros((STATES, STATES))
    squares = {n: np.full_like(w, 1e-6) for n, w in weights.items()} | {"move": np.full_like(move, 1e-6)}
    legal = np.zeros((STATES, STATES))
    legal[0, 2] = ILLEGAL  # inside never follows outside
    eye = np.eye(STATES)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            b = order[at:at + 256]
            e = weights["unary"][own[b]].sum(2) + weights["before"][near[b, :, 0]] + weights["behind"][near[b, :, 1]] + weights["whole"][whole[b]].sum(1)[:, None]
            moves = move + legal
            node, edge = marginals(e, moves, live[b])
            gap = (eye[tags[b]] - node) * live[b][..., None]
            pairs = live[b][:, 1:] * live[b][:, :-1]
            truth = np.einsum("rti,rtj,rt->ij", eye[tags[b][:, :-1]], eye[tags[b][:, 1:]], pairs)
            first = eye[tags[b][:, 0]].sum(0) - node[:, 0].sum(0)
            slopes = {n: np.zeros_like(w) for n, w in weights.items()}
            for k in range(own.shape[2]):
                np.add.at(slopes["unary"], own[b][:, :, k], gap)
            np.add.at(slopes["before"], near[b][:, :, 0], gap)
            np.add.at(slopes["behind"], near[b][:, :, 1], gap)
            for k in range(whole.shape[1]):
                np.add.at(slopes["whole"], whole[b][:, k], gap.sum(1))
            slopes["move"] = truth - edge
            slopes["move"][0] += first
            for n, g in slopes.items():
                w = move if n == "move" else weights[n]
                g = g / len(b) - 1e-4 * w
                squares[n] += g * g
                w += 0.3 * g / np.sqrt(squares[n])
                if n != "move":
                    w[pad] = 0
    return Field(*[weights[n][:FEATURES] for n in ("unary", "before", "behind", "whole")], move + legal)


def marginals(e: np.ndarray, move: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of states per token, and expected transitions of a batch of padded windows."""
    rows, most, _ = e.shape
    forward, backward = np.zeros_like(e), np.zeros_like(e)
    forward[:, 0] = e[:, 0] + move[0]
    for t in range(1, most):
        step = _logsum(forward[:, t - 1, :, None] + move[None], 1) + e[:, t]
        forward[:, t] = np.where(live[:, t, None] > 0, step, forward[:, t - 1])
    for t in range(most - 2, -1, -1):
        step = _logsum(move[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(live[:, t + 1, None] > 0, step, backward[:, t + 1])
    total = _logsum(forward[:, -1], 1)
    node = np.exp(forward + backward - total[:, None, None])
    pairs = forward[:, :-1, :, None] + move + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    edge = (np.exp(np.minimum(pairs, 0)) * (live[:, 1:] * live[:, :-1])[..., None, None]).sum((0, 1))
    return node, edge


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


# ---- scanning -------------------------------------------------------------------------------------

def covered(a: int, b: int, base: list[Span]) -> bool:
    """Whether the base spans, which are in order of their starts, hold all of a run."""
    for x, _, y in base:
        if x > a:
            break
        a = max(a, y)
    return a >= b


def spans_of(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of a whole text."""
    base = base_spans(text)
    tokens = _TOKENS.findall(text)
    if not tokens:
        return base, base
    tags = field.tags(field.emissions(tokens, text))
    if not tags.any():
        return base, base
    places = [(m.start(), m.end()) for m in _TOKENS.finditer(text)]
    added, t = [], 0
    while t < len(tags):
        if tags[t] == 0:
            t += 1
            continue
        end = t + 1
        while end < len(tags) and tags[end] == 2:
            end += 1
        a, b = places[t][0], places[end - 1][1]
        if not covered(a, b, base):
            added.append((a, 3, b))
        t = end
    return base, sorted(base + added)


def trained(docs: DataFrame, text: str = "text", most: int = TRAIN_TEXTS, longest: int = TRAIN_LENGTH) -> Field:
    """Fit the field to at most ``most`` texts with a base span and as many without, of at most ``longest``
    characters, chosen by hash.

    The patterns run once over the texts, whose hashes are written with what they found; the texts of the chosen hashes
    (at most twice ``most``, so they are broadcast) are then read in a second scan that only hashes.
    """
    body = F.col(f"`{text}`")
    hit = F.coalesce(body.rlike(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"), F.lit(False))
    rows = docs.where(F.length(body).between(1, longest)).select(body.alias("t"), F.xxhash64(body, F.lit(SEED)).alias("h"))
    found = docs.where(F.length(body).between(1, longest)).select(F.xxhash64(body, F.lit(SEED)).alias("h"), hit.alias("hit"))
    marked = staged(found.distinct(), "marked")
    sides = [marked.where(F.col("hit") == side).orderBy("h").limit(most) for side in (True, False)]
    chosen = sides[0].unionByName(sides[1])
    got = rows.join(F.broadcast(chosen), "h").groupBy("hit", "h").agg(F.min("t").alias("t")).collect()
    return fitted([r.t for r in sorted(got, key=lambda r: (not r.hit, r.h))])


def scanned(docs: DataFrame, field: Field, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """Append all spans of every whole text: an array of (start, end, kind), by start, then kind."""
    entry = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])

    def compute(texts: pa.Array) -> pa.Array:
        rows = [[{"start": a, "end": b, "kind": KINDS[k]} for a, k, b in spans_of(t or "", field)[1]] for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])))

    return appended(docs, text, compute, T.StructType([T.StructField(out, T.ArrayType(entry))]))


def redacted(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with every span of every text replaced by ``mask``; overlapping spans by one."""
    field = trained(docs, text)

    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _masked(t, spans_of(t, field)[1], mask) for t in texts.to_pylist()], pa.string())

    return appended(docs, text, compute, T.StructType([T.StructField(text, T.StringType())])).select([f"`{c}`" for c in docs.columns])


def _masked(text: str, spans: list[Span], mask: str) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scanned(docs, trained(docs)).select("doc_id", "secret_spans")

    def name(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def number(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secret_spans", lambda s: s["kind"] != KINDS[3])
    return found.select("doc_id", *[number(k) for k in KINDS[:3]], F.sha2(F.array_join(F.transform(base, name), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("secret_spans", name), ",").alias("spans"), number(KINDS[3]))
