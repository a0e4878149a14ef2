"""Byte-level BPE: exact merges in linear time, and exact token counts at every prefix.

A vocabulary is a list of byte strings in merge order. Two facts carry both methods:

* The tokens of a text are the unique sequence in which every pair of neighbours is *compatible*, that
  is, encoding their joined bytes gives back the same two tokens. Compatibility is tested by undoing
  the two tokens' last merges across their seam, and is memoised.
* Every token that occurs at a place is found by one pass of an Aho-Corasick automaton over the
  bytes, read as Latin-1 text.

``Vocabulary.encode`` walks from left to right with the longest match, steps to the next shorter prefix
when a match is incompatible with its left neighbour, and backs up when none is left; a place found
dead is never entered again. ``Vocabulary.prefix_counts`` keeps, for each prefix, the last token of
its encoding and the number of tokens.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import ahocorasick
import regex

#: Entries a memo may hold before it is emptied; bounds a worker's memory, not the result.
MEMO = 300_000


class Vocabulary:
    """Merge tables of one byte-level vocabulary; ``tokens[i]`` has rank ``i``.

    ``ids`` gives the id of each rank where it differs from the rank. ``splits`` gives, for a token
    of several bytes, the ranks of the pair it is merged from; without it the pairs are derived.
    """

    def __init__(self, tokens: Sequence[bytes], ids: Sequence[int] | None = None,
                 splits: Sequence[tuple[int, int]] | None = None) -> None:
        self.tokens = list(tokens)
        self.ids = list(ids) if ids is not None else list(range(len(self.tokens)))
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.length = [len(t) for t in self.tokens]
        self.back = [n - 1 for n in self.length]
        self.split = list(splits) if splits is not None else self._derive()
        self.pair = {p: i for i, p in enumerate(self.split) if p != (i, i)}
        self.shorter = [self._prefix(t) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self._fits: dict[int, bool] = {}

    def _derive(self) -> list[tuple[int, int]]:
        """The pair each token is made from: merge its bytes with lower ranks until two parts remain."""
        out = []
        for i, token in enumerate(self.tokens):
            parts = [bytes([b]) for b in token]
            while len(parts) > 2:
                ranked = [(self.rank.get(parts[k] + parts[k + 1], i), k) for k in range(len(parts) - 1)]
                best, k = min(ranked)
                if best >= i:
                    break
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            out.append((self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else (i, i))
        return out

    def _prefix(self, token: bytes) -> int:
        """Longest proper prefix that is a token; -1 if none."""
        for n in range(len(token) - 1, 0, -1):
            if (r := self.rank.get(token[:n])) is not None:
                return r
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` stays two tokens."""
        key = left << 20 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= MEMO // 2:
                self._fits.clear()
            known = self._fits[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        # Undo merges next to the seam, latest first. A merge across the seam that ranks before the
        # merge just undone would have happened earlier, so the two tokens could not have formed.
        bound = len(self.tokens)
        while True:
            across = self.pair.get((left, right))
            if across is not None and across < bound:
                return False
            undo_left = self.split[left] != (left, left) and (self.split[right] == (right, right) or left > right)
            if undo_left:
                bound, left = left, self.split[left][1]
            elif self.split[right] != (right, right):
                # the right token's own merge starts at the seam: an equal rank across it comes first
                bound, right = right + 1, self.split[right][0]
            else:
                return True

    def _longest(self, text: str) -> list[int]:
        """Longest token that starts at each byte."""
        best, back = [-1] * len(text), self.back
        for end, token in self.automaton.iter(text):  # ends ascend, so the last for a start is the longest
            best[end - back[token]] = token
        return best

    def encode(self, piece: bytes) -> list[int]:
        """Ranks of a piece's tokens."""
        known = self.rank.get(piece)
        if known is not None:
            return [known]
        if not piece:
            return []
        longest, length, shorter, fits, size = self._longest(piece.decode("latin-1")), self.length, self.shorter, self._fits, len(piece)
        dead: set[int] = set()
        out, at, left = [], 0, -1
        token = longest[0]
        while at < size:
            while token >= 0:
                if at + length[token] not in dead:
                    if left < 0:
                        break
                    known = fits.get(left << 20 | token)
                    if self.compatible(left, token) if known is None else known:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                left = token
                if at < size:
                    token = longest[at]
            else:
                dead.add(at)  # nothing can follow here
                token = out.pop()
                at -= length[token]
                left = out[-1] if out else -1
                token = shorter[token]
        return out

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Token count of every prefix of a piece; entry ``n`` is for its first ``n`` bytes."""
        size = len(piece)
        counts, last, length, split = [0] * (size + 1), [-1] * (size + 1), self.length, self.split
        filled = 0
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start == 0 or (last[start] >= 0 and self.compatible(last[start], token)):
                # a token that BPE itself would not build from its bytes never ends a prefix
                if length[token] == 1 or split[token] != (token, token):
                    last[end], counts[end] = token, counts[start] + 1
                    filled = end
        if filled != size:
            raise ValueError("the vocabulary lacks single bytes")
        return counts

    def decode(self, ranks: Iterable[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[r] for r in ranks])


class Memo(dict):
    """Two generations of entries: when the young one is full it becomes the old one, so what recurs
    stays and memory is bounded by twice ``size``."""

    def __init__(self, make: Callable[[str], object], size: int = MEMO) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


def latin_pattern(pattern: str) -> str:
    """The pattern for the standard library, equal on texts without a character that ``BEYOND`` finds."""
    return pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")


#: Where classes of letters, digits and blanks may differ between the two regex modules.
BEYOND = re.compile(r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


class Encoder:
    """Splits texts into pieces, and encodes and counts them through a bounded memo of pieces.

    ``special`` maps strings that are one token of their own wherever they stand.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, special: dict[str, int] | None = None) -> None:
        self.vocabulary = vocabulary
        self._any = regex.compile(pattern).findall
        plain = latin_pattern(pattern)
        self._latin = re.compile(plain).findall if r"\p" not in plain else self._any
        self.special = special or {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.named = {i: s.encode() for s, i in self.special.items()}
        self.rank_of = {i: r for r, i in enumerate(vocabulary.ids)}
        self._ids = Memo(self._piece_ids)
        self._counts = Memo(lambda piece: vocabulary.prefix_counts(piece.encode())[-1])

    def _piece_ids(self, piece: str) -> list[int]:
        ranks, ids = self.vocabulary.encode(piece.encode()), self.vocabulary.ids
        return [ids[r] for r in ranks]

    def pieces(self, text: str) -> list[str]:
        return self._any(text) if BEYOND.search(text) else self._latin(text)

    def _segments(self, text: str) -> list[str]:
        return [text] if self.cut is None else [s for s in self.cut.split(text) if s]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        out: list[int] = []
        memo = self._ids
        for segment in self._segments(text):
            if segment in self.special:
                out.append(self.special[segment])
                continue
            for piece in self.pieces(segment):
                out += memo[piece]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of a list of ids."""
        if not self.special and self.rank_of.get(0) == 0 and self.vocabulary.ids[-1] == len(self.vocabulary.ids) - 1:
            return self.vocabulary.decode(ids)
        tokens, rank, named = self.vocabulary.tokens, self.rank_of, self.named
        return b"".join([named[i] if i in named else tokens[rank[i]] for i in ids])

    def table(self, text: str) -> PrefixTable:
        """Counts at the end of every piece of a text."""
        ends, counts, at, total, memo = [0], [0], 0, 0, self._counts
        for segment in self._segments(text):
            special = segment in self.special
            for piece in [segment] if special else self.pieces(segment):
                at += len(piece)
                total += 1 if special else memo[piece]
                ends.append(at)
                counts.append(total)
        return PrefixTable(self, text, ends, counts)


class PrefixTable:
    """Exact token counts of a text's prefixes.

    ``ends`` and ``counts`` hold every piece boundary; inside a piece the piece's own prefix counts are
    added, so no question runs the text through the encoder again.
    """

    def __init__(self, encoder: Encoder, text: str, ends: list[int], counts: list[int]) -> None:
        self.encoder, self.text, self.ends, self.counts = encoder, text, ends, counts

    @property
    def total(self) -> int:
        return self.counts[-1]

    def within(self, k: int) -> list[int]:
        """Counts after each character of piece ``k``, from its start on."""
        piece = self.text[self.ends[k]:self.ends[k + 1]]
        if piece in self.encoder.special:
            return [self.counts[k]] * len(piece) + [self.counts[k + 1]]
        by_byte = self.encoder.vocabulary.prefix_counts(piece.encode())
        out, at = [self.counts[k]], 0
        for c in piece:
            at += len(c.encode())
            out.append(self.counts[k] + by_byte[at])
        return out

    def fit(self, budget: int) -> int:
        """Length in characters of the longest cut at a piece's character whose tokens stay within a
        budget, each piece counted as it stands in the whole text."""
        if budget < 0:
            return 0
        k = bisect_right(self.counts, budget) - 1
        if k == len(self.ends) - 1:
            return self.ends[k]
        if self.text[self.ends[k]:self.ends[k + 1]] in self.encoder.special:
            return self.ends[k]
        inside = self.within(k)
        return self.ends[k] + max(n for n, c in enumerate(inside) if c <= budget)


#: How byte-level vocabularies write bytes as printable characters in JSON (fixed rule of the format):
#: printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
def byte_alphabet() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 and rank per line), in rank order."""
    with open(path, "rb") as lines:
        ranked = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]
    ranked.sort()
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"{path}: ranks are not 0, 1, 2, ...")
    return [t for _, t in ranked]


@lru_cache(maxsize=4)
def rank_tokens(path: str) -> list[bytes]:
    """Tokens of a rank file, read once per worker; all that decoding needs."""
    return read_ranks(path)


@lru_cache(maxsize=4)
def ranks_encoder(path: str, pattern: str) -> Encoder:
    """Encoder of a rank file, made once per worker."""
    return Encoder(Vocabulary(rank_tokens(path)), pattern)


@lru_cache(maxsize=4)
def json_encoder(path: str, pattern: str) -> Encoder:
    """Encoder of a byte-level BPE file in JSON: rank is the place in its list of merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, alphabet = spec["model"], byte_alphabet()
    if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path}: not a plain byte-level BPE")

    def raw(text: str) -> bytes:
        return bytes(alphabet[c] for c in text)

    singles = [c for c in model["vocab"] if len(c) == 1]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    names = singles + [a + b for a, b in merges]
    place = {n: i for i, n in enumerate(names)}
    splits = [(i, i) for i in range(len(singles))] + [(place[a], place[b]) for a, b in merges]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return Encoder(Vocabulary([raw(n) for n in names], [model["vocab"][n] for n in names], splits), pattern, special)
