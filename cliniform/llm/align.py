"""Cross-tokenizer alignment: which tokens of two vocabularies end at the same bytes, and how often over the corpus.

A text is encoded by both tokenizers. Byte offsets where tokens of both end cut the tokens into groups; the
last tokens of a group are linked. Most groups hold one token of each side. Both then have the same bytes, so their
pair is told by the id of A alone: ``identity`` maps each id of A to the id of B with its bytes. Links of such
groups are counted in vectors as long as the vocabulary. Only links of other groups enter a shuffle of pairs,
counted per block of texts first.

A second pass tells each text how its links stand in the corpus. Texts stay in their blocks: a block asks for
each irregular pair once, so a pair that all texts hold comes up once per block, not once per text.

Defined cases: a text that is null or empty, or whose joined token bytes on either side differ from space + text (a
character that a tokenizer rewrites), has no tokens: zeros, and an empty string for the groups' digest. Repeated
rows get equal results and count again in the corpus; null ids are kept; an empty table gives no rows; other columns
keep their values, but for those that are named like an added one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .bpe import byte_alphabet
from .common import sliced, table

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of text, with 64 more per row, after which a block of texts is closed.
BLOCK = 4 << 20
#: Characters after which a text is cut for the second tokenizer, where a cut can't change its pieces.
CUT = 1 << 15


class Sides:
    """Both tokenizers: encoders, bytes of each id, and the identity map."""

    def __init__(self, path_a: str, path_b: str, pattern: str) -> None:
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        special = {t["content"] for t in spec["added_tokens"]}
        names = {n: i for n, i in model["vocab"].items() if n not in special}
        merged = [model["vocab"][m.replace(" ", "", 1) if isinstance(m, str) else "".join(m)] for m in model["merges"]]
        if merged != sorted(merged) or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path_a}: ids are not in the order of merges, or it is not a plain byte-level BPE")
        ranks = {bytes(alphabet[c] for c in n): i for n, i in names.items()}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.bytes_a = [b""] * (max(model["vocab"].values()) + 1)
        for raw, i in ranks.items():
            self.bytes_a[i] = raw
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # a piece goes before a byte token of the same bytes: that one stands only for what has no piece
        same = {raw: i for i, raw in reversed(list(enumerate(self.bytes_b))) if self.b.is_byte(i)}
        same |= {raw: i for i, raw in reversed(list(enumerate(self.bytes_b))) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([same.get(raw, -1) if raw else -1 for raw in self.bytes_a], np.int64)
        self.long_a, self.long_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        ids_a, ids_b = range(len(self.bytes_a)), range(size)
        # a pair's code: the id of A, then the bits of an id of B; links take four bytes each where both fit
        self.shift = max(1, (size - 1).bit_length())
        self.link_type = np.int32 if len(self.bytes_a) << self.shift < 1 << 31 else np.int64
        # no piece goes on behind a blank, so a text may be cut at a single blank: each part gets the blank back
        self.cut = re.compile("(?<=[^ ▁]) (?=[^ ▁])") if not any("▁" in p.lstrip("▁") for p in pieces) else None
        #: How an id is written: inside a side of a group, and at its end.
        self.written = pa.array([f"{i}," for i in ids_a] + [f"{i}|" for i in ids_a] + [f"{i}," for i in ids_b] + [f"{i};" for i in ids_b], pa.binary())

    def pieces(self, text: str) -> list[int]:
        """Ids of B, in parts: the library takes hundreds of bytes per character of what it is given at once."""
        out, start = [], 0
        while self.cut and len(text) - start > CUT and (at := self.cut.search(text, start + CUT)):
            out += self.b.encode(text[start:at.start()])
            start = at.end()
        return out + self.b.encode(text[start:])

    def aligned(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of both sides and the numbers of each group's last tokens; None where a side does not give the text back."""
        # half of a surrogate pair cannot come from UTF-8, so every text encodes
        raw = (" " + text).encode()
        a, b = np.array(self.a.encode_ordinary(" " + text), np.int64), np.array(self.pieces(text), np.int64)
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != raw or b"".join([self.bytes_b[i] for i in b.tolist()]) != raw:
            return None
        ends_a, ends_b = np.cumsum(self.long_a[a]), np.cumsum(self.long_b[b])
        mark = np.zeros(len(raw) + 1, bool)
        mark[ends_b] = True
        last_a = np.flatnonzero(mark[ends_a])
        return a, b, last_a, np.searchsorted(ends_b, ends_a[last_a])

    def groups_digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;...``, without writing them as Python strings."""
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[last_a] = ends_b[last_b] = True
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before_b = np.concatenate([[0], last_b + 1])
        after_a = last_a + 1
        order = np.empty(len(a) + len(b), np.int64)
        size_a, size_b = len(self.long_a), len(self.long_b)
        order[np.arange(len(a)) + before_b[group_a]] = a + size_a * ends_a
        order[np.arange(len(b)) + after_a[group_b]] = 2 * size_a + b + size_b * ends_b
        out = self.written.take(pa.array(order))
        return hashlib.sha256(memoryview(out.buffers()[2])[:pa.compute.sum(pa.compute.binary_length(out)).as_py() - 1]).hexdigest()


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str, pattern: str) -> Sides:
    """Both tokenizers, made once per worker."""
    return Sides(path_a, path_b, pattern)


FACTS = ["n_a", "n_b", "n_groups", "n_links"]
OUT = [*FACTS, "n_best", "count_sum", "groups_sha256"]


def links_of(df: DataFrame, text: str, paths: tuple[str, str, str], most: int = BLOCK) -> DataFrame:
    """Texts with their links (``kind`` 0), irregular pairs per block (1) and counts of identity links (2), staged."""
    added = {*OUT, "block", "links", "kind", "pairs", "counts"}
    kept = [c for c in df.columns if c.lower() not in added and c != text]
    fields = [f for f in df.schema if f.name in kept]
    longs, raw = [T.StructField(c, T.LongType()) for c in ("block", *FACTS)], [T.StructField(c, T.BinaryType()) for c in ("links", "pairs", "counts")]
    shape = T.StructType([T.StructField("kind", T.IntegerType()), *longs, T.StructField("groups_sha256", T.StringType()), *raw, *fields])
    own = [pa.int32(), *[pa.int64()] * 5, pa.string(), *[pa.binary()] * 3]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(*paths)
        block, size, regular = TaskContext.get().partitionId() << 32, 0, np.zeros(len(both.identity), np.int64)
        codes: list[np.ndarray] = []
        schema = None

        def extra(kind: int, block: int, pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            values = [kind, block, None, None, None, None, None, None, pairs.tobytes(), counts.tobytes()]
            return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(values, own)], *[pa.nulls(1, schema.field(n).type) for n in kept]], shape.names)

        for part in parts:
            for piece in sliced(part):
                schema = piece.schema
                rows = []
                for value in piece.column(piece.num_columns - 1):
                    one = value.as_py()
                    got = both.aligned(one) if one else None
                    size += 64 + len(one or "")
                    if got is None:
                        rows.append((0, block, 0, 0, 0, 0, "", b"", None, None))
                        continue
                    a, b, last_a, last_b = got
                    link = a[last_a] << both.shift | b[last_b]
                    straight = both.identity[a[last_a]] == b[last_b]
                    regular += np.bincount(a[last_a][straight], minlength=len(regular))
                    codes.append(link[~straight])
                    # an identity link is kept as the id of A alone
                    rows.append((0, block, len(a), len(b), len(last_a), len(link), both.groups_digest(*got), np.where(straight, -1 - a[last_a], link).astype(both.link_type).tobytes(), None, None))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(zip(*rows), own)], *piece.columns[:-1]], shape.names)
                if size >= most:
                    if codes:
                        yield extra(1, block, *np.unique(np.concatenate(codes), return_counts=True))
                    block, size, codes = block + 1, 0, []
        if codes:
            yield extra(1, block, *np.unique(np.concatenate(codes), return_counts=True))
        if regular.any():
            held = np.flatnonzero(regular)
            yield extra(2, block, held, regular[held])

    found = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_aligned_text")).mapInArrow(run, shape)
    return staged(found, "links", by="kind")


def unpacked(frame: DataFrame) -> DataFrame:
    """(block, code, n) of packed pairs, one row each."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in range(part.num_rows):
                codes, counts = (np.frombuffer(part.column(k)[n].as_buffer(), np.int64) for k in (1, 2))
                for at in range(0, len(codes), 1 << 16):
                    some = codes[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), part.column(0)[n].as_py())), pa.array(some), pa.array(counts[at:at + (1 << 16)])], ["block", "code", "n"])

    return frame.select("block", "pairs", "counts").mapInArrow(run, "block long, code long, n long")


def align(df: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None, pattern: str = public_tokenizers.PATTERN,
          block: int = BLOCK) -> DataFrame:
    """Append to every text its tokens, groups and links, and how its links count in the corpus (``OUT``).

    ``path_a`` is a byte-level BPE in JSON that gets space + text, ``path_b`` a sentencepiece model that adds the space itself.
    """
    paths = (path_a or public_tokenizers.path(A), path_b or public_tokenizers.path(B), pattern)
    found = links_of(df, text, paths, block)
    # at most one row per id of A, so the driver may hold them: both vectors go to the workers with the code
    both = sides(*paths)
    identity, mask, link_type = both.identity, (1 << both.shift) - 1, both.link_type
    counts = np.zeros(len(identity), np.int64)
    for row in unpacked(found.where("kind = 2")).groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[row.code] = row.n
    asked = unpacked(found.where("kind = 1"))
    pairs = asked.groupBy("code").agg(F.sum("n").alias("n"))
    tops = np.zeros(len(both.bytes_b), np.int64)
    np.maximum.at(tops, identity[counts > 0], counts[counts > 0])
    # at most one row per id of B
    for row in pairs.groupBy(F.col("code").bitwiseAND(mask).alias("b")).agg(F.max("n").alias("n")).collect():
        tops[row.b] = max(tops[row.b], row.n)
    told = asked.drop("n").join(pairs, "code").groupBy("block").agg(F.collect_list(F.struct("code", "n")).alias("pairs"))  # a block's pairs
    known = found.where("kind = 0").drop("kind", "pairs", "counts")
    kept = [f for f in known.schema if f.name not in ("block", "links", *OUT)]
    longs = [T.StructField(c, T.LongType()) for c in OUT[:-1]]
    shape = T.StructType([*kept, *longs, T.StructField("groups_sha256", T.StringType())])
    best = (identity >= 0) & (counts > 0) & (counts == tops[identity])

    def judge(texts: pa.Table, stats: pa.Table) -> pa.Table:
        if stats.num_rows:
            pair = stats.column("pairs").combine_chunks().values
            code, n = (pair.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            order = np.argsort(code)
            code, n = code[order], n[order]
        else:
            code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = n == tops[code & mask]
        sums, bests = [], []
        for links in texts.column("links"):
            link = np.frombuffer(links.as_buffer(), link_type)
            straight = -1 - link[link < 0]
            at = np.searchsorted(code, link[link >= 0])
            sums.append(int(counts[straight].sum() + n[at].sum()))
            bests.append(int(best[straight].sum() + top[at].sum()))
        return pa.table([*[texts.column(f.name) for f in kept], *[texts.column(c) for c in FACTS], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                         texts.column("groups_sha256")], names=shape.names)

    return known.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(judge, shape)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers, and the links' standing in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align(docs)
