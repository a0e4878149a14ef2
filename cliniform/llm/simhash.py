"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are reduced to distinct ones. Two that differ in at most ``d`` bits agree in one of ``d + 1``
blocks of bits, so each is filed under every block's value, and groups whose members share a value
hold all links. A group that is still large is filed again by blocks of its free bits, so a hot group
is split for as long as bits are free; after ``len(LEVELS)`` levels at most ``2 ** FREE`` fingerprints can share
all fixed bits, which bounds every group whatever the data.

A group is searched in its task: its members are sorted by Gray rank, so neighbours share long bit patterns;
a node of the index covers a run of members and stores the mask of bits on which all of them agree and
their values, upper nodes the runs of runs. Two nodes whose shared masks differ in more than ``d`` bits are
dropped with all pairs below them; two nodes whose members are of one class already are too. Each group returns one
row per member that names its local class, never the pairs.

The classes of all groups form a sparse graph whose components are found by rounds of star
contraction over checkpointed tables.

Defined cases: a null, empty or blank text has fingerprint zero, which links like any other; a row without
an id takes its component from the others (null if the component has no id); repeated rows are in one component; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .common import appended, free_name, table

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Members from which on a group is filed again.
GROUP = 512
#: Widths of the blocks by level, widest first, for 4 blocks; what is left free after the last level.
LEVELS = ((16, 16, 16, 16), (12, 12, 12, 12), (9, 9, 9, 9), (7, 7, 7, 6))
FREE = 64 - 16 - 12 - 9 - 6
#: Members of a leaf of the index, and children of an upper node.
LEAF = 16
FAN = 4
#: Pairs of nodes compared at a time.
PAIRS = 1 << 12
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text in UTF-8, repeats included; words are separated by ASCII blanks."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII blanks separate
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    low, high = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(low[at:at + STEP], high[at:at + STEP], strict=True)], np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint_bits", shingle: int = SHINGLE) -> DataFrame:
    """Append the fingerprint of every whole text as a (signed) long."""
    def compute(texts: pa.Array) -> pa.Array:
        bits = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
        return pa.array(np.array(bits, np.uint64).view(np.int64))

    return appended(df, text, compute, T.StructType([T.StructField(out, T.LongType())]))


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


# ---- groups ---------------------------------------------------------------------------------------

def filed(rows: DataFrame, level: int) -> DataFrame:
    """File every fingerprint under each block of its free bits: ``key`` grows by the block's value, and the
    free bits lose the block. ``free`` holds the free bits, right-aligned."""
    widths = LEVELS[level]
    entries, at = [], 0
    for n, width in enumerate(widths):
        low = at
        value = F.shiftrightunsigned("free", low).bitwiseAND(F.lit((1 << width) - 1))
        under = F.col("free").bitwiseAND(F.lit((1 << low) - 1)) if low else F.lit(0).cast("long")
        over = F.shiftrightunsigned("free", low + width) if low + width < 64 else F.lit(0).cast("long")
        entries.append(F.struct(F.xxhash64("key", F.lit(n), value).alias("key"), F.shiftleft(over, low).bitwiseOR(under).alias("free")))
        at += width
    return rows.select("bits", F.explode(F.array(*entries)).alias("e")).select("bits", "e.key", "e.free")


def groups(distinct: DataFrame, most: int = GROUP) -> DataFrame:
    """All groups of fingerprints (column ``bits``) that can hold links: ``bits``, ``key``; none is larger than
    ``most`` unless all but ``FREE`` bits are shared."""
    # the hash of a key only names a group: a clash joins two groups, which adds comparisons but no link
    open_ = filed(distinct.select("bits", F.lit(0).cast("long").alias("key"), F.col("bits").alias("free")), 0)
    done = None
    for level in range(len(LEVELS)):
        open_ = staged(open_, f"filed{level}")
        sizes = open_.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        cold = open_.join(sizes.where(F.col("members") <= most) if level + 1 < len(LEVELS) else sizes, "key", "left_semi").select("bits", "key")
        done = cold if done is None else done.unionByName(cold)
        if level + 1 == len(LEVELS):
            break
        hot = sizes.where(F.col("members") > most)
        if hot.isEmpty():
            break
        open_ = filed(open_.join(hot, "key", "left_semi"), level + 1)
    return done


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place in Gray-code order."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over fingerprints in Gray order.

    Level 0 has a node per ``LEAF`` members, each level above one per ``FAN`` nodes. ``mask`` marks the bits all
    members of a node share, ``value`` holds them.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.members = bits[np.argsort(gray_rank(bits), kind="stable")]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        ones, zeros, step = self.members, ~self.members, LEAF
        while True:
            at = np.arange(0, len(ones), step)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
            self.levels.append((ones | zeros, ones))
            if len(ones) == 1:
                break
            step = FAN

    @staticmethod
    def _children(left: np.ndarray, right: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        a = (left[:, None, None] * FAN + np.arange(FAN)[None, :, None]).repeat(FAN, 2).reshape(-1)
        b = (right[:, None, None] * FAN + np.arange(FAN)[None, None, :]).repeat(FAN, 1).reshape(-1)
        real = (a <= b) & (b < count)
        return a[real], b[real]

    def _uniform(self, own: np.ndarray) -> list[np.ndarray]:
        """Per level and node the class of all its members, -1 where they are of several."""
        out, low, high, step = [], own, own, LEAF
        for _ in self.levels:
            at = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
            step = FAN
        return out

    def _near(self, left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the linked members of pairs of leaves."""
        inside = np.arange(LEAF)
        a, b = left[:, None] * LEAF + inside, right[:, None] * LEAF + inside
        last = len(self.members) - 1  # the last leaf may be short: its last member fills it
        a, b = np.minimum(a, last), np.minimum(b, last)
        pair, x, y = np.nonzero(np.bitwise_count(self.members[a][:, :, None] ^ self.members[b][:, None, :]) <= distance)
        return a[pair, x], b[pair, y]

    def classes(self, distance: int) -> np.ndarray:
        """Place of each member's local class: the least place among the members it is linked to by chains.

        Neighbours in Gray order are linked first, so the runs of a dense group start as one class each. Pairs of
        nodes are then walked depth first in blocks of ``PAIRS``; a pair goes, with all pairs below it, if its shared
        patterns differ in more than ``distance`` bits or if the members of both are of one class already.
        """
        count = len(self.members)
        start = np.append(True, np.bitwise_count(self.members[1:] ^ self.members[:-1]) > distance)
        own = np.maximum.accumulate(np.where(start, np.arange(count), 0))
        uniform, parent, walked = self._uniform(own), {}, 0

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        def renamed() -> np.ndarray:
            to = np.arange(count)
            for x in parent:
                to[x] = root(x)
            return to[own]

        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, left, right = stack.pop()
            if len(left) > PAIRS:
                stack.append((level, left[PAIRS:], right[PAIRS:]))
                left, right = left[:PAIRS], right[:PAIRS]
            mask, value = self.levels[level]
            one = uniform[level][left]
            open_ = (np.bitwise_count((value[left] ^ value[right]) & mask[left] & mask[right]) <= distance) & ~(
                (one >= 0) & (one == uniform[level][right]))
            left, right = left[open_], right[open_]
            walked += len(open_)
            if level and len(left):
                stack.append((level - 1, *self._children(left, right, len(self.levels[level - 1][0]))))
            elif len(left):
                x, y = self._near(left, right, distance)
                p, q = own[x], own[y]
                apart = np.unique(np.stack([np.minimum(p, q), np.maximum(p, q)])[:, p != q], axis=1)
                for i, j in apart.T.tolist():
                    i, j = root(i), root(j)
                    if i != j:
                        parent[max(i, j)] = min(i, j)
            if parent and walked * LEAF >= count:  # names are renewed once as many pairs were walked as there are leaves
                own, parent, walked = renamed(), {}, 0
                uniform = self._uniform(own)
        return renamed()


def links(grouped: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Per group and member one row (``a``, ``b``): the member and its local class, where they differ."""
    def search(key: tuple, group: pa.Table) -> pa.Table:
        index = GrayIndex(np.unique(group.column("bits").to_numpy()).view(np.uint64))
        names, own = index.members.view(np.int64), index.classes(distance)
        moved = own != np.arange(len(own))
        return pa.table({"a": names[moved], "b": names[own[moved]]})

    return grouped.groupBy("key").applyInArrow(search, "a long, b long")


# ---- components -----------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """Component of every node of an undirected graph (``a``, ``b``): ``node``, ``root``, root the least node.

    Every round hangs each node's larger neighbours and the node itself on its least neighbour, then
    each node and its smaller neighbours on the least of those; edges never multiply and depths halve
    at least. Neighbourhoods are reduced to their minimum before they move, and joined by key.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        large = staged(large, "large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        small = staged(small, "small")
        # a forest of stars: nothing changed in this round
        if now.count() == small.count() and now.exceptAll(small).isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = small


def linked(marked: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows (``doc_id``, ``bits``) with ``root``, the fingerprint that names their component, and ``component_id``,
    its least id."""
    if distance + 1 != len(LEVELS[0]):
        raise ValueError(f"the blocks serve distances of {len(LEVELS[0]) - 1}")
    distinct = staged(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = components(links(groups(distinct), distance))
    rooted = distinct.join(found, distinct["bits"] == found["node"], "left").select("bits", "first_id", F.coalesce("root", "bits").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_bits = staged(rooted.join(named, "root").select("bits", "root", "component_id"), "classes")
    return marked.join(of_bits, "bits").select("doc_id", "bits", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Every row's ``doc_id``, ``bits`` (its fingerprint), ``root`` and ``component_id``, the least id of its component."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return linked(staged(fingerprints(narrow, "text", "bits", shingle).select("doc_id", "bits"), "fingerprints"), distance)


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, that with the least id, with all columns of ``docs``.

    Of rows that share the least id, and of components without any id, the row with the least fingerprint is
    taken, of equal ones that with the least hash of all its columns.
    """
    bits = free_name(docs, "_bits")
    marked = staged(fingerprints(docs, text, bits, shingle), "marked")
    found = linked(marked.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(bits).alias("bits")), distance)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("bits").alias("kept_bits"), F.first("component_id").alias("kept_id"))
    kept = marked.join(first, (F.col(bits) == F.col("kept_bits")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("kept_id")), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.groupBy(F.col(f"`{doc_id}`").alias("id"), F.col(bits).alias("bits")).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row")).select("row.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("bits")).alias("fingerprint"), "component_id")
