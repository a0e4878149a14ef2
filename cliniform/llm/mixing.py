"""Mixing sources to target weights, with DataFrame functions only.

Each source is laid out as one line of words and packed into blocks of ``block`` words. A source whose
target is ``t`` words gets the number of slots whose words come nearest to ``t``. How many of them each output shard
gets is a multinomial draw: every slot tosses a hashed shard and the tosses are counted by source and shard, so
the counts of a source add up to its target whatever is drawn. In order of the shards, the counts cut the source's
slots into ranges. A slot's block is its place in a pseudorandom permutation of the source's blocks, one
permutation per round through the source, so a block is used at most once per round. Slots and blocks meet
in an equi-join on (source, block).

``Mix.taken`` and ``mixed_texts`` give the mix by document; ``mixed_shards`` gives it by shard, as blocks of text.
Only ids and sizes move to draw it; texts are joined once, to be cut.

Defined cases: a null or blank text has size 0 and is never taken; rows without a source form one
source, last in order; repeated rows are separate documents of equal content (the mix may take
them differently, which of the two shows which number is not fixed); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.stage import staged
from .common import WORD, free_name, table, word_count

#: Words per block, weights in order of the sources, words wanted per word held, most uses of a word.
BLOCK = 256
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = 20

#: Slots per output shard on average; parts a source's line is laid out in, and shards in one part of their order.
SHARD_SLOTS = 4096
PARTS = 1024
#: Slots one row makes at least, rows a source is cut into at most, slots of a task, most tasks.
CHUNK = 4096
CHUNKS = 16384
TASK_SLOTS = 1 << 16
TASKS = 20_000
#: Rounds of the permutation.
ROUNDS = 10


def targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: tuple[float, ...] = WEIGHTS,
            share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """One row per source: its place in order, its size and its target in words.

    Targets are ``min(repeats * size, rate * weight)`` with one rate for all, the fixed point of
    handing the excess of full sources to the others by weight. One row per source is sorted in one
    task; the rows of the corpus are summed before.
    """
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("source_no", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                       (F.col("source_no") % len(weights) + 1).cast("int")))
    room = F.col("source_size") * float(repeats)
    fill = Window.orderBy(F.col("room") / F.col("weight"), "source_no")
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    filled = (ranked.withColumn("room", room)
              .withColumn("rate", (F.sum("source_size").over(Window.partitionBy()) * float(share) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
                          / F.sum("weight").over(rest)))
    # the first source in filling order that its share does not fill sets the rate; if none, all are full
    placed = filled.withColumn("place", F.row_number().over(fill)).withColumn("open", F.col("room") > F.col("rate") * F.col("weight"))
    first = placed.withColumn("final_rate", F.min(F.when(F.col("open"), F.struct("place", "rate"))).over(Window.partitionBy())["rate"])
    return first.select("source_no", "source", F.col("source_size"),
                        F.when(F.col("final_rate").isNull(), F.col("room"))
                        .otherwise(F.least(F.col("room"), F.col("final_rate") * F.col("weight"))).alias("target"))


def permuted(index: Column, size: Column, *keys: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``index`` in a pseudorandom permutation of 0 ... size-1 that ``keys`` choose.

    Swap-or-not rounds: each pairs the indexes that add up to a random number and swaps a pair on the
    toss of a hash; every round is a bijection for any size.
    """
    start = index.cast("long")

    def step(x: Column, i: Column) -> Column:
        other = F.pmod(F.xxhash64(*keys, i) - x, size)
        return F.when(F.xxhash64(*keys, i, F.greatest(x, other)).bitwiseAND(1) == 1, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), start, step)


def running(rows: DataFrame, part: Column, order: list[Column | str], size: str, out: str) -> DataFrame:
    """Append ``out``, the sum of ``size`` over the rows of the same source before this one, by ``part`` and then ``order``.

    No window holds a whole source: places within a part come from a window, places of the parts from the parts' sums.
    """
    parts = rows.withColumn("part", part)
    sums = parts.groupBy("source_no", "part").agg(F.sum(size).alias("part_size"))
    before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("source_no", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("inner_start", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return placed.join(offsets, ["source_no", "part"]).withColumn(out, F.col("part_start") + F.col("inner_start")).drop("part", "part_start", "inner_start")


def laid_out(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """Append ``start``, the words of the same source before the document; the line is in order of hashes, and rows
    without an id are spread by ``salt`` where there is such a column."""
    spread = F.xxhash64(F.col(doc_id), F.lit(SEED), *[F.col("salt")] * ("salt" in docs.columns))  # a hash passes over nulls
    return running(docs, F.pmod(spread, F.lit(PARTS)), [spread, doc_id, size], size, "start")


def packed(placed: DataFrame, block: int = BLOCK, size: str = "size") -> DataFrame:
    """One row per document and block it has words in: ``block_no``, ``word_from``, ``word_to`` (exclusive)."""
    low, high = F.col("start"), F.col("start") + F.col(size)
    rows = placed.where(F.col(size) > 0).withColumn("block_no", F.explode(F.sequence(F.floor(low / block), F.floor((high - 1) / block))))
    return (rows.withColumn("word_from", F.greatest(low, F.col("block_no") * block) - low)
            .withColumn("word_to", F.least(high, (F.col("block_no") + 1) * block) - low))


def planned(sources: DataFrame, block: int = BLOCK, repeats: float = REPEATS) -> DataFrame:
    """Blocks and slots of every source that has some: ``source_no``, ``blocks``, ``slots``."""
    blocks = F.ceil(F.col("source_size") / block)
    # whole rounds give exactly the source's words, also where its last block is short
    whole = F.floor(F.col("target") / F.col("source_size"))
    slots = F.least(whole * blocks + F.round((F.col("target") - whole * F.col("source_size")) / block).cast("long"), blocks * int(repeats))
    return sources.where(F.col("source_size") > 0).select("source_no", blocks.alias("blocks"), slots.alias("slots")).where("slots > 0")


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, int]:
    """Slots each shard gets of each source, and the number of tasks that make them.

    Rows: ``source_no``, ``blocks``, ``shard``, ``slots`` and ``first_slot``, the place of the first of them. A source's
    row becomes chunks, chunks are dealt over the cluster, and their slots toss there and are counted before the shuffle.
    """
    total = plan.agg(F.sum("slots")).first()[0] or 0
    shards, tasks = max(1, -(-total // shard_slots)), max(1, min(TASKS, -(-total // TASK_SLOTS)))
    chunks = plan.withColumn("chunk", F.greatest(F.lit(CHUNK).cast("long"), F.ceil(F.col("slots") / CHUNKS)))
    chunks = chunks.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.col("chunk"))))
    tosses = chunks.repartition(tasks, "source_no", "first").select(
        "source_no", "blocks", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + F.col("chunk"), F.col("slots")) - 1)).alias("slot"))
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), "source_no", "slot"), F.lit(shards)).alias("shard")
    counts = tosses.groupBy("source_no", "blocks", shard).agg(F.count("*").alias("slots"))
    return running(counts, F.floor(F.col("shard") / PARTS), ["shard"], "slots", "first_slot"), tasks


def drawn(counts: DataFrame, tasks: int, seed: int = SEED) -> DataFrame:
    """One row per slot of the mix: ``source_no``, ``slot``, ``round``, ``block_no``, ``shard``."""
    each = counts.repartition(tasks, "source_no", "shard").select(
        "source_no", "blocks", "shard", F.explode(F.sequence(F.col("first_slot"), F.col("first_slot") + F.col("slots") - 1)).alias("slot"))
    each = each.withColumn("round", F.floor(F.col("slot") / F.col("blocks")))
    return each.select("source_no", "slot", "round", "shard",
                       permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source_no"), F.col("round")).alias("block_no"))


class Mix:
    """A mix of a corpus: sizes, sources, placed documents, their pieces, the counts of the shards and the drawn slots.

    Sizes and sources are computed once and written to the shared stage folder, since every part reads them. One
    job adds the slots of the sources up, for the number of shards.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                 weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> None:
        ident, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
        sized = staged(docs.select(ident.alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(body).alias("size"),
                                   F.when(ident.isNull(), F.xxhash64(body)).alias("salt")), "sizes")
        self.block = block
        self.sources = staged(targets(sized, weights=weights, share=share), "sources")
        known = self.sources.select(F.col("source").alias("source_key"), "source_no", "source_size", "target")
        self.docs = sized.join(known, sized["source"].eqNullSafe(known["source_key"])).drop("source_key")
        self.placed = laid_out(self.docs.where("size > 0"))
        self.pieces = packed(self.placed, block)
        self.shards, tasks = shard_counts(planned(self.sources, block), shard_slots)
        self.slots = drawn(self.shards, tasks)

    def draws(self) -> DataFrame:
        """The mix itself: for every slot the pieces of documents that its block holds."""
        return self.slots.join(self.pieces, ["source_no", "block_no"])

    def taken(self) -> DataFrame:
        """Every document with the words the mix takes from it."""
        used = self.slots.groupBy("source_no", "block_no").agg(F.count("*").alias("uses"))
        words = (self.pieces.join(used, ["source_no", "block_no"], "left")
                 .groupBy("source_no", "start", "doc_id", "size", "source_size", "target")
                 .agg(F.sum((F.col("word_to") - F.col("word_from")) * F.coalesce("uses", F.lit(0))).alias("taken")))
        out = ["doc_id", "size", "source_size", "target", "taken"]
        return words.select(out).unionByName(self.docs.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(out))


def paired(docs: DataFrame, placed: DataFrame, doc_id: str, text: str, source: str, *values: str) -> tuple[DataFrame, dict[str, str]]:
    """Rows of ``docs`` with the ``values`` of their rows in ``placed`` (one per place in the line, or per place and
    round), and the names these have.

    Rows meet by id, source and size; rows that agree in all three are numbered on both sides, so repeated rows pair up.
    """
    right = placed.withColumn("nth", F.dense_rank().over(Window.partitionBy("doc_id", "source", "size").orderBy("start")))
    name = {c: free_name(docs, f"_mix_{c}") for c in ("doc_id", "source", "size", "nth", *values, "own_size", "own_nth", "all")}
    right = right.select([F.col(c).alias(name[c]) for c in ("doc_id", "source", "size", "nth", *values)])
    body, own, nth = F.col(f"`{text}`"), name["own_size"], name["own_nth"]
    same = Window.partitionBy(f"`{doc_id}`", f"`{source}`", own).orderBy(F.xxhash64(body))
    left = docs.withColumn(own, word_count(body)).withColumn(nth, F.row_number().over(same))
    return left.join(right, F.col(f"`{doc_id}`").eqNullSafe(F.col(name["doc_id"])) & F.col(f"`{source}`").eqNullSafe(F.col(name["source"]))
                     & (F.col(own) == F.col(name["size"])) & (F.col(nth) == F.col(name["nth"]))), name


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as documents: per document and round one row whose text is the words taken.

    A document taken whole in a round keeps its text as it is; of one taken in part, the words of the
    drawn blocks are joined by one space in text order. All columns of ``docs`` stay. Rows join their
    pieces by (doc id, size, source); rows that agree in all three share their pieces.
    """
    mix = Mix(docs, doc_id, text, source)
    used = mix.draws().groupBy("doc_id", "source", "size", "start", "round").agg(
        F.sum(F.col("word_to") - F.col("word_from")).alias("words"),
        F.array_sort(F.collect_list(F.struct("word_from", "word_to"))).alias("ranges"))
    joined, name = paired(docs, used, doc_id, text, source, "words", "ranges")
    body = F.col(f"`{text}`")
    part = F.col(name["words"]) < F.col(name["own_size"])
    cut = joined.withColumn(name["all"], F.when(part, words_of(body)))
    some = F.transform(name["ranges"], lambda r: F.slice(F.col(name["all"]), (r["word_from"] + 1).cast("int"), (r["word_to"] - r["word_from"]).cast("int")))
    return cut.withColumn(text, F.when(part, F.array_join(F.flatten(some), " ")).otherwise(body)).select([f"`{c}`" for c in docs.columns])


def mixed_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
                 shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as it is written: one row per slot with ``shard``, ``source``, ``slot``, ``n_words`` and ``text``, the
    words of its block (of several documents, if short) joined by one space. Partition by ``shard`` to write a file each."""
    mix = Mix(docs, doc_id, text, source, block=block, shard_slots=shard_slots)
    joined, name = paired(docs, mix.placed, doc_id, text, source, "start", "source_no")
    start, size = F.col(name["start"]), F.col(name["own_size"])

    def cut(no: Column) -> Column:
        low = F.greatest(start, no * block) - start
        piece = F.slice("words", (low + 1).cast("int"), (F.least(start + size, (no + 1) * block) - start - low).cast("int"))
        return F.struct(no.alias("block_no"), (start + low).alias("at"), F.size(piece).alias("count"), F.array_join(piece, " ").alias("piece"))

    numbers = F.sequence(F.floor(start / block), F.floor((start + size - 1) / block))
    rows = joined.select(start.alias(name["start"]), size.alias(name["own_size"]), F.col(name["source_no"]).alias("source_no"),
                         F.col(f"`{source}`").alias("source"), words_of(F.col(f"`{text}`")).alias("words"))
    pieces = rows.select("source_no", "source", F.explode(F.transform(numbers, cut)).alias("p")).select("source_no", "source", "p.*")
    return mix.slots.join(pieces, ["source_no", "block_no"]).groupBy("shard", "source_no", "slot").agg(
        F.first("source").alias("source"), F.sum("count").alias("n_words"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), " ").alias("text")).drop("source_no")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document."""
    return Mix(table(spark, sf_dir, "documents")).taken()
