"""Conversation structure repair: the cheapest edits after which roles read ``(system? (user assistant)+)?``.

The pattern is a repair grammar in Chomsky normal form over spans of turns. A nonterminal ``(p, q)`` derives
the spans that lead from place ``p`` of the pattern to place ``q``; its binary rules are
``(p, q) -> (p, r) (r, q)``, and a single turn is derived by keeping, re-roling or deleting it. A cell is the
least (cost, audit) of a nonterminal over a span, the audit being the edits' initials in order. Insertions
are a closure: the cheapest insertions from ``p`` to ``q`` stand on both sides of every turn's cells.

Cells are combined bottom-up by span length: 1, 2, 4, ... As every rule holds at every split, one split
per span gives the least of all of them. Two audits of equal cost over one span are never prefixes of each other
(the longer one would cost its insertions more), so the least cell of a span is made of least cells.

How it runs: rows are dealt by ranges of (conversation, turn, role, text) and sorted. A conversation that lies
inside one range and has at most ``LONG`` rows and ``BYTES`` of text is repaired where it is read. Longer ones, and
those at the edge of a range, go on as single rows: repeats are found by first rows per (conversation, role,
digest of the text), cells are made per block of ``BLOCK`` rows and combined ``FAN`` at a time, and
the edits come back to the rows by a join on row ids. So no task holds a long conversation's rows.

Defined cases: a null role or text counts as one space; null conversation ids form one conversation; null turns come first,
rows of equal turn follow each other by role and text; a row whose role does not begin with s, u or a cannot be
kept, an empty role neither; a conversation all of whose rows have ``copies`` 0 is reported with an empty audit;
repeated rows are duplicates; an empty table gives no rows; only the four named columns are read, others of any name do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .common import T_to_arrow, sliced, table

#: Where each role initial leads from each place of the pattern; a conversation may end at places 0 and 3.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
INSERT, REROLE, DELETE, CUT = 3, 3, 4, 3
NEVER = 1 << 60

SPANS = [(p, q) for p in STEPS for q in STEPS if q >= p or (p, q) == (3, 2)]
SPAN = {s: n for n, s in enumerate(SPANS)}
RULES = [[(SPAN[p, r], SPAN[r, q]) for r in STEPS if (p, r) in SPAN and (r, q) in SPAN] for p, q in SPANS]

#: Faults of a row, in the order in which they are looked for.
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
WHITE = " \t\n\x0b\x0c\r"

LONG, BYTES = 2000, 8 << 20
BLOCK, FAN = 2048, 16

Cell = tuple[int, str]


def combined(left: list[Cell], right: list[Cell]) -> list[Cell]:
    """Cells of a span from those of its two halves."""
    out = []
    for rules in RULES:
        least, audit = NEVER, ""
        for a, b in rules:
            cost = left[a][0] + right[b][0]
            if cost < least or (cost == least < NEVER and left[a][1] + right[b][1] < audit):
                least, audit = cost, left[a][1] + right[b][1]
        out.append((least, audit))
    return out


@cache
def inserted() -> list[Cell]:
    """Insertion closure: the cheapest insertions of every nonterminal."""
    cells = [(0, "") if p == q else (INSERT, "I") if any(STEPS[p].get(x) == q for x in ROLES) else (NEVER, "") for p, q in SPANS]
    while (more := combined(cells, cells)) != cells:
        cells = more
    return cells


@cache
def turn_cells(initial: str, fault: int) -> list[Cell]:
    """Cells of one row, insertions on both sides included."""
    extra = CUT if fault == TRUNCATED else 0
    cells = []
    for p, q in SPANS:
        ways = [(DELETE, "D")] if p == q else []
        if fault in (FINE, TRUNCATED):
            ways += [(extra, "K")] if STEPS[p].get(initial) == q else []
            ways += [(REROLE + extra, "R")] if any(STEPS[p].get(x) == q for x in ROLES) else []
        cells.append(min(ways, default=(NEVER, "")))
    return combined(combined(inserted(), cells), inserted())


def span_cells(leaves: list[list[Cell]]) -> list[Cell]:
    """Cells of a whole span, combined bottom-up by length."""
    while len(leaves) > 1:
        pairs = [combined(leaves[n], leaves[n + 1]) for n in range(0, len(leaves) - 1, 2)]
        leaves = pairs + leaves[len(pairs) * 2:]
    return leaves[0] if leaves else inserted()


def answer(cells: list[Cell]) -> Cell:
    return min(cells[SPAN[0, q]] for q in ENDS)


@lru_cache(maxsize=20_000)
def parsed(turns: tuple[tuple[str, int], ...]) -> Cell:
    """Least cost and audit of a conversation given as (role initial, fault) per row."""
    return answer(span_cells([turn_cells(i, f) for i, f in turns]))


def edits(audit: str, initials: str, place: int = 0) -> Iterator[tuple[str, int, str, int]]:
    """(edit, row number, new role, place after it) per edit; an insertion has the number of the row it stands before,
    and the role is empty where the row keeps its own."""
    row = 0
    for edit in audit:
        role = ""
        if edit == "K":
            place = STEPS[place][initials[row]]
        elif edit != "D":
            x = next(x for x in ROLES if x in STEPS[place])
            role, place = ROLES[x], STEPS[place][x]
        yield edit, row, role, place
        row += edit != "I"


def fault_of(text: str, seen: bool) -> int:
    end = text.rstrip(WHITE)[-1:]
    return BLANK if not end else DUPLICATE if seen else FINE if end in ".!?" else TRUNCATED


def initial_of(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "-"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
ROW = ["turn", "role", "text", "copies"]


def short(conv: object, rows: list[tuple]) -> tuple:
    """One whole conversation: counts, audit, and the repaired turns."""
    seen: set[tuple[str, str]] = set()
    full = []
    for turn, role, text, copies in rows:
        for _ in range(copies):
            full.append((turn, role, text, fault_of(text, (role, text) in seen)))
            seen.add((role, text))
    initials = [initial_of(r[1]) for r in full]
    faults = [r[3] for r in full]
    numbers = {r[0] for r in full if r[0] is not None}
    cost, audit = parsed(tuple(zip(initials, faults)))
    turns = [(e, role or full[n][1], "" if e == "I" else full[n][2]) for e, n, role, _ in edits(audit, "".join(initials)) if e != "D"]
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return (conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal_pairs(initials), cost, audit,
            [t[0] for t in turns], [t[1] for t in turns], [t[2] for t in turns])


@dataclass
class Repair:
    """``conversations``: one row per conversation with its counts, cost and audit. ``turns``: one row per turn
    that stands after the repair, in order of ``place``, with its ``edit``."""

    conversations: DataFrame
    turns: DataFrame
    #: Conversations repaired where they were read, with arrays of their turns; all others, and the turns of those.
    whole: DataFrame
    loose: DataFrame
    rest: DataFrame


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None, long: int = LONG, block: int = BLOCK, fan: int = FAN) -> Repair:
    """Repair all conversations of a table; column ``copies`` (1 if not given) says how often each row stands there.

    ``long``, ``block`` and ``fan`` say how the work is split, not what comes out.
    """
    kind = df.schema[conv].dataType
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"), (F.col(f"`{copies}`") if copies else F.lit(1)).cast("int").alias("copies"))
    # the range keys are sampled by the driver, so only the start of a text is among them
    dealt = rows.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(32))).sortWithinPartitions("conv", "turn", "role", "text")
    parts = staged(dealt.mapInArrow(scanner(long), scan_type(kind)), "turns", by="whole")
    whole = parts.where("whole = 1").select("conv", *COUNTS, "audit", "edits", "roles", "texts")
    loose = parts.where("whole = 0").select("conv", "id", *ROW)
    found, rest = repaired_rows(loose, block, fan)
    one = whole.select("conv", F.posexplode(F.arrays_zip("edits", "roles", "texts")).alias("place", "t"))
    turns = one.select("conv", F.col("place").cast("long"), F.lit(0).alias("within"), F.col("t.roles").alias("role"), F.col("t.texts").alias("text"), F.col("t.edits").alias("edit"))
    return Repair(whole.select("conv", *COUNTS, "audit").unionByName(found), turns.unionByName(rest), whole, found, rest)


def scan_type(conv: T.DataType) -> T.StructType:
    strings = T.ArrayType(T.StringType())
    return T.StructType([T.StructField("whole", T.IntegerType()), T.StructField("conv", conv), *[T.StructField(c, T.LongType()) for c in COUNTS],
                         T.StructField("audit", T.StringType()), *[T.StructField(c, strings) for c in ("edits", "roles", "texts")],
                         T.StructField("id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                         T.StructField("text", T.StringType()), T.StructField("copies", T.IntegerType())])


def scanner(most: int):
    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows in, repaired conversations and loose rows out. The first and the last conversation
        of a range may go on in its neighbours, so their rows stay loose."""
        base, number = TaskContext.get().partitionId() << 33, 0
        ready: list[tuple] = []
        loose: list[tuple] = []
        rows: list[tuple] = []
        size, current, loosely, kind = 0, None, True, None
        started = False
        for part in parts:
            kind = part.schema.field(0).type
            for piece in sliced(part):
                for conv, *row in zip(*[c.to_pylist() for c in piece.columns]):
                    if not started or conv != current:
                        if started and not loosely:
                            ready.append(short(current, rows))
                        loosely = not started
                        rows, size, current, started = [], 0, conv, True
                    rows.append(tuple(row))
                    size += len(row[2]) + 64
                    if loosely or len(rows) > most or size > BYTES:
                        loosely = True
                        loose += [(conv, base + number + n, *r) for n, r in enumerate(rows)]
                        number += len(rows)
                        rows = []
                yield from written(ready, loose, kind)
                ready, loose = [], []
        yield from written([], [(current, base + number + n, *r) for n, r in enumerate(rows)], kind)

    def written(ready: list[tuple], loose: list[tuple], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        fields = [(f.name, T_to_arrow(f)) for f in scan_type(T.LongType())]
        fields = [(n, kind if n == "conv" else t) for n, t in fields]
        for whole, held in ((1, ready), (0, loose)):
            if held:
                names = ["conv", *COUNTS, "audit", "edits", "roles", "texts"] if whole else ["conv", "id", *ROW]
                columns = dict(zip(names, zip(*held)))
                yield pa.RecordBatch.from_arrays([pa.array([whole] * len(held), pa.int32()) if n == "whole" else pa.array(columns[n], t) if n in columns
                                                  else pa.nulls(len(held), t) for n, t in fields], [n for n, _ in fields])

    return scan


def repaired_rows(loose: DataFrame, size: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """Conversations and repaired turns of loose rows, whose ids ascend in their order."""
    end = F.right(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), F.lit(1))
    narrow = staged(loose.select("conv", "id", "turn", "copies", "role", F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("-").alias("initial"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                                 F.when(end == "", BLANK).when(end.isin(*".!?"), FINE).otherwise(TRUNCATED).alias("own")), "narrow")
    stands = narrow.where("copies > 0")
    first = stands.groupBy("conv", "role", "digest").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("first").isNull(), DUPLICATE).otherwise(F.col("own"))
    tokens = stands.join(first, "id", "left").select("conv", "id", "initial", "copies", fault.cast("int").alias("fault"))
    conv = loose.schema["conv"].dataType
    shape = T.StructType([T.StructField("conv", conv), *[T.StructField(c, T.LongType()) for c in ("block", "blank", "duplicate", "truncated", "illegal")],
                          T.StructField("edge", T.StringType()), T.StructField("tokens", T.LongType()), T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())),
                          T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("initials", T.StringType())])
    segments = staged(tokens.withColumn("block", F.expr(f"id div {size}")).groupBy("block").applyInArrow(lambda t: segment(t, shape), shape), "segments")
    level = segments.select("conv", F.row_number().over(_in_order()).cast("long").alias("at"), *[c for c in shape.names if c not in ("conv", "block", "ids", "initials")])
    tree = T.StructType([level.schema["conv"], level.schema["at"], *level.schema.fields[2:]])
    level = staged(level.withColumn("at", F.col("at") - 1), "cells")
    while (level.agg(F.max("at")).first()[0] or 0) > 0:
        grown = level.withColumn("up", F.expr(f"at div {fan}")).groupBy("conv", "up").applyInArrow(lambda t: joined(t, tree, fan), tree)
        level = staged(grown, "cells")
    best = level.select("conv", "blank", "duplicate", "truncated", "illegal", *_answer())
    spread = narrow.groupBy("conv").agg(F.coalesce(F.expr("max(turn) filter (where copies > 0) - min(turn) filter (where copies > 0) + 1"
                                                          " - count(distinct turn) filter (where copies > 0)"), F.lit(0)).cast("long").alias("gaps"))
    found = spread.alias("s").join(best.alias("b"), F.col("s.conv").eqNullSafe(F.col("b.conv")), "left").select(
        "s.conv", "gaps", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS[1:]], F.coalesce("audit", F.lit("")).alias("audit"))
    return found, placed(loose, segments, best)


def _in_order():
    from pyspark.sql import Window
    return Window.partitionBy("conv").orderBy("block")


def _answer() -> list[Column]:
    cells = F.array(*[F.struct(F.col("costs")[SPAN[0, q]].alias("cost"), F.col("audits")[SPAN[0, q]].alias("audit")) for q in ENDS])
    least = F.array_min(cells)
    return [least["cost"].alias("cost"), least["audit"].alias("audit")]


def segment(rows: pa.Table, shape: T.StructType) -> pa.Table:
    """The conversations' parts within one block: counts and cells each."""
    held = sorted(rows.to_pylist(), key=lambda r: r["id"])
    parts: list[list[dict]] = []
    for row in held:
        if not parts or parts[-1][0]["conv"] != row["conv"]:
            parts.append([])
        parts[-1].append(row)
    out = []
    for part in parts:
        turns, ids = [], []
        for r in part:
            again = r["fault"] if r["fault"] == BLANK else DUPLICATE
            turns += [(r["initial"], r["fault"])] + [(r["initial"], again)] * (r["copies"] - 1)
            ids += [r["id"]] * r["copies"]
        cells = span_cells([turn_cells(i, f) for i, f in turns])
        faults = [f for _, f in turns]
        initials = [i for i, _ in turns]
        out.append((part[0]["conv"], part[0]["block"], faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal_pairs(initials),
                    initials[0] + initials[-1], len(turns), [c for c, _ in cells], [a for _, a in cells], ids, "".join(initials)))
    return pa.table([pa.array(c, T_to_arrow(f)) if f.name != "conv" else pa.array(c, rows.schema.field("conv").type) for c, f in zip(zip(*out), shape)], names=shape.names)


def joined(rows: pa.Table, shape: T.StructType, fan: int) -> pa.Table:
    """One part out of up to ``fan`` neighbouring parts of a conversation."""
    held = sorted(rows.to_pylist(), key=lambda r: r["at"])
    cells = span_cells([list(zip(r["costs"], r["audits"])) for r in held])
    illegal = sum(r["illegal"] for r in held) + sum(illegal_pairs([a["edge"][1], b["edge"][0]]) for a, b in zip(held, held[1:]))
    one = {"conv": held[0]["conv"], "at": held[0]["at"] // fan, **{c: sum(r[c] for r in held) for c in ("blank", "duplicate", "truncated", "tokens")}, "illegal": illegal,
           "edge": held[0]["edge"][0] + held[-1]["edge"][1], "costs": [c for c, _ in cells], "audits": [a for _, a in cells]}
    return pa.table([pa.array([one[f.name]], rows.schema.field(f.name).type) for f in shape], names=shape.names)


def placed(loose: DataFrame, segments: DataFrame, best: DataFrame) -> DataFrame:
    """Repaired turns of loose rows: each block gets its part of the audit and the place it begins at."""
    lengths = segments.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "tokens"))).alias("blocks"))  # one entry per BLOCK rows
    audits = lengths.alias("l").join(best.alias("b"), F.col("l.conv").eqNullSafe(F.col("b.conv"))).select("l.conv", "blocks", "audit")
    conv = loose.schema["conv"]
    shape = T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("audit", T.StringType())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in range(part.num_rows):
                row = part.slice(n, 1)
                blocks, audit = row.column(1)[0].as_py(), row.column(2)[0].as_py()
                # an odd number of turns begins with the system's
                system, at, turns, out = (len(audit) - audit.count("D")) % 2, 0, 0, []
                for b in blocks:
                    start, left = at, b["tokens"]
                    while left or (b is blocks[-1] and at < len(audit)):
                        left -= audit[at] != "I"
                        at += 1
                    out.append((b["block"], 0 if turns == 0 else 1 if turns == system else 3 - (turns - system) % 2, audit[start:at]))
                    turns += at - start - audit.count("D", start, at)
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays([pa.array([row.column(0)[0].as_py()] * len(out), row.schema.field(0).type), *columns], shape.names)

    cuts = audits.mapInArrow(cut, shape)
    both = segments.alias("s").join(cuts.alias("c"), (F.col("s.block") == F.col("c.block")) & F.col("s.conv").eqNullSafe(F.col("c.conv")))
    each = T.StructType([conv, T.StructField("id", T.LongType()), T.StructField("within", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("edit", T.StringType())])

    def turns(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in range(part.num_rows):
                row = part.slice(n, 1)
                ids, initials, audit, place = [c[0].as_py() for c in row.columns[1:]]
                out = [(ids[min(at, len(ids) - 1)], k, role, e) for k, (e, at, role, _) in enumerate(edits(audit, initials, place)) if e != "D"]
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.string(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([pa.array([row.column(0)[0].as_py()] * len(out), row.schema.field(0).type), *columns], each.names)

    edited = both.select("s.conv", "ids", "initials", "audit", "place").mapInArrow(turns, each)
    texts = loose.select("id", F.col("role").alias("own"), "text")
    return edited.join(texts, "id").select("conv", F.col("id").alias("place"), "within", F.when(F.col("role") == "", F.col("own")).otherwise(F.col("role")).alias("role"),
                                           F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit")


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, read in order as a stream: no conversation is held in memory."""
    dealt = turns.select("conv", "place", "within", F.concat("role", F.lit(":"), "text").alias("line")).repartition("conv").sortWithinPartitions("conv", "place", "within")
    shape = T.StructType([turns.schema["conv"], T.StructField("repaired_sha256", T.StringType())])

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = None, None, None
        for part in parts:
            kind = part.schema.field(0).type
            done = []
            for piece in sliced(part):
                for conv, line in zip(piece.column(0).to_pylist(), piece.column(3).to_pylist()):
                    if digest is None or conv != current:
                        if digest is not None:
                            done.append((current, digest.hexdigest()))
                        current, digest = conv, hashlib.sha256(line.encode())
                    else:
                        digest.update(b"\n" + line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (kind, pa.string()))], shape.names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])], shape.names)

    return dealt.mapInArrow(stream, shape)


def damaged(df: DataFrame) -> DataFrame:
    """Damage of the query's contract: rows with ``copies``, 0 for those that are dropped."""
    ids = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return df.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                     F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                     F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after the damage."""
    done = repair(damaged(table(spark, sf_dir, "conversations")), copies="copies")
    lines = F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(t["roles"], F.lit(":"), t["texts"]))
    whole = done.whole.select("conv", *COUNTS, "audit", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"))
    rest = done.loose.alias("r").join(digests(done.rest).alias("d"), F.col("r.conv").eqNullSafe(F.col("d.conv")), "left").select(
        "r.conv", *COUNTS, "audit", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return whole.unionByName(rest).withColumnRenamed("conv", "conv_id")


def _add(cell: str, cost: str, letter: str) -> str:
    return f"lpad((left({cell}, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || '{letter}' || substr({cell}, 11)"


def _row_cells() -> str:
    """Cells of all places before a row from those behind it, as text: ten digits of cost, then the audit."""
    to = {p: {x: f"t{q}" for x, q in steps.items()} for p, steps in STEPS.items()}
    cells = []
    for p, steps in to.items():
        keep = " ".join(f"WHEN r.initial = '{x}' THEN {_add(t, 'r.extra', 'K')}" for x, t in steps.items())
        change = [t for x, t in steps.items() if x in ROLES][0]
        cells.append(f"least({_add(f't{p}', str(DELETE), 'D')}, CASE WHEN r.must THEN '~' {keep} ELSE '~' END,"
                     f" CASE WHEN r.must THEN '~' ELSE {_add(change, f'r.extra + {REROLE}', 'R')} END) AS n{p}")
    return ", ".join(cells)


#: The repair read from the last row to the first: the least cell of every place, with insertions before each row.
OP13_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 20 AS k
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked, unnest(CASE k WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copies(c)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
told AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_char,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
  FROM placed),
turns AS (
  SELECT *, last_char = '' AS blank, last_char <> '' AND again AS duplicate, last_char NOT IN ('', '.', '!', '?') AND NOT again AS truncated FROM told),
rows_ AS (SELECT conv_id, i, initial, blank OR duplicate AS must, CASE WHEN truncated THEN {CUT} ELSE 0 END AS extra FROM turns),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM turns GROUP BY conv_id),
cells AS (
  SELECT conv_id, n AS i, '0000000000' AS t0, '0000000006II' AS t1, '0000000003I' AS t2, '0000000000' AS t3 FROM facts
  UNION ALL
  SELECT conv_id, i, least(n0, {_add('n2', str(INSERT), 'I')}, {_add('n3', str(2 * INSERT), 'II')}), least(n1, {_add('n2', str(INSERT), 'I')}, {_add('n3', str(2 * INSERT), 'II')}),
    least(n2, {_add('n3', str(INSERT), 'I')}), least(n3, {_add('n2', str(INSERT), 'I')})
  FROM (SELECT c.conv_id, c.i - 1 AS i, {_row_cells()} FROM cells c JOIN rows_ r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.i = r.i)),
best AS (SELECT conv_id, left(t0, 10)::BIGINT AS cost, substr(t0, 11) AS audit FROM cells WHERE i = 0),
letters AS (SELECT conv_id, audit, unnest(string_split(audit, '')) AS edit, unnest(range(length(audit))) AS pos FROM best WHERE audit <> ''),
counted AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY pos) - length(replace(audit, 'D', '')) % 2 AS nth FROM letters),
lines AS (
  SELECT c.conv_id, c.pos, CASE WHEN edit = 'K' THEN t.role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE t.text END AS line
  FROM counted c LEFT JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND c.i = t.i WHERE edit <> 'D'),
joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN joined j ON o.conv_id IS NOT DISTINCT FROM j.conv_id
"""
