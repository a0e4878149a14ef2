"""Ordered rule lists evaluated as expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column

Rule = tuple[str, str]


def ordered(rules: Sequence[Rule], mode: str) -> list[Rule]:
    """Rule list of a mode.

    * ``strict``  — as written: patterns holding capitals can never match lower-cased text
    * ``fixed``   — patterns lower-cased, order kept (the default everywhere)
    * ``longest`` — lower-cased, longer patterns first, so that specific ones are not shadowed
    """
    if mode == "strict":
        return [r for r in rules if r[0] == r[0].lower()]
    lowered = [(p.lower(), t) for p, t in rules]
    seen: dict[str, str] = {}
    for p, t in lowered:
        seen.setdefault(p, t)
    if mode == "fixed":
        return list(seen.items())
    if mode == "longest":
        return sorted(seen.items(), key=lambda r: -len(r[0]))
    raise ValueError(f"unknown rule mode {mode!r}")


def reachable(rules: Sequence[Rule]) -> list[Rule]:
    """Rules that can win: a pattern that holds an earlier one never does."""
    kept: list[Rule] = []
    for pattern, target in rules:
        if not any(earlier in pattern for earlier, _ in kept):
            kept.append((pattern, target))
    return kept


@lru_cache(maxsize=16)
def automaton(patterns: tuple[str, ...]) -> ahocorasick.Automaton:
    """Automaton that finds all patterns in one pass, made once per worker."""
    found = ahocorasick.Automaton()
    for n, pattern in enumerate(patterns):
        found.add_word(pattern, n)
    found.make_automaton()
    return found


def first_rule(low: Column, rules: Sequence[Rule]) -> Column:
    """Target of the first rule whose pattern occurs in a text, found in one pass over the text whatever the
    number of rules; NULL if none does. Texts go to the workers in Arrow batches, the other columns stay."""
    live = reachable(rules)
    if not live:
        return F.lit(None).cast("string")
    patterns, targets = (tuple(r[n] for r in live) for n in (0, 1))

    @F.arrow_udf("string")
    def match(texts: pa.Array) -> pa.Array:
        search = automaton(patterns).iter
        none = len(targets)
        hits = [none if t is None else min((n for _, n in search(t)), default=none) for t in texts.to_pylist()]
        return pa.array([None if n == none else targets[n] for n in hits], pa.string())

    return match(low)


def classify(text: str | Column, rules: Sequence[Rule], default: str | None = None,
             first: Column | None = None, mode: str = "fixed") -> Column:
    """First rule whose pattern occurs in the lower-cased text wins: for short coded fields, where a search ends
    at once. Rules that can't win are left out; long texts are for :func:`classify_texts`.

    ``first`` (an already mapped value) has priority; ``default`` closes the chain.
    """
    low = F.lower(as_column(text))
    chain: Column | None = None
    for pattern, target in reachable(ordered(rules, mode)):
        test = low.contains(pattern)
        chain = F.when(test, F.lit(target)) if chain is None else chain.when(test, F.lit(target))
    parts = [c for c in (first, chain, None if default is None else F.lit(default)) if c is not None]
    return F.coalesce(*parts)


def classify_texts(df: DataFrame, text: str, rules: Sequence[Rule], out: str, default: str | None = None,
                   mode: str = "fixed") -> DataFrame:
    """Same as :func:`classify`, as a column on a frame and in one pass over each text, however long."""
    by_rule = first_rule(F.lower(F.col(text)), ordered(rules, mode))
    return df.withColumn(out, by_rule if default is None else F.coalesce(by_rule, F.lit(default)))


def apply_rules(df: DataFrame, rules: Sequence[tuple[Column, dict[str, str | None]]]) -> DataFrame:
    """Run order-dependent updates: each rule sees what the ones before it wrote."""
    for cond, sets in rules:
        safe = F.coalesce(cond, F.lit(False))
        df = df.withColumns({c: F.when(safe, F.lit(v)).otherwise(F.col(c)) for c, v in sets.items()})
    return df


def code_levels(*levels: tuple[Column, Column, Column], default: tuple[Column, Column]) -> tuple[Column, Column]:
    """Code-resolution cascade: the first level whose test is true gives the code and its type."""
    code: Column | None = None
    kind: Column | None = None
    for test, value, name in levels:
        code = F.when(test, value) if code is None else code.when(test, value)
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    return code.otherwise(default[0]), kind.otherwise(default[1])
