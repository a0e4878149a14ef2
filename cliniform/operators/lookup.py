"""Value-set and vocabulary lookups."""

from __future__ import annotations

from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import as_column
from ..sources.stage import staged
from .sizing import attach, is_small, join_spread, measured, planned_bytes, setting

# Columns of the value-set map
CLASS, SOURCE, TARGET, LABEL, DESCRIPTION, VALUE = (
    "source_class", "source_code", "target_code", "target_label", "description", "value_code")


# Separator and NULL mark inside shared map keys; no code holds these control characters.
_SEP, _NULL = "\u0001", "\u0002"
_shared: WeakKeyDictionary[DataFrame, dict[str, DataFrame]] = WeakKeyDictionary()


def all_entries(vmap: DataFrame, by: str) -> DataFrame:
    """Whole map, one row per (class, code): joined keys and least targets.

    Every plain lookup of a plan joins this same relation, so Spark builds and broadcasts it once
    and reuses it, however many classes are looked up.
    """
    known = _shared.setdefault(vmap, {})
    if by not in known:
        part = vmap
        key = F.concat(F.col(CLASS), F.lit(_SEP), F.coalesce(F.col(by), F.lit(_NULL)))
        known[by] = part.groupBy(key.alias("_key")).agg(F.min(TARGET).alias("_target"))
    return known[by]


def entries(vmap: DataFrame, cls: str | list[str], keys: dict[str, Column], take: dict[str, str],
            where: Column | None = None) -> DataFrame:
    """One row per key of one map class; among several the least taken values win."""
    part = vmap.where(F.col(CLASS).isin(cls if isinstance(cls, list) else [cls]))
    if where is not None:
        part = part.where(where)
    named = part.select(*[e.alias(k) for k, e in keys.items()],
                        *[F.col(s).alias(o) for o, s in take.items()])
    outs = list(take)
    if len(outs) == 1:
        return named.groupBy(*keys).agg(F.min(outs[0]).alias(outs[0]))
    picked = named.groupBy(*keys).agg(F.min(F.struct(*outs)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{o}").alias(o) for o in outs])


def lookup(
    df: DataFrame,
    vmap: DataFrame,
    cls: str | Column,
    key: str | Column,
    out: str,
    by: str = SOURCE,
    default: str | None = None,
    null_safe: bool = False,
    how: str = "left",
    take: dict[str, str] | None = None,
) -> DataFrame:
    """Translate ``key`` by one class of the map into column ``out``; a column of classes names one for each row.

    The map key is text, so the fact key is cast to text. ``null_safe`` lets a NULL key find
    the map row with a NULL key. Every key gives one row, so facts are never multiplied.
    """
    k, small, probe = f"_k_{out}", is_small(vmap), as_column(key).cast("string")
    if take is None:
        dim = all_entries(vmap, by).select(F.col("_key").alias(k), F.col("_target").alias(out))
        code = F.coalesce(probe, F.lit(_NULL)) if null_safe else probe
        head = F.lit(cls + _SEP) if isinstance(cls, str) else F.concat(cls, F.lit(_SEP))
        res = attach(df, dim, [(F.concat(head, code), k)], how, small=small)
    else:
        dim = entries(vmap, cls, {k: F.col(by)}, take, F.col(by).isNotNull())
        res = attach(df, dim, [(probe, k)], how, small=small)
    if default is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return res


def lookup_pair(df: DataFrame, vmap: DataFrame, cls: str, first: str | Column, second: str | Column,
                take: dict[str, str]) -> DataFrame:
    """Lookup on two keys: the source code and the value code of a map row."""
    tag = next(iter(take))
    a, b = f"_a_{tag}", f"_b_{tag}"
    dim = entries(vmap, cls, {a: F.col(SOURCE), b: F.col(VALUE)}, take,
                  F.col(SOURCE).isNotNull() & F.col(VALUE).isNotNull())
    return attach(df, dim, [(as_column(first).cast("string"), a), (as_column(second).cast("string"), b)],
                  small=is_small(vmap))


def substrings(df: DataFrame, text: str, out: str) -> DataFrame:
    """Every non-empty substring of a short text, one per row."""
    n = F.length(text)
    starts = df.where(n > 0).withColumn("_s", F.explode(F.sequence(F.lit(1), n)))
    ends = starts.withColumn("_l", F.explode(F.sequence(F.lit(1), n - F.col("_s") + 1)))
    return ends.withColumn(out, F.substring(F.col(text), F.col("_s"), F.col("_l"))).drop("_s", "_l")


def lookup_contained(df: DataFrame, vmap: DataFrame, cls: str, text: Column, out: str, by: str,
                     take: dict[str, str] | None = None, fold: bool = True,
                     where: Column | None = None) -> DataFrame:
    """Find the map entry whose text *contains* the fact text (not the other way round).

    Where all substrings of the class's texts fit the broadcast bound, they are laid out once and "contains" is an
    equality; their size grows with the third power of the lengths and is known from one aggregate per map.
    Beyond the bound the distinct fact texts go through an index of the map's q-grams (:func:`contained`), whose
    size grows with the texts. No pair of a fact and a map row is tested either way. Empty fact texts find nothing.
    """
    k = f"_k_{out}"
    src = F.lower(F.col(by)) if fold else F.col(by)
    part = vmap.where(F.col(CLASS) == cls)
    if where is not None:
        part = part.where(where)
    wanted = take or {out: TARGET}
    texts = part.select(src.alias("_t"), *[F.col(s).alias(o) for o, s in wanted.items()]).where(F.length("_t") > 0)
    probe = F.lower(text) if fold else text
    if class_bytes(vmap, cls, by) <= setting(vmap.sparkSession, "BROADCAST_BYTES"):
        return attach(df, least_row(substrings(texts, "_t", k).drop("_t"), k, list(wanted)), [(probe, k)], small=True)
    found = contained(df.select(probe.alias(k)).where(F.length(k) > 0).distinct(), texts, k, list(wanted))
    return join_spread(df, found, probe, k, "left").drop(k)


def least_row(df: DataFrame, key: str, outs: list[str]) -> DataFrame:
    """One row per key: the least of its other columns together."""
    return df.groupBy(key).agg(F.min(F.struct(*outs)).alias("_row")).select(key, *[F.col(f"_row.{o}").alias(o) for o in outs])


#: Length of the index's grams.
GRAM = 3


def grams(df: DataFrame, text: str, out: str, length: int = GRAM) -> DataFrame:
    """The different grams of a text, one per row; texts shorter than a gram give none."""
    places = F.sequence(F.lit(1), F.length(text) - length + 1)
    return df.where(F.length(text) >= length).withColumn(out, F.explode(F.array_distinct(
        F.transform(places, lambda n: F.substring(F.col(text), n, F.lit(length))))))


def contained(probes: DataFrame, texts: DataFrame, key: str, outs: list[str]) -> DataFrame:
    """For each probe that some text (column ``_t``) contains: the least row of those texts.

    The texts' q-grams are an inverted index. A probe is looked up by the one of its grams that fewest texts
    hold; only those texts are tested. A probe with a gram that no text holds is out at once. Probes shorter than a
    gram are grams of their own length. Everything is as large as the texts and probes, or as the tested pairs.
    """
    one = texts.groupBy("_t").agg(F.min(F.struct(*outs)).alias("_row")).withColumn("_tid", F.xxhash64("_t"))
    index = grams(one.select("_t", "_tid"), "_t", "_g").select("_g", "_tid")
    held = index.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    asked = grams(probes, key, "_g").join(held, "_g", "left").groupBy(key).agg(
        F.min(F.struct("_n", "_g")).alias("_rarest"), F.count_if(F.col("_n").isNull()).alias("_absent"))
    asked = asked.where("_absent = 0").select(key, F.col("_rarest._g").alias("_g"))
    # two texts of one hash only make one more pair to test
    pairs = asked.join(index, "_g").join(one, "_tid").where(F.col("_t").contains(F.col(key))).select(key, "_row")
    for length in range(1, GRAM):
        pairs = pairs.unionByName(probes.where(F.length(key) == length).join(grams(one, "_t", "_g", length), F.col(key) == F.col("_g")).select(key, "_row"))
    return pairs.groupBy(key).agg(F.min("_row").alias("_row")).select(key, *[F.col(f"_row.{o}").alias(o) for o in outs])


def _laid_out(text: Column) -> Column:
    """Bytes that :func:`substrings` makes of some texts: a text of n characters has n - l + 1 substrings of
    length l, which come with some 80 bytes of row each."""
    n = F.length(text).cast("double")
    return F.coalesce(F.sum(n * (n + 1) * (n + 2) / 6 + 80 * n * (n + 1) / 2), F.lit(0.0))


def laid_out_bytes(part: DataFrame, text: Column) -> int:
    """What laying out some texts would take; one row is fetched from one pass over them."""
    return int(part.agg(_laid_out(text)).first()[0])


_class_bytes: WeakKeyDictionary[DataFrame, dict[tuple[str, str], int]] = WeakKeyDictionary()


def class_bytes(vmap: DataFrame, cls: str, by: str) -> int:
    """The same for one class of a map. One pass tells all classes and columns, once per map."""
    if vmap not in _class_bytes:
        texts = [c for c in (SOURCE, LABEL, DESCRIPTION) if c in vmap.columns]
        sums = vmap.groupBy(CLASS).agg(*[_laid_out(F.col(c)).alias(c) for c in texts]).collect()  # one row per class
        _class_bytes[vmap] = {(r[CLASS], c): int(r[c]) for r in sums for c in texts}
    return _class_bytes[vmap].get((cls, by), 0)


_slices: WeakKeyDictionary[DataFrame, dict[tuple, DataFrame]] = WeakKeyDictionary()


def dictionary_slice(dictionary: DataFrame, vocabularies: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Rows of the concept dictionary of some vocabularies that pass a test.

    A filter does not shrink the planned size of a scan, so a few rows of a large dictionary would be planned like all of
    it. A large dictionary is therefore written once more, clustered by vocabulary; each slice is cut from the
    folders of its vocabularies, once, and its true size is counted while it is written. A slice of a small
    dictionary is small, and stays a plain filter.
    """
    def cut(rows: DataFrame) -> DataFrame:
        part = rows.where(F.col("vocabulary_id").isin(vocabularies)) if vocabularies else rows
        return part if where is None else part.where(where)

    if (not vocabularies and where is None) or is_small(dictionary):
        return cut(dictionary)
    known = _slices.setdefault(dictionary, {})
    if () not in known:
        known[()] = staged(dictionary, "dictionary", by="vocabulary_id")
    key = (tuple(sorted(vocabularies or [])), str(where))
    if key not in known:
        known[key] = counted(cut(known[()]).select(*dictionary.columns))
    return known[key]


def counted(part: DataFrame) -> DataFrame:
    """A part of the dictionary, written once; its bytes in memory are counted while it is written."""
    seen = Observation()
    widths = reduce(Column.__add__, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in part.columns], F.lit(32))
    slice_ = staged(part.observe(seen, F.coalesce(F.sum(widths), F.lit(0)).alias("bytes")), "slice")
    return measured(slice_, max(1, int(seen.get["bytes"])))


def named_concepts(dictionary: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows of the concept dictionary that some facts name by id.

    Facts of one kind name few of the concepts of a large dictionary; those are found by one pass over the key column and
    are broadcast where they fit, so that the facts need not move. ``facts`` is read twice: a scan, not a plan.
    """
    if is_small(dictionary):
        return dictionary
    ids = facts.select(F.col(key).alias("_named")).where("_named is not null").distinct()
    return counted(dictionary.join(ids, F.col("concept_id") == F.col("_named"), "left_semi").select(*dictionary.columns))


def concepts(dictionary: DataFrame, take: dict[str, str], vocabularies: list[str] | None = None,
             where: Column | None = None, key: str = "concept_id") -> DataFrame:
    """Slice of the concept dictionary: renamed columns, restricted vocabulary."""
    part = dictionary_slice(dictionary, vocabularies, where)
    taken = part.select(F.col(key).alias(f"_c_{next(iter(take))}"), *[F.col(s).alias(o) for o, s in take.items()])
    return measured(taken, planned_bytes(part))


def concept_lookup(
    df: DataFrame,
    dictionary: DataFrame,
    key: str | Column,
    take: dict[str, str],
    vocabularies: list[str] | None = None,
    where: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Join facts to the dictionary by concept id; ``take`` maps new names to its columns."""
    return attach(df, concepts(dictionary, take, vocabularies, where), [(as_column(key), f"_c_{next(iter(take))}")], how)


def codes_of(dictionary: DataFrame, out: str, vocabularies: list[str] | None = None,
             where: Column | None = None) -> DataFrame:
    """Distinct concept codes of a vocabulary, as a membership set."""
    part = dictionary_slice(dictionary, vocabularies, where)
    return measured(part.select(F.col("concept_code").alias(out)).distinct(), planned_bytes(part))


def crosswalk(left: DataFrame, left_key: str, edges: DataFrame, relationship: str, right: DataFrame,
              right_key: str) -> DataFrame:
    """One hop through the concept graph: left → edge of one kind → right.

    ``left_key`` and ``right_key`` name id columns of the two slices; both stay in the result.
    """
    hop = edges.where(F.col("relationship_id") == relationship).select(
        F.col("concept_id_1").alias("_from"), F.col("concept_id_2").alias("_to"))
    return (left.join(hop, F.col(left_key) == F.col("_from"))
            .join(right, F.col("_to") == F.col(right_key)).drop("_from", "_to"))
