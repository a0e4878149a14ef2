"""How a small side meets a large one: broadcast below a checked bound, salted beyond it."""

from __future__ import annotations

from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bound of a broadcast in planned bytes, copies of a larger dimension, and places for rows without a key. A
# session may set others under the names in SETTINGS.
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
NULL_SALTS = 64
# Keys cut from a large table are planned by their part of its compressed files; broadcast, they take some eighteen times
# as much (600,000 ids: 67 MB). The bound is divided by this for them.
KEY_ROOM = 16
SETTINGS = {"BROADCAST_BYTES": "spark.cliniform.broadcastBytes", "SALTS": "spark.cliniform.joinSalts", "NULL_SALTS": "spark.cliniform.nullSalts"}


def setting(spark: SparkSession, name: str) -> int:
    """A session's own value of a bound, else the module's."""
    return int(spark.conf.get(SETTINGS[name], str(globals()[name])))

_sizes: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the plans count on; nothing here is tied to a data size."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        spark.conf.set(key, value)
    return spark


def measured(df: DataFrame, size: int) -> DataFrame:
    """A frame whose size in memory is known; it is planned by it."""
    _sizes[df] = size
    return df


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's upper estimate of the size of a plan (no job is run)."""
    if df not in _sizes:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        _sizes[df] = int(str(stats.sizeInBytes()))
    return _sizes[df]


def fixed_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals, as a local relation whose size Catalyst knows."""
    fields = [f.strip().split(" ") for f in schema.split(",")]

    def text(v: object) -> str:
        if v is None:
            return "null"
        if isinstance(v, (bool, int)):
            return str(v).lower()
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{n}`" for n, _ in fields)
    return spark.sql(f"select {', '.join(f'cast(`{n}` as {t}) as `{n}`' for n, t in fields)} from values {body} as t({names})")


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    return planned_bytes(df) <= (setting(df.sparkSession, "BROADCAST_BYTES") if limit is None else limit)


def are_few(keys: DataFrame) -> bool:
    """Whether the keys of a scanned table may be broadcast."""
    return is_small(keys, setting(keys.sparkSession, "BROADCAST_BYTES") // KEY_ROOM)


def join_spread(left: DataFrame, right: DataFrame, key: Column, right_key: str, how: str) -> DataFrame:
    """Join on a key that many left rows lack: those find nothing, so each is sent to one of several places
    by its own ids instead of all to the place of NULL. Columns of the right side stay, but for the mark."""
    absent = F.lit(1) + spread_over(left, setting(left.sparkSession, "NULL_SALTS"))
    marked = left.withColumn("_place_l", F.when(key.isNull(), absent).otherwise(F.lit(0)).cast("bigint"))
    # zero for every row, but computed: the optimiser would turn a literal into a filter and drop it from the join key
    others = right.withColumn("_place_r", F.pmod(F.xxhash64(right_key), F.lit(1)))
    return marked.join(others, (key == F.col(right_key)) & (F.col("_place_l") == F.col("_place_r")), how).drop("_place_l", "_place_r")


def spread_over(df: DataFrame, salts: int, but: set[str] = frozenset()) -> Column:
    """Salt of a row, from its own ids, so that a repeated task gives the same salt."""
    ids = [c for c in df.columns if c.endswith("id") and not c.endswith("concept_id") and c not in but]
    return F.pmod(F.xxhash64(*[F.col(c) for c in (ids or df.columns)]), F.lit(salts))


def splits_hot_keys(spark: SparkSession) -> bool:
    """Whether the adaptive engine splits the parts of hot keys in every join."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin")
    return all(spark.conf.get(n).lower() == "true" for n in names)


def attach(
    fact: DataFrame,
    dim: DataFrame,
    on: list[tuple[Column, str]],
    how: str = "left",
    null_safe: bool = False,
    residual: Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join a large side to a dimension with at most one row per key.

    ``on`` pairs a fact expression with a dimension column; the dimension columns are dropped.
    A dimension whose planned size is under the bound is broadcast, so the fact does not move.
    Beyond it both sides are shuffled by the key, and the dimension once: the adaptive engine sees the sizes of the
    shuffled parts and splits those of hot keys, while rows without a key are spread by their ids. Where the session
    has no adaptive skew handling, the dimension is copied once per salt and joined on key + salt (see ``SETTINGS``).
    """
    keys = [k for _, k in on]
    fits = is_small(dim) if small is None else small
    left = fact
    if fits:
        right, pairs = F.broadcast(dim), on
    elif splits_hot_keys(dim.sparkSession):
        right, pairs = dim, on
        if not null_safe:
            lacking = reduce(Column.__or__, [e.isNull() for e, _ in on])
            place = F.when(lacking, F.lit(1) + spread_over(fact, setting(dim.sparkSession, "NULL_SALTS"))).otherwise(F.lit(0)).cast("bigint")
            left = fact.withColumn("_salt_f", place)
            # zero for every row, but computed: the optimiser would drop a literal from the join key
            right = dim.withColumn("_salt_d", F.pmod(F.xxhash64(*keys), F.lit(1)))
            pairs = [*on, (F.col("_salt_f"), "_salt_d")]
    else:
        count = setting(dim.sparkSession, "SALTS")
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))
        right = dim.withColumn("_salt_d", F.explode(salts))
        left = fact.withColumn("_salt_f", spread_over(fact, count))
        pairs = [*on, (F.col("_salt_f"), "_salt_d")]
    cond: Column | None = None
    for expr, key in pairs:
        test = expr.eqNullSafe(F.col(key)) if null_safe and key != "_salt_d" else expr == F.col(key)
        cond = test if cond is None else cond & test
    if residual is not None:
        cond = cond & residual
    return left.join(right, cond, how).drop(*keys, "_salt_f", "_salt_d")
