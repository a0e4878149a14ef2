"""Exact top-k inner products by MaxScore.

Dimensions are the terms, an integer vector's entries its scores. Queries and candidates are dealt over a
grid of cells by hashes, each cell holding one group of queries and one shard of candidates of bounded
size. In a cell every term has the largest product that any candidate of the shard can reach with the
query. Terms are taken in falling order of that bound. This is a dense variant: there are no postings and
no split of essential terms; every candidate is scored on the first terms, and only those whose partial sum
and the bounds of the rest could still reach the k-th score are scored in full. The k best of each shard
are merged per query.

Defined cases: a row without an id, or whose vector is null, empty or holds a null, a NaN or an infinity takes no part; vectors
of other lengths count as padded with zeros; of the candidates only the query's own row is left out, so a copy of it
and other rows under its id are candidates like any; every copy of a query row gives its answer; an empty table gives no rows.
Equal rows are held once with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 5
SCALE = 256
EVERY = 50
#: Rows of a shard and of a group of queries, on average, and candidates scored at a time.
SHARD_ROWS = 16_384
GROUP_ROWS = 2_048
STEP = 4_096
#: Terms are traversed in slices of so many.
SLICE = 8


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Ids with floor(scale * x) of each entry; rows with an entry that is no number are dropped."""
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{vec_id}`").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0))
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * float(scale))).alias("v"))


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``width``."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out[rows, np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids."""
    order = np.lexsort((ids, ~scores))[:k]
    return scores[order], ids[order]


def max_score(query: np.ndarray, own: int | None, columns: np.ndarray, ids: np.ndarray, high: np.ndarray, low: np.ndarray, k: int,
              copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k best candidates of one shard for one query.

    ``columns[d]`` are the scores of term d by candidate; ``high`` and ``low`` its extremes; ``copies`` the rows that
    each candidate stands for, 1 if not given; ``own`` the place of the query's own row, which counts once less.
    """
    bounds = np.maximum(query * high, query * low)
    spread = np.abs(query) * (high - low)
    terms = np.argsort(-spread, kind="stable")
    # beyond 64 bits bounds say nothing: every candidate is scored in full then
    bounded = np.abs(query.astype(float)) @ np.maximum(np.abs(high.astype(float)), np.abs(low.astype(float))) < 2.0 ** 62
    # most that the terms from place t on can add
    tail = np.concatenate([np.cumsum(bounds[terms][::-1])[::-1], [0]])
    top, who = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(ids), STEP):
        rows = np.arange(at, min(at + STEP, len(ids)))
        if own is not None and at <= own < at + STEP and (copies is None or copies[own] == 1):
            rows = rows[rows != own]
        part = np.zeros(len(rows), np.int64)
        for t in range(0, len(terms), SLICE):
            if len(top) == k and bounded:
                alive = part + tail[t] >= top[-1]  # an equal score may still win by its id
                if not alive.all():
                    rows, part = rows[alive], part[alive]
                    if not len(rows):
                        break
            some = terms[t:t + SLICE]
            part += query[some] @ columns[np.ix_(some, rows)]
        if len(rows):
            found = ids[rows]
            if copies is not None:
                times = np.minimum(copies[rows] - (rows == (-1 if own is None else own)), k)
                part, found = np.repeat(part, times), np.repeat(found, times)
            top, who = best(np.concatenate([top, part]), np.concatenate([who, found]), k)
    return top, who


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The k best candidates (``vec_id``, ``v``) of every query: query_id, rank, vec_id, score.

    Both counts only set the grid. Queries are copied once per shard, candidates once per group of
    queries, so the work is the stated queries against all rows and no cell outgrows its share. A query's own row is the
    candidate with its id and vector, if there is one.
    """
    counted = F.count(F.lit(1)).alias("copies")
    asked, held = queries.groupBy("vec_id", "v").agg(counted), candidates.groupBy("vec_id", "v").agg(counted)
    shards = max(1, -(-candidates.count() // shard_rows))
    groups = max(1, -(-asked.count() // group_rows))
    key = F.xxhash64("v", "vec_id")
    left = (asked.withColumn("query_no", key).withColumn("grp", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    right = (held.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
             .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))

    def cell(asked: pa.Table, held: pa.Table) -> Iterator[pa.RecordBatch]:
        if asked.num_rows and held.num_rows:
            asked, held = asked.combine_chunks(), held.combine_chunks()
            lengths = [np.diff(t.column("v").chunk(0).offsets.to_numpy()) for t in (asked, held)]
            width = max(map(max, lengths))
            wanted, scores = matrix(asked.column("v").chunk(0), width), matrix(held.column("v").chunk(0), width)
            ids, copies = held.column("vec_id").to_numpy(), held.column("copies").to_numpy()
            copies = None if (copies == 1).all() else copies
            columns, high, low = np.ascontiguousarray(scores.T), scores.max(0), scores.min(0)
            places: dict[int, list[int]] = {}
            for place in np.flatnonzero(np.isin(ids, asked.column("vec_id").to_numpy())).tolist():
                places.setdefault(int(ids[place]), []).append(place)
            out = [[], [], [], [], []]
            for i, (no, own, times, query) in enumerate(zip(*[asked.column(c).to_pylist() for c in ("query_no", "vec_id", "copies")], wanted, strict=True)):
                mine = next((p for p in places.get(own, ()) if lengths[0][i] == lengths[1][p] and (scores[p] == query).all()), None)
                top, who = max_score(query, mine, columns, ids, high, low, k, copies)
                for values, new in zip(out, ([no] * len(top), [own] * len(top), [times] * len(top), who.tolist(), top.tolist()), strict=True):
                    values.extend(new)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], _PARTS.names)

    parts = left.groupBy("grp", "shard").cogroup(right.groupBy("grp", "shard")).applyInArrow(
        lambda a, b: pa.Table.from_batches(list(cell(a, b)), _PARTS), "query_no long, query_id long, copies long, vec_id long, score long")
    # at most k rows per shard and query are left
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("query_id", "rank", "vec_id", "score")


_PARTS = pa.schema([(c, pa.int64()) for c in ("query_no", "query_id", "copies", "vec_id", "score")])


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other rows for every 50th row."""
    rows = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(rows.where(F.col("vec_id") % EVERY == 0), rows)


OP9_SQL = f"""with v as (select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {EVERY} = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= {K}"""
