"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch that goes to a Python worker, where the session sets none: Spark's own bound is rows, whatever their size.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def word_count(text: str | Column) -> Column:
    """Number of words, 0 for null; no list of words is built."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # one mark per word is left: every run of other characters becomes one letter, then blanks go
    return F.length(F.regexp_replace(F.regexp_replace(text, WORD, "w"), r"[\x20\x09-\x0D]+", "")).cast("long")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of this session by their bytes, unless it has a bound of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def appended(df: DataFrame, column: str, compute: Callable[[pa.Array], pa.Array | list[pa.Array]], added: T.StructType) -> DataFrame:
    """Append what ``compute`` makes of one column, batch by batch, on the partitions as they are.

    Columns of the input keep their values; one whose name equals an added one (in any case) is
    replaced. A batch is cut so that its values stay within a few MB, whatever the row sizes; a column that
    stays is sent once.
    """
    bounded_batches(df.sparkSession)
    new = {f.name.lower() for f in added}
    kept = [c for c in df.columns if c.lower() not in new]
    source = [F.col(f"`{c}`") for c in kept]
    stays = column in kept
    at = kept.index(column) if stays else len(kept)
    if not stays:
        source.append(F.col(f"`{column}`").alias("_input_" + "_" * max(map(len, [*df.columns, ""]))))
    schema = T.StructType([*[f for f in df.schema if f.name in kept], *added])
    arrow = [T_to_arrow(f) for f in added]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in sliced(part):
                got = compute(piece.column(at))
                got = got if isinstance(got, list) else [got]
                got = [g.cast(t) if g.type != t else g for g, t in zip(got, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:len(kept)], *got], [*kept, *[f.name for f in added]])
        pa.default_memory_pool().release_unused()  # the worker is used again

    return df.select(*source).mapInArrow(run, schema)


def sliced(part: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes, one row at least."""
    if part.num_rows == 0:
        return
    step = max(1, part.num_rows * most // max(part.nbytes, 1))
    for at in range(0, part.num_rows, step):
        yield part.slice(at, step)


def T_to_arrow(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(field.dataType)
