"""What goes to the Python workers."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliniform.llm import common, simhash


def test_batches_are_bounded_by_bytes_and_hold_a_text_once(spark):
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))

    def whole(texts: pa.Array) -> pa.Array:
        return pa.array([texts.buffers()[2].size] * len(texts), pa.int64())  # of the batch that the piece was cut from

    found = common.appended(docs, "text", whole, T.StructType([T.StructField("held", T.LongType())]))
    assert found.columns == ["doc_id", "text", "held"]
    row = found.agg(F.max("held"), F.count("*"), F.min(F.length("text"))).first()
    assert row[0] <= 2 * common.BATCH_BYTES and row[1:] == (6000, 5000)
    marked = simhash.fingerprints(docs, out="bits")
    sent = marked._jdf.queryExecution().analyzed().toString().split("MapInArrow")[1].splitlines()[1]
    assert sent.count("text") == 1 and "cast" not in sent, sent


def test_a_replaced_column_is_still_read(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id int, text string")
    found = common.appended(docs, "text", lambda t: pa.array([x.as_py() and x.as_py()[::-1] for x in t], pa.string()), T.StructType([T.StructField("text", T.StringType())]))
    assert sorted(map(tuple, found.collect())) == [(1, "ba"), (2, None)]
