"""BPE encoding, decoding and token counting of whole text columns."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import json_encoder, rank_tokens, ranks_encoder
from .common import appended, table

RANKS = "byte_bpe_50k.tiktoken"
JSON = "byte_bpe_50k.json"
#: Context length that ``over_limit`` and ``fit_chars`` answer for.
LIMIT = 512


def encode(df: DataFrame, text: str = "text", out: str = "token_ids", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, checked: bool = False) -> DataFrame:
    """Append the ids of every whole text as an array of ints; a null text counts as empty (no ids).

    With ``checked`` the ids are decoded too, and a text that they do not give back stops the run.
    No rows move: the vocabulary is read once per worker from ``path``, a file every worker has.
    """
    path = path or public_tokenizers.path(RANKS)

    def ids(texts: pa.Array) -> pa.Array:
        encoder, tokens = ranks_encoder(path, pattern), rank_tokens(path) if checked else []
        flat: list[int] = []
        offsets = np.zeros(len(texts) + 1, np.int32)
        for n, t in enumerate(texts, 1):
            if t.is_valid:
                one = t.as_py()
                found = encoder.encode(one)
                if checked and b"".join([tokens[i] for i in found]) != one.encode():
                    raise ValueError(f"the token ids of a text of {len(one)} characters do not decode to it")
                flat += found
            offsets[n] = len(flat)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter(flat, np.int32, len(flat))))

    return appended(df, text, ids, T.StructType([T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ids: str = "token_ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Append the bytes of every list of ids; a null list gives no bytes."""
    path = path or public_tokenizers.path(RANKS)

    def raw(lists: pa.Array) -> pa.Array:
        tokens = rank_tokens(path)
        # one row's ids at a time become Python numbers
        rows = (x.values.to_numpy().tolist() if x.is_valid else [] for x in lists)
        return pa.array([b"".join([tokens[i] for i in ids]) for ids in rows], pa.binary())

    return appended(df, ids, raw, T.StructType([T.StructField(out, T.BinaryType())]))


def count_tokens(df: DataFrame, text: str = "text", limit: int = LIMIT, path: str | None = None,
                 pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Append ``token_count`` of every whole text (null: empty, 0) and ``fit_chars``, the characters that
    fit a budget of ``limit`` tokens, both read off the text's prefix table."""
    path = path or public_tokenizers.path(JSON)

    def counted(texts: pa.Array) -> list[pa.Array]:
        encoder = json_encoder(path, pattern)
        totals, fits = [], []
        for t in texts.to_pylist():
            prefix = encoder.table(t or "")
            totals.append(prefix.total)
            fits.append(prefix.fit(limit))
        return [pa.array(totals, pa.int64()), pa.array(fits, pa.int64())]

    return appended(df, text, counted, T.StructType([T.StructField("token_count", T.LongType()),
                                                     T.StructField("fit_chars", T.LongType())]))


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")).cast("binary"), 256)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the 50k ranks, and the bytes they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs).drop("text"))
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), ids_digest(F.col("token_ids")).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(docs).select("doc_id", "n_bytes", F.col("token_count").alias("n_tokens"),
                                     (F.col("token_count") > LIMIT).alias("over_limit"), "fit_chars")
