import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur " * 20_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties."""
    rows = [(1, "the cat sat on the mat and the dog ran to the park", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
            (4, " \t\n ", "xx", "b", 4), (5, LONG, "en", "a", len(LONG)), (None, "no id here but some words", "en", None, 9),
            (1, "the cat sat on the mat and the dog ran to the park", "en", "a", 1), (7, "password=abcdef123456 oké 日本 <|endoftext|>", "de", "b", 3)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


def saved(spark, tmp_path, **tables):
    """Folder with the given rows as tables, (schema, rows) each."""
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
