import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return docs.orderBy("doc_id").collect()


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, block long, n long, token string, "
          "bucket long, _id long, pattern int, score double, ids binary, stratum string, mix_shard long")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"word{k % 977} and{k % 13} thing{k}" for k in range(40_000))
    texts = [None, "", "  \t\n ", "one", "one", "two words", "a b c", "a  b\nc", "A B C", long, long + " end",
             "\n\nx\n", "tab\tand\x0bother\x0cspaces here", "é ü ß 日本 语", "same text of five words", "same text of five words",
             "<|endoftext|> special <|endoftext|>", " ".join(["repeat"] * 300)]
    out = [(k, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}") for k, t in enumerate(texts)]
    out += [out[9], out[3]]
    more = (None, 7, 8, 9, "t", 10, 11, 12, 0.5, b"x", "st", 13)
    return spark.createDataFrame([(*row, *more) for row in out], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
