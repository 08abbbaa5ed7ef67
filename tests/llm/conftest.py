import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, score string, node string, kept int"


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Documents with nulls, empty and blank texts, repeated rows, a long text and columns named like results."""
    passage = " ".join(f"word{i} of the passage" for i in range(40))
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong and bitter potion tonight "
    rows = [
        (1, None, "a", "x", "n", 1), (2, "", "a", "x", "n", 1), (3, " \n\t ", None, None, None, None),
        (4, base * 3, "b", "x", "n", 1), (4, base * 3, "b", "x", "n", 1), (5, base * 3, "b", "y", None, 2),
        (None, base * 3 + "x", "c", "x", "n", 1), (None, "One", None, "x", "n", 1), (6, "one", "c", "x", "n", 1),
        (7, "Été à la plage, " * 3 + passage, "c", "x", "n", 1), (8, passage + " naïve ending " + passage, "a", "x", "n", 1),
        (9, "Licensed under CC BY-NC 4.0.\n" + base, "a", "x", "n", 1), (10, "\x0b\x0c x\x1fy ▁ z<|endoftext|>", "a", "x", "n", 1),
        (11, "lorem ipsum " * 40_000, "long", "x", "n", 1), (12, "".join(chr(0x4E00 + i % 500) for i in range(3000)), "long", "x", "n", 1),
    ]
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(odd):
    """The odd documents as plain rows."""
    return [tuple(r) for r in odd.select("doc_id", F.coalesce("text", F.lit(""))).collect()]
