import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, row string, features string, ids string, base string, key string, _row long"
BASE = "the committee met on monday to discuss the new budget for the coming year and agreed on most of the points that were raised"


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), -1, -2.0, "own", "own", "own", "own", "own", -3)


def texts():
    """Nulls, empty and long texts, copies, near copies, ties and repeated rows; columns that operators use inside."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    made = [
        (1, BASE, "a"), (2, BASE.upper(), "b"), (3, BASE + " today", "a"), (4, None, "a"), (5, "", "c"), (6, "   \t\n", None),
        (7, long, "a"), (8, "x " + long, "b"), (9, "one two", "a"), (None, BASE, "a"), (None, None, None), (9, "one two", "a"),
        (10, "straße ÉCOLE İstanbul Σίσυφος don't!! 12.5€ 😀", "b"), (11, "Released under the MIT License. CC-BY 4.0, Apache License, Version 2.0", "a"),
        (12, BASE + " and later " + BASE, "ü"), (13, "<|endoftext|> a<|startoftext|>b", "a"),
    ]
    return made + [(100 + i, f"{BASE} number {i % 3}", "hot") for i in range(40)]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame([document(*t) for t in texts()], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
