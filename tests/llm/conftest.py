import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with NULLs, empty and very long texts, ties and copies, and
    columns whose names clash with working columns of the operators."""
    prose = "the quick brown fox jumps over a lazy dog and runs far away from it"
    rows = [
        (1, "Hello world, it's fine.\n\n  two  spaces\tand tabs 12345 <|endoftext|>", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "é" * 3000 + " naïve façade 東京 🙂 \x85 x", "fr", "b", 2),
        (5, " ".join(f"w{i % 700}" for i in range(6000)), "en", "b", 3),
        (6, prose, "en", "a", 4), (7, prose, "en", "a", 4), (8, prose, "en", "c", 4),
        (9, "   \n\t ", "en", "a", 5),
        (11, "it was a stupid idiot,trash;loser clown!!", "en", "a", 6),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("n", "ids", "at", "part", "id", "h", "score", "text_1", "piece"):
        df = df.withColumn(c, df["source"])
    return df.repartition(3, "doc_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
