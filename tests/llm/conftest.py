import pytest



@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names the operators use."""
    long = " ".join(f"word{i % 7919} of{i % 13} text" for i in range(40_000))
    base = "one two three four five six seven eight nine ten " * 8
    rows = [
        (1, "alpha beta gamma delta epsilon", "en", "s1"),
        (2, "alpha  beta\tgamma delta\nepsilon", "en", "s1"),
        (3, None, "en", "s1"),
        (4, "", None, "s2"),
        (5, " \t\n ", "en", None),
        (6, long, "en", "s2"),
        (6, long, "en", "s2"),
        (7, long + " tail", "en", "s2"),
        (8, base, "de", "s1"),
        (9, base, "de", "s1"),
        (None, base, "de", "s1"),
        (None, None, None, None),
        (10, "solo", "fr", "s3"),
        (11, "漢字 😀 mixed é text", "zh", "s3"),
    ]
    names = "kept key size part fp norm id ids n copies n_tokens without_id mixed_id cluster source_size lower"
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(n).alias(n) for n in names.split()))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
