import pytest

#: Nulls, blanks, ties, repeated rows, rows without id, and a very long text.
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (None, "some text without id here"), (4, "a"), (4, "a"), (5, "word of a long text " * 30_000), (6, "é\U0001f600 日本 ΑΣ Σ\x00 <|endoftext|> x"), (7, "secret: token: abcdefgh password = 'abcdef'"), (8, "one two three four five six seven"), (9, "One two three four five SIX seven"), (10, "x" * 5000)]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), 1, 2.0, "k") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score double, own string").repartition(3)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
