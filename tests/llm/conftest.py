import pytest

#: Texts that every operator must take: null, empty, blank, repeated, without letters, long, other scripts.
HARD = [
    (1, "The cat sat on the mat, and it's 42 cats!", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n ", "de", "b"),
    (5, "The cat sat on the mat, and it's 42 cats!", "en", "a"),
    (6, "*** 123 ### !!!", None, "b"),
    (7, "Überraschung straße ÉTÉ l'eau ﬁn <|endoftext|> ΑΣ Ⅷ ǅ é x y z İ\x85k", "fr", "c"),
    (8, "la palabra y el camino de los árboles " * 3000, "es", "b"),
    (None, "row without an id", "en", None),
    (1, "The cat sat on the mat, and it's 42 cats!", "en", "a"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Hard rows, with extra columns whose names clash with names that operators use inside."""
    rows = [(*r, i, "x") for i, r in enumerate(HARD)]
    schema = "doc_id long, text string, lang string, source string, length int, shard string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "*", "length AS n", "shard AS piece", "length AS bucket", "shard AS score", "length AS rank", "shard AS words"
    )


@pytest.fixture(scope="session")
def nothing(hard):
    return hard.where("false")
