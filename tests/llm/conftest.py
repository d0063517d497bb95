import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASH = ["row", "file", "at", "shard", "score", "clean", "gone", "h", "size", "digest", "keep", "s"]


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """Makes a scan of written documents from (doc_id, text, lang, source) rows, with columns
    whose names clash with the operators' own."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in CLASH:
            df = df.selectExpr("*", f"'own {name}' AS `{name}`")
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        df.coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and blank texts, ties, repeated rows and a long text."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    plain = "The cat sat on the mat and looked at the moon for a while."
    return documents(
        [
            (1, plain, "en", "a"),
            (1, plain, "en", "a"),
            (2, None, "en", None),
            (3, "", None, "b"),
            (4, " \n\t\n", "en", "b"),
            (None, plain, "en", "c"),
            (5, long, "en", "c"),
            (6, plain.upper(), None, "a"),
            (7, "Un deux\nÉtude 🙂 \u0000 ﬁn", "fr", "b"),
            (8, "12345 67 ---", "fr", "b"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([(0, "x", "en", "a")]).where("doc_id > 0")
