import pytest

# Names that operators use themselves, to clash with.
DOCS = "doc_id long, text string, lang string, source string, row string, size int, kept string, taken int, stratum int"

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "one",
    "One  TWO",
    "é 中文 👍  x",
    "a b c d e f g",
    "a b c d  e\nf g",
    "a b c d  e\nf g",
    "<|im_end|> <\\|x # $ %",
    LONG,
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [(i, text, "en", f"s{i % 3}", "r", 1, "k", 2, 3) for i, text in enumerate(EDGE_TEXTS)]
    rows += [rows[6], (None, "a b c d e f g", None, None, None, None, None, None, None), (99,) + (None,) * 8]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest tables, as pandas."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
