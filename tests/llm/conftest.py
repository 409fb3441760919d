import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


#: rows with every awkward case: null and empty texts, null ids, repeated
#: rows, ties, a very long text, unusual white space and characters
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"),
    (2, "x alpha Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau y"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b\x0c\r "),
    (6, LONG),
    (7, LONG + " tail"),
    (8, "a\x1cb c d 日本語 \U0001F600 ▁x"),
    (9, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"),
    (9, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"),
    (None, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"),
    (10, "short text"),
    (11, "SHORT TEXT"),
    (12, "z" * 5000),
]


@pytest.fixture
def odd(spark):
    """The awkward rows, with extra columns named like the operators' own."""
    rows = [(i, t, None, "s", 0, 1.0, "k") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, doc string, slice int, score double, tokens string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, doc string, slice int, score double, tokens string")
