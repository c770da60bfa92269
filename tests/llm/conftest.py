import pytest
from compare import duck

FOLDER = "/root/testdata/sf0.001"
EDGES = [  # repeated rows, NULL ids, NULL, empty and blank texts, a long text
    (1, "The quick brown fox\njumps over\nthe lazy dog."),
    (1, "The quick brown fox\njumps over\nthe lazy dog."),
    (2, None),
    (3, ""),
    (None, "a b c"),
    (None, None),
    (None, "a b c"),
    (4, " \t\n\r\n "),
    (5, "word " * 30_000),
    (6, "é ñ 日本 \U0001f600 ▁x  y\n"),
    (7, "x"),
]


@pytest.fixture(scope="session")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="session")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture
def edges(spark):
    """Edge rows with further columns whose names clash with those that operators use."""
    rows = [(i, t, "en", "k", 0) for i, t in EDGES]
    names = "doc_id long, text string, lang string, _k1 string, shard int"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, _k1 string, shard int")
