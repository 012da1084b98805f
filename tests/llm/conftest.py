import pytest
from edge_rows import CLASHES, TEXTS


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, None, None, None, *[None] * len(CLASHES)) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(3)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame([(1, "The quick brown FOX and the lazy dog are in the house of the man!"), (2, "café 漢字"),
                                  (3, None), (None, "same"), (4, ""), (4, "quick brown")], "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 1), (6, 1, None), (7, None, 1), (7, 1, 0), (99, 1, 1), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")
