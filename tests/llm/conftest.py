import pytest

#: Nulls, empty texts, white space only, ties and repeated rows; other columns with names that operators use inside.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "Same text"), (5, "same TEXT"), (5, "same TEXT"), (6, "é à ü 你好 😀"), (7, "x" * 5000), (8, "a b " * 4000)]
#: Names that operators use inside; a column's value is its name, so that a test sees if one is overwritten.
CLASHES = ["__s", "__s2", "__id", "__i", "__text", "__t", "__d", "__k", "__h", "__copies", "__hot", "__cold", "__spread", "__c0", "__all", "__m", "row", "c0", "i", "s", "d", "score", "kept", "keep_id", "sampled", "tokens", "topic", "component_id", "piece", "matches"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(d, t, None, None, "k", 1, "root", 2.0, *CLASHES) for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, node string, start int, root string, n double, " + ", ".join(f"`{c}` string" for c in CLASHES))


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(sf_dir):
    import pyarrow.parquet as pq

    return [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
