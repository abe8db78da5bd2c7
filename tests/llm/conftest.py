import pytest

# Columns with the names that operators use inside or return.
CLASHING = ["doc", "body", "text_", "spans", "size", "row", "print", "node", "root", "score", "label", "_kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

LONG = " ".join(f"word{i % 977}" for i in range(120_000))
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, "The same text twice, with password = abcdefghijkl0 in it.", "en", "b", 57),
    (5, "The same text twice, with password = abcdefghijkl0 in it.", "en", "b", 57),
    (6, "The same text twice, with password = abcdefghijkl0 in it.", "de", "b", 57),
    (None, "No id here but some words and deadbeefdeadbeef01.", "en", "c", 48),
    (None, None, None, None, None),
    (7, "İſK 漢字 😀 ½ été", "fr", "ü", 16),
    (8, "12 34 --- !!!", "fr", "a", 13),
    (-9, "one", None, "", 3),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in EDGE], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
