import pytest

SF = "/root/testdata/sf0.001"

SHARED = "the quick brown fox jumps over the lazy dog and then it runs far away from here " * 4
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30000))


def rows():
    """Ids and texts with every odd case: null, empty, blank, very long, equal, repeated, not ASCII, without an id."""
    base = [None, "", "  \n\t ", "one", "one two", "Café au lait\nüber ß 漢字 \U0001f600", LONG, LONG[:-7] + " end", "a" * 5000, SHARED + "tail", "head " + SHARED]
    body = [(i, t) for i, t in enumerate(base)]
    many = " ".join(f"line{i}" for i in range(300))
    body += [(20 + k, many.replace(f"line{k * 11}", "edit")) for k in range(8)]
    body += [(40, many), (41, many), (41, many), (42, "one two"), (7, LONG), (None, "no id at all"), (None, None)]
    return body


@pytest.fixture(scope="session")
def docs(spark):
    """The rows with extra columns whose names clash with those that operators make."""
    body = [(i, t, 1, "x", 2.0, True, [1]) for i, t in rows()]
    return spark.createDataFrame(body, "doc_id bigint, text string, n int, row string, score double, ok boolean, hits array<int>")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


def read(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet")
