import duckdb
import pytest

SF = "/root/testdata/sf0.001"
WORDS = "the of and to in is that for it with as was on be by at from this are or an".split()


def prose(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * i + 7 * i * seed + seed) % len(WORDS)] + str((i * 31 + seed) % 97) for i in range(n))


#: Null, empty and blank texts, repeated rows, ids that are null or shared, other scripts, a very long text.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two three"), (4, "One two three"), (5, "one TWO three"),
    (None, prose(60, 3)), (6, prose(60, 3)), (7, prose(60, 4)), (7, prose(60, 5)), (8, "é ü 漢字 🙂 ́a"),
    (9, prose(30_000, 6)), (10, "word " * 3000), (11, "x" * 100_000), (12, "password: hunter22 AKIA" + "A" * 20),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with other columns whose names the operators use themselves."""
    rows = [(k, t, "s", "en", None, 1, "x", "kept", 7) for k, t in EDGE]
    names = (
        "doc_id long, text string, source string, lang string, n_chars long, shard int, `key` string, _content string, "
        "_spans int"
    )
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents():
    return duckdb.connect().sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
