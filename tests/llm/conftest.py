import duckdb
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a test table, read without Spark."""
    def read(name: str, columns: str = "*") -> list[tuple]:
        with duckdb.connect() as connection:
            return connection.execute(f"SELECT {columns} FROM '{DATA}/{name}.parquet'").fetchall()

    return read


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 3000} follows" for i in range(30_000))
    texts = [
        (1, None), (2, ""), (3, "one"), (4, "a b c d e f g"), (4, "a b c d e f g"), (5, "a b c d e f g"),
        (6, long_text), (7, long_text + " end"), (None, "a text without an id"), (None, None), (8, "   \n\t "),
        (9, "Ünïcode ☃ text, with 4111 1111 1111 1111 and a@b.example.com"),
    ]
    rows = [(i, t, None if i in (1, None) else "en", "s", None if t is None else len(t), 0.5, 3, 4) for i, t in texts]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component int, `key` int"
    )
