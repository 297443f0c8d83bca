import pytest

SF = "/root/testdata/sf0.001"
LONG = "wort " * 30000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, columns whose names operators use themselves."""
    prose = "The quick brown fox jumps over the lazy dog while the old man reads a book about the sea and its many ships. "
    rows = [
        (1, prose * 4, "en", "a"), (2, prose * 4, "en", None), (2, prose * 4, "en", None), (None, prose, None, "a"), (None, None, None, None), (3, None, "en", "b"), (4, "", "en", "b"),
        (5, " \n\t ", "fr", "b"), (6, LONG, "de", "c"), (7, "x", None, "c"), (8, "12 34 !!", "en", "c"), (9, "Écris à a.b@c.de ou +1 (555) 123-4567, 10.0.0.255, 4111 1111 1111 1111 fin 😀", "fr", "c"), (10, prose * 4 + "end", "en", "d"),
    ]
    full = [(*r, len(r[1]) if r[1] is not None else None, 1, 2, "k", [1], "s") for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size int, class int, key string, spans array<int>, row string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
