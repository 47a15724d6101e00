import pytest

WORDS = "the of and stone river light under seven maps were drawn by hand before dawn while others slept".split()


def prose(n, seed):
    """n words, different for each seed."""
    return " ".join(f"{WORDS[(seed * 7 + i * i + i // 3) % len(WORDS)]}{chr(97 + (seed + i) % 26)}" for i in range(n))


def frame(spark, rows):
    """Documents with columns whose names operators might use themselves."""
    full = [(i, t, "en", "src", None if t is None else len(t), 1, "x", 2.5, [3]) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, row int, key string, score double, words array<int>")


@pytest.fixture(scope="session")
def edges(spark):
    """NULL and empty texts, a NULL id, a very large id, ties, repeated rows, a very long text."""
    long = prose(30_000, 3)
    rows = [(2**60 + 1, prose(40, 1)), (1, None), (2, ""), (3, " \t\n "), (None, prose(40, 1)), (None, prose(30, 9)), (4, prose(40, 1)),
            (4, prose(40, 1)), (5, long), (6, long), (7, "one"), (8, "naïve 中文 😀 ▁x\r\nCC BY"), (9, "a\n\n\na"), (10, "x" * 5000)]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
