import random

import pytest

EXTRA = "n_words long, kept boolean, key string, row string, component_id long, score double, host string, tokens int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names clash with computed ones."""
    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + (", " + EXTRA if extra else "")
        more = (7, True, "k", "r", 3, 0.5, "h", 1) if extra else ()
        return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), *more) for i, t in rows], schema)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null key, null and blank texts, one very long text, odd characters, repeated rows, ties."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120)
    long = "\n".join(text(40) for _ in range(400)) + " " + "x" * 5000
    return [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \t\n "), (6, long), (7, "one"), (None, base),
            (8, "Ünï çödé 中文 🙂 don't we'll\r\n\x0b\x1c <|endoftext|> 1234"), (9, base + " " + text(3)),
            (10, text(60)), (11, "a " * 200), (12, "three word text"), (None, None)]
