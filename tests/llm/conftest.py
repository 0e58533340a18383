import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, leaf int, size int"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma,", "it's", "don't", "x1", "naïve", "漢字", "😀", "½", "ﬁn",
             "  ", "\t", " ", "'s", "''", "end.", "\x0b"]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [(0, "one two three four five\nsix seven eight", "en", "a", 40, 1, 1),
            (1, "one two three four five\nsix seven nine", "en", "a", None, 1, 1),
            (2, "", None, "b", 0, None, None), (3, None, "de", None, None, 1, 1),
            (None, None, None, None, None, None, None), (None, "no id", "en", "c", 5, 0, 0),
            (4, "repeated row here", "en", None, 17, 2, 2), (4, "repeated row here", "en", None, 17, 2, 2),
            (5, long_text, "en", "a", len(long_text), 3, 3), (6, "\n\n \n", "en", "b", 4, 1, 1),
            (-7, "I'll 'still 's  go\r\n now", "en", "\U0001f600", 20, 1, 1)]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), "en",
              rng.choice("abc"), 10, 1, 1) for i in range(60)]
    return spark.createDataFrame(rows, COLUMNS)
