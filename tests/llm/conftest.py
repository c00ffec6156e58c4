import random

import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long, h long, own_id long, size long, class string"


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with NULLs, blanks, copies, near copies, shared passages, repeated rows and a long text."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(3000)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = say(120), say(60)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "  \n\t ", "one two", "One  TWO", base, base, " ".join(near), passage + " " + say(50),
             say(40) + " " + passage, say(30000), "ü" * 500, "ab" * 400, "é " * 300 + "ö", say(300), say(5), "x"]
    texts += [say(rnd.randint(1, 400)) for _ in range(60)]
    rows = [(i, t, "en", [None, "a", "b", "Ä"][i % 4], None if t is None else len(t), 1, 2, 3, "c") for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[14], (None, base, None, None, None, 1, 2, 3, "c"), (None, None, None, None, None, 1, 2, 3, "c")]


@pytest.fixture()
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC).repartition(3)


@pytest.fixture()
def none(odd):
    return odd.filter(F.lit(False))
