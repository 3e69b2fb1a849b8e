import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402



@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, white space only, a long text, ties, repeated rows, a null id, and columns with clashing names."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, " \t\n\x0b "), (73, "é Ü ﬁ 😀 ▁x"), (None, rows[3][1]), (None, None), (80, rows[5][1]), (2, rows[9][1])]
    rows += [(90, " ".join(f"t{i % 700}" for i in range(30_000))), (91, " ".join(f"t{i % 700}" for i in range(29_000)))] + rows[:6]
    rows = [(i, t, None if k % 3 else "x", k, "y") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, `key` string, id int, seg string").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{plain.SF_DIR}/documents.parquet")
