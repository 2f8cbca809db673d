import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) or longer rows, with a clashing extra column of each operator's names."""

    def make(*rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCS)
        if extra:
            for name in ("key", "score", "lang_pred", "position", "words", "size", "spans", "lines", "root", "part"):
                docs = docs.selectExpr("*", f"'x' AS {name}")
        return docs

    return make


@pytest.fixture
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def words(n, seed=0):
    """n invented words."""
    import random

    random_ = random.Random(seed)
    return [
        "".join(random_.choice(["ba", "ke", "lo", "mi", "tu", "ra", "sen", "dor"]) for _ in range(random_.randint(1, 4)))
        for _ in range(n)
    ]
