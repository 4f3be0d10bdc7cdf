import random

import pytest

from halocline.llm.shared import ship_package

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash long, tile long, _spans string"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) with further columns whose names operators use themselves."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), 1, None, "x") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return build


@pytest.fixture
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]

    def draw(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    return draw


