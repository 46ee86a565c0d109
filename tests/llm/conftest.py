import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice(["ba", "ke", "li", "mo", "nu", "ra", "sé", "to"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]


@pytest.fixture(scope="session")
def sf(tmp_path_factory, spark):
    """The smallest test tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, source), with columns whose names operators use inside."""
    def make(rows):
        full = [(i, t, None, *(rest or (None,)), None if t is None else len(t), "x", "y") for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS + ", key string, size string")

    return make
