import random

import pytest

from plumbline.llm.common import code_on_workers, table

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, print string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    code_on_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    base = prose(1, 60)
    changed = base.replace("alpha", "omega", 1) + " end"
    texts = [
        (1, base), (2, base), (2, base), (3, changed), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "one"),
        (9, "ONE"), (10, prose(2, 30_000)), (11, "two words"), (None, base), (None, None), (12, "é日本 " * 40),
        (13, "x" * 50_000), (14, "a.b!c?\n" * 30), (15, "tab\tand\x0bblank\x85other\xa0space\x1cend"),
        (16, prose(3, 80) + "\n" + base), (17, "password = abcdefgh1 token: short"),
    ]
    rows = [(i, t, None if i in (4, 7) else "en", None if i in (5, 8) else "src0", None if t is None else len(t), 0.5, i, "p") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
