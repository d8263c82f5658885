import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size int, component_id string"

WORDS = ("alpha", "beta", "gamma", "delta", "river", "stone", "green", "quick", "brown", "fox", "Über", "naïve", "σ")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append(r.choice(WORDS) + (".\n" if i % 17 == 16 else "." if i % 11 == 10 else ""))
    return " ".join(out)


def corpus() -> list[tuple]:
    """Null, empty and blank texts, one word, ties, repeated rows, a very long text, near copies, null columns, and
    columns whose names clash with results."""
    base = prose(1, 300)
    texts = [None, "", " \t\n", "word", base, base, base.replace("river", "lake", 1), base + " tail", prose(2, 300), prose(3, 40) + base[:400] + prose(4, 40), prose(5, 20_000), "aaaa" * 200, "aaaa" * 200, prose(6, 120) + "\n" + prose(6, 120)]
    texts += [prose(100 + i, 60 + i) for i in range(20)] + [base.upper()] + [base[:600] + prose(200 + i, 30) for i in range(12)]
    rows = [(i, t, None if i % 5 == 0 else ("en", "de")[i % 2], None if i % 7 == 0 else "s", None, "x", 1, "y") for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[8]]  # two rows twice


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None) for i in range(4, 30)] + [(None, 1, 1), (7, None, 0), (4, 1, 1)], "doc_id bigint, quality int, toxic int")
