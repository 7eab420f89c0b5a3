import random

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def _words(rng, n):
    return " ".join("".join(rng.choice(["th", "en", "or", "ba", "lu", "mi", "so"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def small_docs():
    """(doc_id, text, lang, source): copies, near copies, shared lines, odd and empty texts, nulls, repeated rows."""
    rng = random.Random(5)
    base = ["\n".join(_words(rng, rng.randint(8, 40)) for _ in range(rng.randint(2, 6))) for _ in range(60)]
    texts = list(base)
    texts += [base[0]] * 12 + [base[1].replace("th", "mi", 1) for _ in range(3)] + [base[2] + " tail"] * 2
    shared = "Copyright 2020 of the example site with all rights reserved"
    texts += [f"{t}\n{shared.replace('2020', str(2000 + i))}" for i, t in enumerate(base[10:30])]
    texts += ["ba ba ba " * 60, "x", "", " \t\n", None, None, "a b", "# $ % <>|" * 30, "ÉÀ ünï\u00a0code " * 40]
    texts += ["\n".join(_words(rng, 12) for _ in range(400))]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None])) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[-1]]
    return rows


@pytest.fixture(scope="session")
def docs(spark, small_docs):
    """The rows as a table with columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    rows = [(i, t, g, s, len(t) if t is not None else None) for i, t, g, s in small_docs]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(7) for c in ("size", "n", "fp", "id", "hash", "copies", "_extra", "ids")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
