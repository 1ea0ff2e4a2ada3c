import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "Läm", "mu,", "nu.", "xi", "π"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "a", "o", "en"]) for _ in range(n))


def corpus():
    """Null and empty texts, short ones, exact and near copies, shared passages, long runs, a very long text, a repeated row."""
    base, passage = prose(1, 120), prose(2, 40)
    near = base.split(" ")
    near[60] = "other"
    texts = [None, "", "  \n\t ", "one", "one two three", base, base, " ".join(near), base.upper(), prose(3, 30) + " " + passage + "\n" + prose(4, 30), passage + " " + prose(5, 50), "x " * 100, "x " * 50 + "y " * 50, "a b " * 60, prose(6, 20000), "a b <|endoftext|> c\x1f", "line one\nline two\n" * 30]
    rows = [(i * 10, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    return [*rows, rows[7], (None, prose(8, 25), None, None)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    # names that the operators use inside, as clashing extra columns
    from pyspark.sql import functions as F

    d = spark.createDataFrame(corpus(), SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return d.withColumns({c: F.lit(1) for c in ("g", "sig", "cls", "bucket", "size", "rank", "score", "kept", "h", "d")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars long")
