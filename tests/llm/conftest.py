import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Reproducible words, most of them met nowhere else."""
    return " ".join(f"{WORDS[(seed * 7 + i * i) % 20]}{(seed * 31 + i * 17) % 997}" + ("." if i % 11 == 10 else "") + ("\n" if i % 23 == 22 else "") for i in range(n))


@pytest.fixture
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a very long text, columns whose names clash with the operators' own."""
    rows = [(1, prose(1, 120)), (2, None), (3, ""), (4, " \n\t "), (5, prose(1, 120)), (5, prose(1, 120)), (None, prose(6, 30)), (None, None), (7, "one"), (8, "Émile ß 日本 \U0001f600 é"), (9, prose(9, 40_000)),
            (10, "x" * 30_000), (11, "a " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), "score": F.lit("s"), "band": F.lit(1), "k1": F.lit(2.0), "node": F.array(F.lit(1)),
                           "component": F.lit(None).cast("int"), "runs": F.lit("r"), "c0": F.lit(0), "begin": F.lit(0), "removed": F.lit("x"), "distance": F.lit(1), "count": F.lit(3)})


@pytest.fixture
def nothing(odd):
    return odd.limit(0)
