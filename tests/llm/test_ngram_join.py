import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assocspark.llm import ngram_join


def grams(text, n=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, percent=90, n=3):
    sets = [(d, grams(t, n)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a is not None and b is not None and both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((d, len(s), top(d) if d is not None else None) for d, s in sets), key=str)


def family(rng, name, copies, length, edits):
    base = [f"{name}{i}" for i in range(length)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(w))
            w[at:at + rng.choice([0, 1, 1])] = [f"x{rng.randrange(10 ** 6)}"] * rng.choice([0, 1, 1])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [90, 70])
def test_components_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = [t for g in range(5) for t in family(rng, f"g{g}_", 14, rng.choice([12, 30, 80, 200]), 6)]
    # a chain whose ends do not link, families that share most n-grams, and common phrases
    chain = [f"c{i}" for i in range(120)]
    texts += [" ".join([*chain[:k], *(f"d{j}" for j in range(k, 120))]) for k in range(120, 60, -4)]
    texts += [" ".join([*(f"shared{i}" for i in range(60)), *(f"own{k % 3}_{i}" for i in range(k % 3 * 3))]) for k in range(9)]
    texts += ["a common phrase in many texts " + " ".join(f"u{k}_{i}" for i in range(20)) for k in range(15)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one  TWO"), (1005, "ÀB c d"), (1006, "àB C d"), (None, texts[0]), (1007, texts[3]), (1007, texts[60]), (1008, texts[5]), (1008, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({"n": F.lit(1), "k1": F.lit("k"), "sid": F.lit(0.5), "gram": F.lit(1), "component": F.lit(2)})
    got = sorted(map(tuple, ngram_join.jaccard_components(docs, percent=percent).collect()), key=str)
    assert got == brute(rows, percent)


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, ngram_join.jaccard_components(odd).collect()), key=str) == brute(rows)
    assert ngram_join.jaccard_components(nothing).collect() == []


def test_sets_and_filters():
    rng = np.random.default_rng(4)
    flat, bounds = ngram_join.gram_sets(pa.array(["a b c a b c", "A b", None, "", "a b c"]), 3)
    assert np.diff(bounds).tolist() == [3, 1, 0, 0, 1] and flat[bounds[4]] in flat[:3]
    for _ in range(200):
        pool = rng.integers(0, 2 ** 63, 60).astype(np.uint64) * np.uint64(2)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 60))) for _ in range(2))
        true, need = len(np.intersect1d(a, b)), int(rng.integers(1, 40))
        assert ngram_join.shared(a, b, need) in ((true,) if true >= need else (0, true))
