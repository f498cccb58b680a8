import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from assocspark.llm import graph, linededup, minhash

from .conftest import prose


def multiset(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def brute_classes(rows):
    sets, parent = {d: multiset(t) for d, t in rows}, {d: d for d, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = sum((sets[a] & sets[b]).values())
            if a < b and both and both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= 0.8:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: top(d) for d in sets}


def near_copies(seed, groups, copies, edits):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{g}_{k}" for k in range(60)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(60)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [4, 128])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_copies(3, 4, 25, 4) + [(1000, "a b c"), (1001, "A  b c"), (1002, "a b c d"), (1003, "a b a b a b a b a b"), (1004, "a b a b a b a b a b a b")]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_agreement_of_coordinates_is_weighted_similarity():
    a, b = "p q r s t u " * 30 + " ".join(f"m{i}" for i in range(150)), "p q r s t u " * 20 + " ".join(f"m{i}" for i in range(150))
    strip, bounds, _ = minhash.strips(pa.array([a, b]))
    signature = minhash.signatures(strip, bounds)
    true = minhash.similarity(np.sort(strip[:bounds[1]]), np.sort(strip[bounds[1]:]))
    x, y = multiset(a), multiset(b)
    assert true == pytest.approx(sum((x & y).values()) / sum((x | y).values()))
    assert abs((signature[0] == signature[1]).mean() - true) < 0.15


def test_signature_of_tiny_texts_fills_every_coordinate():
    strip, bounds, _ = minhash.strips(pa.array(["one", "", None, "one two three four five"]))
    signature = minhash.signatures(strip, bounds)
    empty = signature == np.uint64(2 ** 64 - 1)
    assert not empty[0].any() and empty[1].all() and empty[2].all() and not empty[3].any()


def test_near_duplicates_of_odd_rows(odd, nothing):
    got = collections.Counter((r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(odd).collect())
    assert got[(1, 1)] == 1 and got[(5, 1)] == 2
    assert all(got[(i, i)] == 1 for i in (2, 3, 4, 7, 8, 9, 10, 11)) and got[(None, None)] == 2
    assert minhash.near_duplicates(nothing).collect() == []


def test_one_of_each_keeps_columns_and_one_row(odd, nothing):
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 7, 8, 9, 10, 11, None, None]))
    assert minhash.one_of_each(nothing).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_removal(rows):
    """Texts without the words of every 40-word run that an earlier place has."""
    seen, kept = {}, {}
    for d, t in sorted(rows):
        w = t.split()
        again = [False] * len(w)
        for i in range(len(w) - 39):
            key = tuple(w[i:i + 40])
            if seen.setdefault(key, (d, i)) != (d, i):
                again[i:i + 40] = [True] * 40
        kept[d] = [x for x, gone in zip(w, again, strict=True) if not gone]
    return kept


def test_removal_equals_brute_force(spark):
    passage, rng = prose(50, 70).split(), random.Random(5)
    rows = []
    for d in range(30):
        words = prose(100 + d, 150).split()
        if d % 3 == 0:
            at = rng.randrange(150)
            words[at:at] = passage
        rows.append((d, " ".join(words)))
    rows += [(40, rows[1][1]), (41, " ".join(rows[2][1].split()[30:100])), (42, " ".join(rows[4][1].split()[:39])), (43, prose(9, 60) + "\n" + prose(9, 60))]
    got = {r["doc_id"]: r["text"].split() for r in linededup.remove_later_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_removal(rows)
    assert got[40] == [] and got[41] == [] and len(got[42]) == 39 and len(got[43]) == 60


def test_ends_follow_the_first_source(spark):
    passage = prose(50, 90).split()
    texts = [prose(100 + d, 50).split() + passage[a:b] + prose(200 + d, 50).split() for d, (a, b) in enumerate([(10, 80), (0, 90), (5, 85), (20, 60)])]
    got = {r["doc_id"]: r["text"].split() for r in linededup.remove_later_runs(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")).collect()}
    left = {d: len(got[d]) - 100 for d in got}
    assert left[0] == 70 and left[1] == 20 and left[2] <= 2 * (linededup.WINDOW - 1) and left[3] == 0


def test_excerpt_in_the_first_document_hides_no_later_copy(spark):
    texts = []
    for size, excerpt in [(40, 39), (45, 39), (52, 38), (56, 30), (77, 39), (60, 21)]:
        for seed in range(6):
            base = 1000 * size + 10 * seed
            passage, at = [f"p{base}_{i}" for i in range(size)], seed * (size - excerpt) // 5
            for part in (passage[at:at + excerpt], passage, passage[:size // 2] + ["other"] + passage[size // 2:], passage):
                d = len(texts)
                texts.append((d, " ".join([*(f"b{d}_{i}" for i in range(30 + seed)), *part, *(f"e{d}_{i}" for i in range(30))])))
    got = {r["doc_id"]: r["text"].split() for r in linededup.remove_later_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_removal(texts)
    assert all(len(got[d]) == 60 + d // 4 % 6 for d in got if d % 4 == 3)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_edited_copies_and_nested_excerpts(spark, batch):
    """Windows that differ at the ends of runs, whatever rows share an Arrow batch."""
    rng, texts = random.Random(batch), []
    bases = [[f"b{g}_{i}" for i in range(260)] for g in range(4)]
    for d in range(60):
        w = list(bases[d % 4])
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 3)] = [f"x{d}_{at}"] * rng.randint(0, 2)
        a, b = sorted(rng.sample(range(len(w)), 2))
        texts.append((d, " ".join((w if rng.random() < 0.4 else w[a:b]) * rng.choice([1, 1, 2]))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r["doc_id"]: r["text"].split() for r in linededup.remove_later_runs(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_removal(texts)


def test_shared_doc_id_is_cut_where_the_run_is(spark):
    passage = prose(60, 50).split()
    texts = [(1, prose(61, 20).split() + passage), (2, prose(62, 30).split() + passage + prose(63, 40).split()), (2, prose(64, 150).split())]
    got = sorted(len(r["text"].split()) for r in linededup.remove_later_runs(spark.createDataFrame([(d, " ".join(w)) for d, w in texts], "doc_id long, text string")).collect())
    assert got == [70, 70, 150]


def test_every_run_of_forty_words_has_a_shared_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(50):
        run = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
        marks = []
        for _ in range(2):
            before, after = (rng.integers(0, 2 ** 63, rng.integers(0, 60), dtype=np.uint64) for _ in range(2))
            whole = np.concatenate([before, run, after])
            place, lines = linededup.winnow(whole, np.array([0, len(whole)]))
            marks.append({int(h) for p, h in zip(place, lines, strict=True) if len(before) <= p <= len(before) + 19})
        assert marks[0] & marks[1]


def test_removal_of_odd_rows(odd, nothing):
    cleaned = linededup.remove_later_runs(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == 13
    texts = collections.defaultdict(list)
    for r in cleaned.collect():
        texts[r["doc_id"]].append(r["text"])
    before = collections.defaultdict(list)
    for r in odd.collect():
        before[r["doc_id"]].append(r["text"])
    assert texts[5] == ["", ""] and texts[1] == before[1]
    assert all(texts[i] == before[i] for i in (2, 3, 4, 7, 8, 9, 10)) and sorted(map(str, texts[None])) == sorted(map(str, before[None]))
    assert texts[11] == ["a "]  # a text that repeats itself keeps one period
    assert linededup.remove_later_runs(odd, drop_emptied=True).count() == 11
    runs = [(r["doc_id"], r["begin"], r["source_doc_id"]) for r in linededup.removed_runs(odd).collect()]
    assert sorted(runs) == [(5, 0, 1), (5, 0, 1), (11, 2, 11)]
    assert linededup.remove_later_runs(nothing).collect() == [] and linededup.removed_runs(nothing).collect() == []
