import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assocspark.llm import decontam, licenses, vectors
from assocspark.llm.queries import OP2_SQL

from .conftest import prose


def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=12), st.text(alphabet="abc", min_size=1, max_size=20), st.integers(0, 6))
def test_banded_alignment_equals_the_full_table(item, text, edits):
    points = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (item, text)]
    want = edit_distance_inside(item, text)
    got = decontam.align(*points, edits)
    assert (got is None) == (want > edits)
    if got:
        assert got[0] == want


def test_items_equal_brute_force(spark):
    rng, items, docs = random.Random(4), [], []
    for i in range(12):
        items.append((i, prose(200 + i, 12 + 3 * i)))
    for d in range(60):
        text = prose(d, 60).split(" ")
        if d % 3 == 0:
            body = list(items[d // 3 % 12][1])
            for _ in range(rng.randrange(0, 2 * max(1, len(body) // 10))):
                k = rng.randrange(len(body))
                body[k:k + 1] = rng.choice(["", "é", body[k] + "q"])
            text[d % 50:d % 50] = "".join(body).upper().split(" ")
        docs.append((d, "  ".join(text)))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontam.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    flat = lambda t: re.sub(r"\s+", " ", t.lower()).strip()
    want = {}
    for d, t in docs:
        i = d // 3 % 12
        if d % 3 == 0 and (e := edit_distance_inside(flat(items[i][1]), flat(t))) <= decontam.budget(len(flat(items[i][1]))):
            want[d, i] = e
    assert got == want and len(want) > 5 and max(want.values()) > 0


def test_chunks_of_the_benchmark_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(300 + i, 20)) for i in range(6)] + [(7, None), (8, ""), (9, "too short"), (None, prose(9, 30))], "item_id long, text string")
    docs = spark.createDataFrame([(d, prose(d, 30) + " " + prose(300 + d, 20)) for d in range(6)], "doc_id long, text string")
    one = sorted(map(tuple, decontam.find_items(docs, items).collect()))
    monkeypatch.setattr(decontam, "CHUNK_CHARS", 200)
    assert sorted(map(tuple, decontam.find_items(docs, items).collect())) == one
    assert [(d, i, e) for d, i, _, _, e in one] == [(d, d, 0) for d in range(6)]
    text = docs.where("doc_id = 2").first()["text"]
    assert text[one[2][2]:one[2][3]].split() == prose(302, 20).split()


def test_items_in_odd_rows(odd, nothing, spark):
    items = spark.createDataFrame([(1, prose(9, 40_000)[5000:5300])], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.find_items(odd, items).collect()} == {9}
    kept = decontam.without_items(odd, items)
    assert kept.columns == odd.columns and kept.count() == 12
    assert decontam.find_items(nothing, items).collect() == []
    assert decontam.without_items(odd, items.limit(0)).count() == 13


def brute_licenses(text):
    norm = lambda t: re.sub(r"\.(?=\s|$)|^\.", " ", re.sub(r"[^\w.]+", " ", t.lower()).replace("_", " "))
    grams = lambda t: {tuple(w) for w in zip(norm(t).split()[:-1], norm(t).split()[1:], strict=True)}
    out = []
    lines = text.split("\n")
    for n, unit in [*enumerate(lines), *([(-1, text)] if len(lines) > 1 else [])]:
        a, best = grams(unit), None
        for k, (_, t) in enumerate(licenses.TEMPLATES):
            b = grams(t)
            dice = 2 * len(a & b) / max(1, len(a) + len(b))
            if dice >= licenses.DICE and (best is None or dice > best[1]):
                best = (k, dice)
        if best:
            out.append((n, *best))
    return out


def test_licences_equal_brute_force(spark):
    texts = [t for _, t in licenses.TEMPLATES] + [prose(1, 50) + "\nReleased under the MIT licence, the MIT License!\n" + prose(2, 9), "released   UNDER the mit license", "MIT License",
                                                  licenses.TEMPLATES[4][1].replace(". ", ".\n").replace(", to", ",\nto"), "This work is licensed under the GNU General Public License, version 4."]
    got = {}
    for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], []).append((r["line"], r["template"], r["dice"]))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(b) for d, t in enumerate(texts) if (b := brute_licenses(t))}


def test_notices_wrapped_or_inside_lines_of_long_texts(spark):
    rng, texts, want = random.Random(8), [], set()
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        for way in range(3):  # on a line between words; wrapped anew every few words; wrapped with two words changed
            words = t.split()
            if way == 2 and len(words) > 20:
                words[7] = words[15] = "other"
            gap = rng.randint(3, 8)
            notice = " ".join(words) if way == 0 else "".join(w + ("\n" if i % gap == gap - 1 else " ") for i, w in enumerate(words))
            want.add((len(texts), k))
            texts.append(prose(3 * k + way, 200) + " Copyright (c) 2020 X. " + notice + " " + prose(k, 150))
    texts += [prose(1, 400), "Redistribution and use\n" + prose(5, 60) + "\nin source and binary forms",
              licenses.TEMPLATES[5][1].replace("without fee", "without fee\n") + "\n" + prose(7, 80) + " All rights\nreserved. " + prose(8, 50)]
    want |= {(len(texts) - 1, 5), (len(texts) - 1, len(licenses.TEMPLATES) - 1)}
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"]) for r in rows} == {(d, licenses.TEMPLATES[k][0]) for d, k in want} and len(rows) == len(want)
    assert {(r["doc_id"], r["template"]) for r in rows} ^ want == {(5, 0), (5, 1)}  # the short Apache notice begins the long one and is unchanged
    assert all(r["dice"] == 1 for r in rows if r["doc_id"] % 3 != 2 and r["doc_id"] < 3 * len(licenses.TEMPLATES))
    lines = {r["doc_id"]: r["line"] for r in rows if r["doc_id"] % 3 == 0 and r["doc_id"] < 3 * len(licenses.TEMPLATES)}
    assert all(texts[d].split("\n")[n].find(licenses.TEMPLATES[d // 3][1]) >= 0 for d, n in lines.items())


def test_licences_in_odd_rows(odd, nothing):
    assert licenses.scan(odd).collect() == [] and licenses.scan(nothing).collect() == []
    assert licenses.scan(odd, templates=()).collect() == []


@pytest.fixture
def vector_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype(float).tolist()) for i in range(60)]
    rows += [(60, rows[3][1]), (61, rows[3][1]), (62, None), (63, []), (64, [0.0] * 8), (65, [float("nan")] + [1.0] * 7), (66, [1.0, None] + [1.0] * 6), (67, [float("inf")] + [1.0] * 7), (68, [1e30] * 8), (80, [2.0, 3.0]),
             (81, [1.0, 1.0]), (3, rows[3][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_nearest_equal_sql(vector_rows, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 2)
    monkeypatch.setattr(vectors, "CANDIDATES", 25)
    monkeypatch.setattr(vectors, "STRIP", 7)
    rows, df = vector_rows
    rows = rows[:-1]
    table = pa.table({"vec_id": pa.array([r[0] for r in rows]), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))})
    con = duckdb.connect()
    con.register("embeddings", table)
    want = sorted(con.execute(OP2_SQL).fetchall())
    got = sorted(map(tuple, vectors.nearest(df, "vec_id % 20 = 0", 20).collect()))
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)
    assert {r[0] for r in want} == {0, 20, 40, 60, 80} and [r for r in want if r[0] == 80] == [(80, 1, 81, 5.0)]


def test_error_bound_holds():
    rng = np.random.default_rng(3)
    q, v = rng.normal(size=(20, 2000)), rng.normal(size=(50, 2000)) * rng.lognormal(size=(50, 1))
    (qc, qs, qn, qe), (vc, vs, vn, ve) = vectors.quantise(q), vectors.quantise(v)
    off = np.abs(vectors.tile_products(qc, vc) * qs[:, None] * vs - q @ v.T)
    assert (off <= qe[:, None] * vn + np.linalg.norm(q, axis=1)[:, None] * ve + 1e-9).all() and off.max() > 0


def test_nearest_of_empty_tables_and_clashing_names(vector_rows, spark):
    from pyspark.sql import functions as F
    _, df = vector_rows
    assert vectors.nearest(df.limit(0), "vec_id % 20 = 0").collect() == []
    more = df.withColumns({"score": F.lit("x"), "dim": F.lit(1), "i": F.lit(2), "asks": F.lit(None)})
    assert vectors.nearest(more, "vec_id % 20 = 0", 3).count() == vectors.nearest(df, "vec_id % 20 = 0", 3).count()
    assert vectors.nearest(spark.createDataFrame([(None, [1.0]), (20, [1.0])], "vec_id long, embedding array<double>"), "vec_id % 20 = 0").collect() == []


def test_an_id_of_many_equal_rows_counts_once_and_is_dealt_once(vector_rows, monkeypatch):
    monkeypatch.setattr(vectors, "CANDIDATES", 25)
    rows, df = vector_rows
    many = df.union(df.sparkSession.createDataFrame([rows[20]] * 3000 + [(5, [float(k)] * 8) for k in range(1, 60)], df.schema))
    once = df.union(df.sparkSession.createDataFrame([(5, [float(k)] * 8) for k in range(1, 60)], df.schema))
    assert vectors.nearest(many, "vec_id % 20 = 0", 20).collect() == vectors.nearest(once, "vec_id % 20 = 0", 20).collect()
    plan = vectors.nearest(many, "vec_id % 20 = 0", 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("partial_max(asks")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcde"), min_size=1, max_size=25), min_size=1, max_size=6), st.lists(st.lists(st.sampled_from("abcdex"), max_size=25), max_size=6), st.sampled_from([0.5, 0.8, 1.0]))
def test_templates_of_fitting_size_equal_all_templates(templates, texts, dice):
    def bigrams(words):
        return set(zip(words, words[1:], strict=False))
    lib = licenses.library([(str(k), " ".join(t)) for k, t in enumerate(templates)])
    want = []
    for n, t in enumerate(texts):
        values = [(2 * len(bigrams(t) & bigrams(m)) / (len(bigrams(t)) + len(bigrams(m))), -k) for k, m in enumerate(templates) if bigrams(t) & bigrams(m)]
        if values and max(values)[0] >= dice:
            want.append((n, -max(values)[1], max(values)[0]))
    got = licenses.best_templates(lib, pa.array([" ".join(t) for t in texts], pa.string()), dice)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_templated_items_equal_brute_force(monkeypatch):
    """Items that share a long opening; documents that quote the opening, an item with edits, or a cut item. Sieves may only save work."""
    rng = random.Random(6)
    prose_of = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    opening = prose_of(12)
    items = [f"{opening} {prose_of(rng.randint(4, 30))}" for _ in range(60)]
    docs = []
    for k in range(24):
        inner = list(items[k])
        for _ in range(rng.randint(0, len(inner) // 12)):
            inner[rng.randrange(len(inner))] = rng.choice("xyz")
        docs.append(f"{prose_of(60)} {opening} {prose_of(30)} {''.join(inner) if k % 3 else items[k][:len(items[k]) // 2]} {prose_of(900 if k == 5 else 30)}")
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(24)), "text": pa.array(docs)})

    def found(index):
        out = decontam.scan(index, batch)
        return sorted(map(str, out.to_pylist())) if out is not None else []

    index = decontam.build_index(list(range(60)), items)
    assert index.first[-1] < sum(len(decontam.grams(c)) for c in index.texts)  # the opening is left out where the lemma allows it
    got = found(index)
    assert len(got) >= 12
    monkeypatch.setattr(decontam, "STEP", 500)
    assert found(index) == got
    monkeypatch.setattr(decontam, "COMMON", 10 ** 9)
    monkeypatch.setattr(decontam, "_may_hold", lambda index, points, begin, end, item: np.ones(len(item), bool))
    assert found(decontam.build_index(list(range(60)), items)) == got
