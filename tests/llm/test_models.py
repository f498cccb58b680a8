import zlib

import numpy as np
import pyarrow as pa
import pytest

from assocspark.llm import langid, toxicity

from .conftest import prose


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


@pytest.fixture
def toxic_rows(spark):
    bad = ["idiot", "scum", "moron"]
    rows, labels = [], []
    for d in range(300):
        words = prose(d, 60).split()
        if d % 4 == 0:
            words[10:10] = [bad[d % 3], bad[(d + 1) % 3]]
        rows.append((d, " ".join(words)))
        labels.append((d, int(d % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_are_told_apart(toxic_rows):
    docs, labels = toxic_rows
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == 300 and all(got[d]["held_out"] == held(d) for d in got)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([got[d]["predicted"] == int(d % 4 == 0) for d in got if held(d)]) > 0.95


def test_spans_hold_the_offending_words(toxic_rows):
    docs, labels = toxic_rows
    model = toxicity.train(docs, labels)
    row = toxicity.score(docs.where("doc_id = 8"), model, spans=True).first()
    assert [(s["begin"], s["end"]) for s in row["spans"]] == [(10, 12)]
    assert {r["doc_id"] % 4 for r in toxicity.without_toxic(docs, model).collect()} == {1, 2, 3}


def test_labels_of_held_out_rows_are_never_learnt(toxic_rows, spark):
    docs, labels = toxic_rows
    wrong = spark.createDataFrame([(d, int((d % 4 == 0) != held(d))) for d in range(300)], "doc_id long, toxic int")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, wrong)
    assert (a.weights == b.weights).all() and (a.outer == b.outer).all()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    score, moves, begin = rng.normal(size=6), rng.normal(size=(2, 2)), 0.3
    p, _ = toxicity.marginals(score, np.array([0, 4]), np.array([4, 2]), moves, begin)

    def brute(s):
        total, on = 0.0, np.zeros(len(s))
        for code in range(2 ** len(s)):
            y = [(code >> i) & 1 for i in range(len(s))]
            w = np.exp(sum(s[i] * y[i] for i in range(len(s))) + begin * y[0] + sum(moves[a, b] for a, b in zip(y[:-1], y[1:], strict=True)))
            total, on = total + w, on + w * np.array(y)
        return on / total

    assert p == pytest.approx(np.concatenate([brute(score[:4]), brute(score[4:])]))


def test_scores_of_odd_rows(odd, nothing, toxic_rows, spark):
    model = toxicity.train(*toxic_rows)
    got = toxicity.score(odd, model, spans=True).collect()
    assert len(got) == 13 and all(0 <= r["score"] < 0.5 and r["spans"] == [] for r in got)
    assert toxicity.without_toxic(odd, model).columns == odd.columns and toxicity.without_toxic(odd, model).count() == 13
    assert toxicity.score(nothing, model).collect() == []
    no_labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.classify(odd, no_labels).collect())
    assert toxicity.classify(nothing, no_labels).collect() == []


SPEECH = {"en": "the and of with this that have from they which would there their what about", "fr": "le les des une dans pour avec sur nous vous être cette mais comme leur", "de": "der die das und nicht mit eine auch wird werden sich über für durch nach"}


@pytest.fixture
def speech(spark):
    rows = []
    for d in range(240):
        lang = list(SPEECH)[d % 3]
        words = SPEECH[lang].split()
        rows.append((d, " ".join(words[(d * i + i * i) % len(words)] for i in range(1, 40)), None if d % 10 == 9 else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_documents(speech):
    got = langid.identify(speech).collect()
    assert len(got) == 240 and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == list(SPEECH)[r["doc_id"] % 3] for r in got if r["held_out"]]) == 1.0


def test_one_product_equals_kernels_with_landmarks():
    texts, langs = [v[:40] for v in SPEECH.values()] * 2, list(SPEECH) * 2
    model = langid.fit(texts, langs)
    x = langid._unit(langid.presence(["the which und"]))
    landmarks = langid._unit(langid.presence(texts))
    value, vector = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    y = np.where(np.array(langs)[:, None] == np.array(model.languages), 1.0, -1.0)
    phi = landmarks @ landmarks.T @ root
    ridge = np.linalg.solve(phi.T @ phi + langid.RIDGE * np.eye(6), phi.T @ (y - y.mean(axis=0)))
    assert (x @ model.weights + model.base)[0] == pytest.approx((x @ landmarks.T @ root @ ridge + y.mean(axis=0))[0], abs=1e-3)


def test_presence_counts_whole_texts_in_steps(monkeypatch):
    text = prose(4, 400)
    whole = langid.presence([text, "ab"])
    monkeypatch.setattr(langid, "STEP", 50)
    assert (langid.presence([text, "ab"]) == whole).all() and whole[1].sum() == 2 + 1 + 2 + 1  # a, b, blank; ab, b-blank; ab-blank


def test_languages_of_odd_rows(odd, nothing, speech):
    got = langid.identify(odd).collect()
    assert len(got) == 13 and {r["lang_pred"] for r in got} == {"en", "und"}
    assert sum(r["lang_pred"] == "und" for r in got) == 4
    assert langid.identify(nothing).collect() == []
    assert langid.predict(langid.fit([], []), pa.array(["abc"]))[0] == ["und"]


def test_a_language_of_long_texts_is_learnt(spark):
    rows = [(i, " ".join(f"{'ka' if i % 2 else 'zo'}{j % 7}x" for j in range(20 + i)), "ka" if i % 2 else "zo") for i in range(30)] + [(100 + i, "mimu " * (400 + i), "mi") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.train(docs, train_chars=1000).languages) == {"ka", "zo", "mi"}
    assert langid.train(docs, max_languages=2).languages == ["ka", "zo"]
    held = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert held[104] == "mi" and held[1] == "ka" and held[2] == "zo"


def test_a_class_of_long_texts_is_learnt(spark):
    rows = [(i, prose(i, 15 + i % 5), 0) for i in range(200)] + [(1000 + i, prose(500 + i, 30) + " vile scum " * 6 + prose(900 + i, 30), 1) for i in range(60)]
    assert min(len(t) for _, t, toxic in rows if toxic) > 300 > max(len(t) for _, t, toxic in rows if not toxic)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, train_chars=300)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert min(got[i] for i in got if i >= 1000) > 0.5 > max(got[i] for i in got if i < 1000)
