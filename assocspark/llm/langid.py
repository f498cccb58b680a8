"""Language by string kernels: presence of blended n-grams, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the number of character n-grams (1 to 4 letters, hashed to ``SLOTS``) that both hold, over the root of the product of
how many each holds. Landmarks are training texts; with K their kernel matrix, a text's features are its kernels with the landmarks
times K ** -1/2, and ridge regression on them gives a weight vector per language. For scoring, weights, K ** -1/2 and the landmarks'
presence matrix are multiplied into one matrix of n-grams by languages, so that a batch is one product of its presence matrix with it.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import held_out, sample_ids, trimmed
from .text import id_text, in_steps

#: Training documents and landmarks per language at most.
PER_LANGUAGE = 300
#: Length up to which a document may be drawn for training, and languages that are learnt at most; prediction has neither limit.
TRAIN_CHARS, MAX_LANGUAGES = 50_000, 100
LANDMARKS = 60
SLOTS = 1 << 15
ORDERS = 4
RIDGE = 1e-2
#: Documents of one product, and characters hashed at a time.
ROWS, STEP = 64, 1 << 20
_ALPHA = np.zeros(0, bool)


class Model(NamedTuple):
    languages: list
    weights: np.ndarray  # n-gram slots by languages
    base: np.ndarray


def _letters() -> np.ndarray:
    global _ALPHA
    if not len(_ALPHA):
        _ALPHA = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _ALPHA


def presence(texts: list[str]) -> np.ndarray:
    """Which n-gram slots each text holds; everything but letters counts as a blank."""
    out = np.zeros((len(texts), SLOTS), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), sizes)
    flat = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[flat], flat, 32).astype(np.uint32)
    cells = out.reshape(-1)
    for a in range(0, len(points), STEP):
        part, rows = points[a:a + STEP + ORDERS - 1], row[a:a + STEP + ORDERS - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(1, ORDERS + 1):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:]
            slot = (h * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % (1 << 32))) >> np.uint32(17)
            inside = rows[:len(slot)] == rows[n - 1:n - 1 + len(slot)]
            cells[(rows[:len(slot)] * SLOTS + slot)[inside]] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def fit(texts: list[str], langs: list[str]) -> Model:
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros(0))
    seen: dict = {}
    mark = []
    for i, lang in enumerate(langs):
        seen[lang] = seen.get(lang, 0) + 1
        mark += [i] * (seen[lang] <= LANDMARKS)
    lower = [t.lower() for t in texts]
    landmarks = _unit(presence([lower[i] for i in mark]))
    value, vector = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    y = np.where(np.array(langs)[:, None] == np.array(languages), 1.0, -1.0)
    phi = np.concatenate([_unit(presence(lower[a:a + ROWS])) @ landmarks.T for a in range(0, len(lower), ROWS)]) @ root
    weight = 1.0 / np.array([langs.count(x) for x in langs])
    weight = (weight / weight.mean())[:, None]
    base = (weight * y).mean(axis=0)
    ridge = np.linalg.solve(phi.T @ (weight * phi) + RIDGE * len(phi) / len(mark) * np.eye(len(mark)), phi.T @ (weight * (y - base)))
    return Model(languages, (landmarks.T @ (root @ ridge)).astype(np.float32), base)


def predict(model: Model, texts: pa.StringArray) -> tuple[list, np.ndarray]:
    """Language (``und`` without letters or without a model) and score of each text."""
    readable = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False))
    lower = pc.fill_null(pc.utf8_lower(texts), "").to_pylist()
    names, score = np.full(len(lower), "und", object), np.zeros(len(lower))
    if model.languages:
        for a in range(0, len(lower), ROWS):
            scores = _unit(presence(lower[a:a + ROWS])) @ model.weights + model.base
            best = scores.argmax(axis=1)
            names[a:a + ROWS] = np.array(model.languages, object)[best]
            score[a:a + ROWS] = np.clip((scores[np.arange(len(best)), best] + 1) / 2, 0, 1)
    names[~readable], score[~readable] = "und", 0.0
    return names.tolist(), score


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, train_chars: int = TRAIN_CHARS,
          max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on at most ``per_language`` documents of each language, none of them held out; null ids, texts and languages are left out.

    Samples are drawn from documents of up to ``train_chars`` characters; a language that has none is learnt from its shortest document. Of more than
    ``max_languages`` distinct values the most frequent are learnt (ties: the smaller name), which bounds the model and what the driver holds.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    short = F.length("text") <= train_chars
    top = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(short).alias("short"), F.min(F.struct(F.length("text"), "doc_id")).alias("least")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    sample: list = []
    if usual := [r["lang"] for r in top if r["short"]]:
        chosen, _ = sample_ids(rows.where(short & F.col("lang").isin(usual)), "lang", per_language)
        sample = trimmed(chosen.select("doc_id", "lang", "text").collect(), per_language)
    if long := {r["lang"]: r["least"]["doc_id"] for r in top if not r["short"]}:
        texts = rows.where(F.col("lang").isin(list(long)) & F.col("doc_id").isin(list(long.values())))
        sample += trimmed([r for r in texts.select("doc_id", "lang", "text").collect() if r[0] == long[r[1]]], 1)
    return fit([r[2] for r in sample], [r[1] for r in sample])


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row. Null texts and texts without a letter are ``und`` with score 0; of equal scores the first language by name counts.

    Repeated rows are predicted one by one. Without a usable training row everything is ``und``; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = predict(shared.value, batch.column("text"))
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})

    return id_text(docs, id_col, text_col).mapInArrow(in_steps(work, chars=2_000_000), "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
