"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are per document, so tokens are labelled first: a token of a toxic training document is toxic if its word or its opening letters occur in
toxic documents far more often than in others (signed log-likelihood ratio). A two-state chain is then fitted to these tags; its
emissions are weights of hashed word features, its transitions let spans hang together. Scoring runs forward-backward over every
chain of a text; the marginals give spans, and their sum and maximum give the document's score through a logistic function fitted to the training documents.

Chains are ``CHAIN`` tokens long, so a text of any length is tagged in vectors over chains. The model is a few megabytes whatever the input.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import held_out, sample_ids, trimmed
from .text import expand, id_text, in_steps, polynomial, span, stage, string_hashes, words

#: Training documents taken per label at most, and the length up to which one may be taken; scoring has no such limit.
PER_LABEL = 1500
TRAIN_CHARS = 20_000
#: Documents of a class that has only longer ones.
SHORTEST = 20
CHAIN = 64
#: Hash slots of emission features.
SLOTS = 1 << 18
#: Least evidence that a feature marks toxic documents (besides 1.6 log of how many features are looked at), and the share of its documents that
#: must be toxic (at equal class sizes).
EVIDENCE, PURITY = 10.0, 0.9
SKETCH = 8
#: Training documents summed up at a time, and chains of one step of the fit.
PART, TOGETHER = 200, 3000
SPAN = "array<struct<begin: int, end: int>>"


class Model(NamedTuple):
    weights: np.ndarray  # of feature slots; the last entry is the bias
    moves: np.ndarray  # log transitions [from, to]
    begin: float  # log odds that a chain begins toxic
    outer: np.ndarray  # of the document's features: 1, log(1 + sum), log odds of the maximum
    prior: float


def features(distinct: pa.StringArray) -> np.ndarray:
    """Slots of each distinct word (letters only, lower case): the word, its first five and four letters, its last four."""
    bare = pc.replace_substring_regex(pc.utf8_lower(distinct), r"[^\pL]+", "")
    parts = (bare, pc.utf8_slice_codeunits(bare, 0, 5), pc.utf8_slice_codeunits(bare, 0, 4), pc.utf8_slice_codeunits(bare, -4))
    return np.stack([((string_hashes(p) ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64))) % np.uint64(SLOTS)).astype(np.int64) for i, p in enumerate(parts)], axis=1)


def chains(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of every chain of a batch, in order."""
    n = np.diff(offsets)
    count = -(-n // CHAIN)
    first = np.repeat(offsets[:-1], count) + CHAIN * expand(np.zeros(len(n), np.int64), count)
    return first, np.minimum(CHAIN, np.repeat(offsets[1:], count) - first)


def marginals(score: np.ndarray, first: np.ndarray, length: np.ndarray, moves: np.ndarray, begin: float) -> tuple[np.ndarray, tuple]:
    """Probability that each token is toxic, by forward and backward ratios of the two states; and the ratios of the padded chains."""
    at = np.minimum(first[:, None] + np.arange(CHAIN), max(len(score) - 1, 0))
    inside = np.arange(CHAIN) < length[:, None]
    odds = np.exp(np.clip(score, -30, 30))[at].T if len(score) else np.zeros((CHAIN, len(first)))
    live = inside.T
    (oo, ot), (to, tt) = np.exp(moves)
    ahead, back = np.empty_like(odds), np.ones_like(odds)
    ahead[0] = odds[0] * np.exp(begin)
    for t in range(1, CHAIN):
        ahead[t] = np.minimum(odds[t] * (ot + tt * ahead[t - 1]) / (oo + to * ahead[t - 1]), 1e30)
    for t in range(CHAIN - 2, -1, -1):
        later = odds[t + 1] * back[t + 1]
        back[t] = np.where(live[t + 1], (to + tt * later) / (oo + ot * later), 1.0)
    both = ahead * back
    p = np.zeros(len(score))
    p[at[inside]] = (both / (1 + both)).T[inside]
    return p, (at, inside, odds, ahead, back)


def _fit_chain(slots: np.ndarray, tags: np.ndarray, first: np.ndarray, length: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Maximum likelihood with a quadratic penalty, by Adam; gradients are tags minus marginals."""
    theta, m, v = np.zeros(SLOTS + 6), np.zeros(SLOTS + 6), np.zeros(SLOTS + 6)
    theta[SLOTS] = -1.0
    n = max(len(tags), 1)
    head = np.zeros(len(tags), bool)
    head[first] = True
    pairs = tags[:-1] * 2 + tags[1:]
    seen = np.bincount(pairs[~head[1:]], minlength=4)
    for step in range(1, steps + 1):
        moves = theta[SLOTS + 1:SLOTS + 5].reshape(2, 2)
        oo, ot, to, tt = np.exp(moves).reshape(-1)
        grad = np.zeros_like(theta)
        grad[SLOTS + 1:SLOTS + 5] = seen
        for i in range(0, len(first), TOGETHER):
            start, size = first[i:i + TOGETHER], length[i:i + TOGETHER]
            rows = slots[start[0]:start[-1] + size[-1]]
            own = start - start[0]
            p, (_, inside, odds, ahead, back) = marginals(theta[rows].sum(axis=1) + theta[SLOTS], own, size, moves, theta[-1])
            slope = tags[start[0]:start[-1] + size[-1]] - p
            grad[:SLOTS] += np.bincount(rows.reshape(-1), np.repeat(slope, rows.shape[1]), SLOTS)
            grad[SLOTS] += slope.sum()
            grad[-1] += slope[own].sum()
            near, nxt = ahead[:-1], odds[1:] * back[1:]
            each = np.stack([oo + 0 * near, ot * nxt, to * near, tt * near * nxt])
            each /= each.sum(axis=0)
            each *= inside.T[1:]
            grad[SLOTS + 1:SLOTS + 5] -= each.sum(axis=(1, 2))
        grad = grad / n - 1e-6 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:SLOTS + 1], theta[SLOTS + 1:SLOTS + 5].reshape(2, 2), float(theta[-1])


def summaries(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document: 1, log(1 + expected toxic tokens), log odds of the most toxic one."""
    n = np.diff(offsets)
    total = np.diff(np.concatenate([[0], np.cumsum(p)])[offsets])
    top = np.zeros(len(n))
    if len(p):
        top[n > 0] = np.maximum.reduceat(p, offsets[:-1][n > 0])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(n)), np.log1p(np.maximum(total, 0)), np.log(top / (1 - top))], axis=1)


def _summaries_of(score: np.ndarray, offsets: np.ndarray, moves: np.ndarray, begin: float) -> np.ndarray:
    own = offsets - offsets[0]
    return summaries(marginals(score[offsets[0]:offsets[-1]], *chains(own), moves, begin)[0], own)


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 0.1
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta = beta + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
    return beta


def copy_groups(codes: np.ndarray, offsets: np.ndarray, distinct: pa.StringArray) -> np.ndarray:
    """A group per text of the sample; a text joins an earlier one that shares half of its ``SKETCH`` smallest five-word hashes.

    Copies of one document are one witness: whatever odd words it holds would otherwise look like evidence.
    """
    sums = polynomial(string_hashes(distinct)[codes])
    index: dict[int, list[int]] = {}
    group = np.zeros(len(offsets) - 1, np.int64)
    for d, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        at = np.arange(a, max(a + 1, b - 4)) if b > a else np.zeros(0, np.int64)
        sketch = np.unique(span(sums, at, np.minimum(at + 5, b)))[:SKETCH].tolist()
        votes: dict[int, int] = {}
        for value in sketch:
            for leader in index.get(value, ()):
                votes[leader] = votes.get(leader, 0) + 1
        best = max(votes, key=votes.get, default=None)
        if best is not None and 2 * votes[best] >= len(sketch):
            group[d] = best
        else:
            group[d] = d
            for value in sketch:
                index.setdefault(value, []).append(d)
    return group


def fit(texts: list[str], toxic: list[int], sizes: dict[int, int]) -> Model:
    """Model from labelled texts; ``sizes`` are the numbers of labelled documents of each class that the sample stands for."""
    y = np.array(toxic, np.int64)
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(set(toxic)) < 2:
        return Model(np.zeros(SLOTS + 1), np.zeros((2, 2)), 0.0, np.array([np.log((prior + 1e-3) / (1 - prior + 1e-3)), 0.0, 0.0]), prior)
    codes, offsets, distinct = words(pa.array(texts, pa.string()))
    by_word = features(distinct)
    pa.default_memory_pool().release_unused()
    doc = np.repeat(np.arange(len(y)), np.diff(offsets))
    group = copy_groups(codes, offsets, distinct)
    leads = group == np.arange(len(y))
    n1, n0 = max(1, int((y * leads).sum())), max(1, int(((1 - y) * leads).sum()))
    marked = np.zeros(len(distinct), bool)
    for f in range(3):  # the word and its beginnings
        key = np.unique(group[doc] * SLOTS + by_word[codes, f])
        slot, label = key % SLOTS, y[key // SLOTS]
        k1, k0 = np.bincount(slot, label, SLOTS), np.bincount(slot, 1 - label, SLOTS)
        with np.errstate(divide="ignore", invalid="ignore"):
            expected = (k1 + k0) * n1 / (n1 + n0)
            ratio = 2 * (np.where(k1 > 0, k1 * np.log(k1 / expected), 0) + np.where(k0 > 0, k0 * np.log(k0 / np.maximum(k1 + k0 - expected, 1e-9)), 0))
            pure = (k1 / n1) / np.maximum(k1 / n1 + k0 / n0, 1e-12)
        least = max(EVIDENCE, 1.6 * np.log(max(1, int((k1 + k0 >= 3).sum()))))
        marked |= ((ratio > least) & (pure > PURITY) & (k1 >= 3))[by_word[:, f]]
    tags = (marked[codes] & (y[doc] == 1)).astype(np.int64)
    first, length = chains(offsets)
    hot = np.add.reduceat(tags, first) > 0 if len(first) else np.zeros(0, bool)
    keep = hot | (np.arange(len(first)) % max(1, int((~hot).sum() / max(1, 2 * hot.sum()))) == 0)
    where = expand(first[keep], length[keep])
    ends = np.cumsum(length[keep])
    weights, moves, begin = _fit_chain(by_word.astype(np.int32)[codes[where]], tags[where], ends - length[keep], length[keep])
    score = (weights[by_word].sum(axis=1) + weights[SLOTS])[codes]
    x = np.concatenate([_summaries_of(score, offsets[a:a + PART + 1], moves, begin) for a in range(0, len(y), PART)])
    share = np.where(y == 1, sizes.get(1, 1) / y.sum(), sizes.get(0, 1) / (1 - y).sum())
    return Model(weights, moves, begin, _fit_logistic(x, y.astype(float), share / share.mean()), prior)


def tag(model: Model, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document scores, token marginals and where each document's tokens begin and end."""
    codes, offsets, distinct = words(texts)
    score = (model.weights[features(distinct)].sum(axis=1) + model.weights[SLOTS])[codes] if len(codes) else np.zeros(0)
    first, length = chains(offsets)
    p, _ = marginals(score, first, length, model.moves, model.begin)
    return 1 / (1 + np.exp(-np.clip(summaries(p, offsets) @ model.outer, -30, 30))), p, offsets


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = PER_LABEL, train_chars: int = TRAIN_CHARS) -> Model:
    """Fit on at most ``per_label`` labelled documents of either class, none of them held out. Null labels and ids are left out; of several labels of a document the largest counts.

    Samples are drawn from documents of 1 to ``train_chars`` characters; a class that has none is learnt from its shortest documents.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = stage(known.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    texts = id_text(docs, id_col, text_col).where(F.length("text") >= 1)
    length = texts.select("doc_id", F.length("text").alias("chars")).join(known, "doc_id").groupBy("toxic", "doc_id").agg(F.min("chars").alias("chars"))
    usable = stage(length)
    chosen, drawn = sample_ids(usable.where(F.col("chars") <= train_chars).select("doc_id", "toxic"), "toxic", per_label)
    for label in sizes.keys() - drawn.keys():
        chosen = chosen.unionByName(usable.where(F.col("toxic") == label).orderBy("chars", "doc_id").limit(SHORTEST).select("doc_id", "toxic"))
    limit = F.when(F.col("toxic").isin(list(drawn)), train_chars).otherwise(1 << 30) if drawn else F.lit(1 << 30)
    rows = texts.join(F.broadcast(chosen), "doc_id").where(F.length("text") <= limit).select("doc_id", "toxic", "text").collect()  # at most 2.4 per_label short texts a class
    rows = trimmed(rows, per_label)
    return fit([r[2] for r in rows], [r[1] for r in rows], sizes)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, score and, if asked, the spans of tokens (in words) whose marginal is 0.5 or more, for every row. Null and empty texts have no toxic token."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, p, offsets = tag(shared.value, batch.column("text"))
        out = {"doc_id": batch.column("doc_id"), "score": pa.array(value)}
        if spans:
            on = np.concatenate([[False], p >= 0.5, [False]])
            start, end = np.flatnonzero(on[1:-1] & (~on[:-2] | np.isin(np.arange(len(p)), offsets))), None
            stop = np.flatnonzero(on[1:-1] & (~on[2:] | np.isin(np.arange(len(p)) + 1, offsets))) + 1
            doc = np.searchsorted(offsets, start, side="right") - 1
            end = pa.StructArray.from_arrays([pa.array((start - offsets[doc]).astype(np.int32)), pa.array((stop - offsets[doc]).astype(np.int32))], ["begin", "end"])
            bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(value)))]).astype(np.int32)
            out["spans"] = pa.ListArray.from_arrays(pa.array(bounds), end)
        return pa.RecordBatch.from_pydict(out)

    return id_text(docs, id_col, text_col).mapInArrow(in_steps(work, chars=1_500_000), "doc_id long, score double" + (f", spans {SPAN}" if spans else ""))


def classify(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """Train, then doc_id, held_out, score and predicted (score of 0.5 or more) for every row. Null and empty texts get the score of a text without toxic tokens.

    Repeated rows are scored one by one; an empty table gives no rows.
    """
    model = train(docs, labels, **names)
    return score(docs, model, **{k: v for k, v in names.items() if k in ("id_col", "text_col")}).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose score is under ``least``; null and empty texts count as texts without toxic tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = names[docs.columns.index(text_col)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, _, _ = tag(shared.value, batch.column(body))
        return batch.filter(pa.array(value < least))

    plain = docs.toDF(*names)
    return plain.mapInArrow(in_steps(work, body, chars=1_500_000), plain.schema).toDF(*docs.columns)
