import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assocspark.llm import packing, text, token_files, tokens, trie_tokens

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BPE)


def library_ids(t):
    return LIBRARY.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abzAZéÉßœİǅ’' \t\n\x85\x1c<|>1²٣_-.,!日ﬁΣς́"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=5))
def test_ids_equal_the_librarys(texts):
    assert tokens.encode_texts(BPE, texts) == [library_ids(t) for t in texts]


def test_special_tokens_contractions_and_cache_turnover(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 3)
    texts = ["it's we'LL 'start !'s I'm", "<|endoftext|> x<|startoftext|>y", "one two three four five six one two", "É" * 40]
    assert tokens.encode_texts(BPE, texts) == [library_ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=3000), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    data, blocks = token_files.pack_ids(ids, percentile)
    assert (token_files.unpack_ids(memoryview(data), len(ids), blocks) == ids).all()


def test_blocks_use_exceptions_for_outliers():
    ids = np.full(4096, 7, np.uint32)
    ids[::100] = 40_000
    assert len(token_files.pack_ids(ids, 0.9)[0]) < len(token_files.pack_ids(ids, 1.0)[0]) / 5


def test_token_files_hold_every_document_in_order(spark, odd, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    path = text.work_folder(spark)
    token_files.write_token_files(odd, path, BPE, end_id=2, parts=3)
    got = token_files.read_token_files(spark, path).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(d, [*library_ids(t), 2]) for d, t in rows]
    assert sorted((r["start"], r["doc_id"] or -1, r["n_tokens"]) for r in got)[-1][0] == sum(len(i) for _, i in want[:-1])
    assert sorted(((r["doc_id"] or -1), tuple(r["ids"]), r["ids_crc32"]) for r in got) == sorted((d or -1, tuple(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in want)
    known = sorted((r["doc_id"], r["start"]) for r in got if r["doc_id"] is not None)
    assert [s for _, s in known] == sorted(s for _, s in known)


def test_texts_of_one_doc_id_keep_their_order_across_parts(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(7 if k % 4 else 8, f"text {k} {'again ' * (k % 9)}") for k in range(400)] + [(7, None), (7, ""), (7, None)], "doc_id long, text string")
    path = text.work_folder(spark)
    token_files.write_token_files(docs, path, BPE, end_id=2, parts=6)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    want = docs.orderBy("doc_id", F.xxhash64("text"), "text").collect()
    assert [(r["doc_id"], list(r["ids"])) for r in got] == [(r["doc_id"], [*library_ids(r["text"]), 2]) for r in want]
    assert spark.read.parquet(path).select("part").distinct().count() > 2


def test_token_files_of_an_empty_table(spark, nothing):
    path = text.work_folder(spark)
    token_files.write_token_files(nothing, path, BPE)
    assert token_files.read_token_files(spark, path).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40))
def test_best_fit_keeps_to_capacity_and_bound(sizes):
    lengths = np.array(sizes, np.int64)
    bins, places = packing.best_fit_decreasing(lengths, 50)
    used = {}
    for b, p, n in sorted(zip(bins.tolist(), places.tolist(), sizes, strict=True)):
        assert used.get(b, 0) == p
        used[b] = p + n
    assert all(v <= 50 for v in used.values())
    assert packing.lower_bound(lengths, 50) <= len(used)


def test_bound_sees_more_than_the_sum():
    assert packing.lower_bound(np.array([26] * 10), 50) == 10
    assert packing.lower_bound(np.array([17] * 9), 50) == 5
    assert packing.lower_bound(np.array([], np.int64), 50) == 0


def check_packing(rows, docs):
    ids = {}
    for d, t in docs:
        ids.setdefault(d, []).append([*library_ids(t), 0])
    sequences = {}
    for r in rows:
        assert any(zlib.crc32(np.array(i[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] and r["start"] == 2048 * r["piece"] for i in ids[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(n for p in sequences.values() for _, n in p) == sum(len(i) for x in ids.values() for i in x)


def test_packing_of_odd_rows(odd, nothing):
    rows = packing.pack_documents(odd, BPE).collect()
    check_packing(rows, [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert packing.pack_documents(nothing, BPE).collect() == []


def test_partitions_with_gaps_exchange(spark):
    rows = [(i, 0, 0, 300 + i * i * 7919 % 400, i) for i in range(480)]
    parts = spark.createDataFrame(rows, packing.PIECES)
    alone = packing.pack(parts, rounds=0, per_part=24)
    together = packing.pack(parts, rounds=3, per_part=24)
    assert together.count() == 480
    assert together.select("sequence_id").distinct().count() <= alone.select("sequence_id").distinct().count()
    assert together.where("round > 0").count() > 0


def fewest(sizes, capacity):
    """The least number of bins, by trying every assignment up to the naming of bins."""
    best = len(sizes)

    def place(i, used):
        nonlocal best
        if len(used) >= best:
            return
        if i == len(sizes):
            best = len(used)
            return
        for b in range(len(used)):
            if used[b] + sizes[i] <= capacity:
                used[b] += sizes[i]
                place(i + 1, used)
                used[b] -= sizes[i]
        place(i + 1, [*used, sizes[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_bound_and_packing_enclose_the_optimum(sizes):
    optimum = fewest(sizes, 20)
    bins, _ = packing.best_fit_decreasing(np.array(sizes, np.int64), 20)
    assert packing.lower_bound(np.array(sizes, np.int64), 20) <= optimum <= len(set(bins.tolist())) <= 11 / 9 * optimum + 6 / 9
    size, times = np.unique(np.array(sizes, np.int64), return_counts=True)
    assert packing.lower_bound(size, 20, times) == packing.lower_bound(np.array(sizes, np.int64), 20)


def test_partitions_that_meet_their_own_bounds_exchange_until_the_bound_over_all(spark):
    lengths = np.random.default_rng(5).integers(10, 500, 800).tolist()
    parts = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECES)
    bound = packing.lower_bound(np.array(lengths), 2048)
    alone, together = packing.pack(parts, rounds=0, per_part=200), packing.pack(parts, per_part=200)
    assert alone.where("certified").count() > 0 and alone.select("sequence_id").distinct().count() > bound
    assert together.select("sequence_id").distinct().count() == bound
    placed = together.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert together.count() == 800 and max(r[1] for r in placed) <= 2048


def test_equal_pieces_are_dealt_to_many_partitions(spark):
    parts = spark.createDataFrame([(7, 0, 0, 700, 1)] * 600, packing.PIECES)
    rows = packing.pack(parts, per_part=60).selectExpr("sequence_id", "shiftright(sequence_id, 32) AS part").collect()
    assert len(rows) == 600 and len({r["sequence_id"] for r in rows}) <= 300 + 10 and len({r["part"] for r in rows}) == 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=8), max_size=8))
def test_trie_counts_are_those_of_the_best_split(found):
    pieces = {"a": -1.0, "b": -1.5, "ab": -1.75, "abc": -4.5, "bc": -2.25, "c": -3.0, trie_tokens.MARK: -0.5, trie_tokens.MARK + "a": -1.25}
    trie = trie_tokens.Trie(pieces)

    def best(word):
        table = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(table[end - 1][0] + trie.lost, table[end - 1][1] + len(word[end - 1].encode()))]
            options += [(table[s][0] + pieces[word[s:end]], table[s][1] + 1) for s in range(end) if word[s:end] in pieces]
            table.append(max(options, key=lambda o: (o[0], -o[1])))
        return table[-1][1]

    assert [trie.count(trie_tokens.MARK + w) for w in found] == [best(trie_tokens.MARK + w) for w in found]


def test_trie_shares_prefixes_and_starts_anew(monkeypatch):
    trie = trie_tokens.Trie(trie_tokens.load_pieces(PIECES))
    want = trie.count("▁abandon")
    nodes = len(trie.score)
    trie.count("▁abandoned")
    assert len(trie.score) == nodes + 2
    monkeypatch.setattr(trie_tokens, "NODES", 3)
    assert trie.count("▁abandoning") > 0 and trie.count("▁band") > 0 and len(trie.score) == 6 and trie.count("▁abandon") == want


def test_token_counts_of_odd_rows(odd, nothing):
    got = [tuple(r) for r in trie_tokens.token_counts(odd, PIECES).collect()]
    trie = trie_tokens.Trie(trie_tokens.load_pieces(PIECES))
    assert len(got) == 13
    by_id = {d: (n, k) for d, n, k in got if d is not None}
    for r in odd.where("doc_id IS NOT NULL").select("doc_id", "text").collect():
        found = (r["text"] or "").split()
        assert by_id[r["doc_id"]] == (len(found), sum(trie.count("▁" + w) for w in found))
    assert trie_tokens.token_counts(nothing, PIECES).collect() == []


def test_words_drop_nothing_but_white_space():
    got = text.words(pa.array([" a  b\tc\n", None, "", "a"]))
    assert [[got.distinct[int(c)].as_py() for c in got.codes[a:b]] for a, b in zip(got.offsets[:-1], got.offsets[1:], strict=True)] == [["a", "b", "c"], [], [], ["a"]]


def test_vocabulary_file_is_the_one_meant():
    assert json.load(open(BPE))["model"]["end_of_word_suffix"] == "</w>"
    with pytest.raises(Exception):
        tokens.Codec("/nonexistent.json")
