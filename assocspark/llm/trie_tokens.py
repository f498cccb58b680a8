"""Token counts under a unigram vocabulary: forward scores shared in a trie of pre-tokens.

Each word, with the vocabulary's word mark before it, is split into the pieces whose log probabilities add up to most (of equals, the fewest
pieces). The best score up to a character depends on the characters before it alone, so words are put in a trie and every node is scored
once, whichever words pass through it; a word's count is that of its last node. Tasks keep their trie between batches and start it anew
when it is full, so memory is bounded and no word is exchanged between tasks.

A public piece file lists pieces by rank without probabilities; rank r counts as 1 / (r + ``OFFSET``), normalised (Zipf-Mandelbrot).
Characters that no piece covers fall back to one token per UTF-8 byte.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import id_text, in_steps, words

OFFSET = 2.7
#: Log probability that a character outside the vocabulary loses against the rarest piece.
UNKNOWN = 10.0
#: Fixed: the word mark of the piece file.
MARK = "▁"
#: Nodes of a trie, and words in each of the two generations of terminals, that a worker keeps.
NODES, TERMINALS = 500_000, 150_000
_tries: dict = {}


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with their log probabilities; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    weight = -np.log(np.arange(len(pieces)) + OFFSET)
    return dict(zip(pieces, (weight - np.log(np.exp(weight).sum())).tolist(), strict=True))


class Trie:
    """Nodes with the best score and the number of tokens of the characters from the root."""

    def __init__(self, pieces: dict[str, float]):
        self.lost = min(pieces.values(), default=0.0) - UNKNOWN
        self.endings: dict = {}  # pieces by their characters from the last to the first, the log probability under ""
        for piece, p in pieces.items():
            at = self.endings
            for c in reversed(piece):
                at = at.setdefault(c, {})
            at[""] = p
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]

    def count(self, word: str) -> int:
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                if len(self.score) > NODES:
                    self.clear()
                found = self.tokens[self._insert(word)]
            if len(word) <= 64:
                if len(self.young) >= TERMINALS:
                    self.young, self.old = {}, self.young
                self.young[word] = found
        return found

    def _insert(self, word: str) -> int:
        child, score, tokens = self.child, self.score, self.tokens
        if len(word) > 256:  # such words share no prefix worth keeping
            child, score, tokens = {}, [0.0], [0]
        path, node = [0], 0
        for end, c in enumerate(word):
            key = (node, c)
            nxt = child.get(key)
            if nxt is None:
                best, least = score[node] + self.lost, tokens[node] + (1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass")))
                at = self.endings
                for start in range(end, -1, -1):
                    at = at.get(word[start])
                    if at is None:
                        break
                    p = at.get("")
                    if p is not None:
                        before = path[start]
                        s = score[before] + p
                        if s > best or s == best and tokens[before] < least:
                            best, least = s, tokens[before] + 1
                nxt = len(score)
                score.append(best)
                tokens.append(least)
                child[key] = nxt
            node = nxt
            path.append(node)
        if child is not self.child:
            self.score.append(score[node])
            self.tokens.append(tokens[node])
            return len(self.tokens) - 1
        return node


def trie(path: str) -> Trie:
    """One per worker process and vocabulary."""
    if path not in _tries:
        _tries[path] = Trie(load_pieces(path))
    return _tries[path]


def token_counts(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens of every row's whole text; null and empty texts have none, repeated rows are counted one by one."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, offsets, distinct = words(batch.column("text"))
        count = trie(vocabulary).count
        each = np.fromiter((count(MARK + w) if w else 0 for w in distinct.to_pylist()), np.int64, len(distinct))
        total = np.concatenate([[0], np.cumsum(each[codes] if len(codes) else np.zeros(0, np.int64))])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(offsets)), "n_tokens": pa.array(np.diff(total[offsets]))})

    return id_text(docs, id_col, text_col).mapInArrow(in_steps(work), "doc_id long, n_words long, n_tokens long")
