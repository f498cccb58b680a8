"""Exact token ids of whole texts by the tokenizers library, with its work shared between equal words.

The tokenizer file lower-cases, drops white space and never joins characters across it, so the ids of a text are the ids of
its white-space separated chunks in order. Chunks are coded per batch by Arrow; only chunks a task has not met lately reach
the library. Chunks of letters, digits and ASCII signs alone are split by the file's own pattern and go straight to its model,
everything else (other scripts, combining marks, special tokens) takes the library's whole path.
"""
from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .text import expand, words

#: Entries in each of the two generations of a worker's chunk cache.
CACHE = 120_000
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(f"[!-~{_LETTERS}]*")
#: Fixed: the tokenizer file's split pattern, for the characters of _PLAIN.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
_codecs: dict = {}


def _byte_letters() -> dict[int, str]:
    """Fixed: how byte-level vocabularies write bytes; printable ones as themselves, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Codec:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self._keep(key, found)
        return found

    def _keep(self, key: str, ids: bytes) -> None:
        if len(self.young) >= CACHE:
            self.young, self.old = {}, self.young
        if len(key) <= 64:
            self.young[key] = ids

    def _model(self, piece: str) -> bytes:
        """Ids of one lower-case pre-token."""
        found = self._known(piece)
        if found is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            found = np.array([t.id for t in self.tokenize(shown)], "<u4").tobytes()
            self._keep(piece, found)
        return found

    def chunk(self, chunk: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without white space."""
        low = chunk.lower()
        if len(low) > 10_000 or "<|" in low or not _PLAIN.fullmatch(low):
            found = self._known("\0" + chunk)
            if found is None:
                found = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
                self._keep("\0" + chunk, found)
            return found
        pieces = _PIECES.findall(low)
        return self._model(low) if len(pieces) == 1 else b"".join(map(self._model, pieces))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch as one array, and where each text's ids begin and end (one more entry than texts)."""
        codes, offsets, distinct = words(texts)
        known = [self.chunk(w) for w in distinct.to_pylist()]
        lengths = np.fromiter((len(b) >> 2 for b in known), np.int64, len(known))
        pool, starts = np.frombuffer(b"".join(known), "<u4"), np.concatenate([[0], np.cumsum(lengths)])
        each = lengths[codes] if len(codes) else np.zeros(0, np.int64)
        ids = pool[expand(starts[:-1][codes], each)] if len(codes) else np.zeros(0, "<u4")
        return ids, np.concatenate([[0], np.cumsum(each)])[offsets]


def codec(path: str) -> Codec:
    """One per worker process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_texts(path: str, texts: list[str]) -> list[list[int]]:
    ids, bounds = codec(path).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
