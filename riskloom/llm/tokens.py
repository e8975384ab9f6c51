"""Token ids of many texts by a public tokenizer file, through a per-process memory of words.

For tokenizers that drop white space and never merge across it, and whose special strings hold none
(they get their own ids, also inside a word): a text's ids are the ids of its words, one after another. So each distinct word is encoded once and the rest is look-ups. The
memory is emptied when it holds MEMO_WORDS words; that costs time only.
"""

from __future__ import annotations

import os

import numpy as np

from riskloom.llm.words import PLAIN, ranges, split_words

WORD_BPE = "word_bpe_49k.json"
MEMO_WORDS = 1_000_000
_memos: dict[str, WordMemo] = {}


class WordMemo:
    """Ids of the words met so far, found by the words' hashes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted word hashes; start, length: where their ids are
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, first id of each text and the end)."""
        words = split_words(buf, offsets, PLAIN)
        own, sample, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(own) > MEMO_WORDS:
            self._clear()
        new = np.flatnonzero(~self._has(own))
        if len(new):
            self._learn(own[new], buf, words.starts[sample[new]], words.ends[sample[new]])
        place = np.searchsorted(self.known, own)[back.ravel()]
        lengths = self.length[place]
        first = np.concatenate([[0], np.cumsum(lengths)])[words.first]
        return self.ids[ranges(self.start[place], lengths)], first

    def _has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        return self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] == hashes

    def _learn(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new words in one text; a token belongs to the word in which it begins."""
        found = [buf[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
        encoded = self.tokenizer.encode(" ".join(found), add_special_tokens=False)
        begin = np.cumsum([0, *(len(x) + 1 for x in found[:-1])])
        word = np.searchsorted(begin, np.array([s for s, _ in encoded.offsets], np.int64), "right") - 1
        lengths = np.bincount(word, minlength=len(found)).astype(np.int64)
        start = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.append(self.ids, np.array(encoded.ids, np.uint32))
        at = np.searchsorted(self.known, hashes)
        self.known, self.start, self.length = np.insert(self.known, at, hashes), np.insert(self.start, at, start), np.insert(self.length, at, lengths)


def word_memo(path: str) -> WordMemo:
    """The memory of this process for a tokenizer file."""
    if path not in _memos:
        _memos[path] = WordMemo(path)
    return _memos[path]


def tokenizer_path(name: str = WORD_BPE) -> str:
    """Place of a public tokenizer file on this machine; every executor has the same files."""
    import public_tokenizers

    return public_tokenizers.path(name)
