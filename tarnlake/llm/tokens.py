"""Token ids of whole texts, encoded once a distinct word."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Fixed value: an added token of the vocabulary; it separates words that are encoded together.
MARK, MARK_ID = "<|startoftext|>", 49406
WORDS_AT_ONCE = 2000
# Text that is encoded at once, as its ids and their places take about twenty times as much memory.
TEXT_BYTES = 2_000_000
# Words of these characters are cut into parts by the pattern below exactly as the vocabulary's own rule cuts them, and
# normalising only puts them in lower case: each letter stays a single one, no apostrophe starts a contraction, and no
# angle bracket an added token.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile(rf"[{LETTERS}!-&(-;=-~]+").fullmatch
PARTS = re.compile(f"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+").findall
# Byte-level spelling: printable bytes of Latin-1 are themselves, the others follow 255 in order; a space parts words.
BYTES = np.arange(256, dtype="<u4")
BYTES[[*range(0x20), *range(0x7F, 0xA1), 0xAD]] = np.arange(256, 256 + 67) + np.r_[np.zeros(32, int), np.ones(35, int)]


class WordTokens:
    """Encodes with a tokenizer that never joins words across ASCII white space.

    The ids of a text are then the ids of its words, one after another. Distinct words are encoded and kept,
    up to about ``limit`` of them; beyond that the half that was met least goes, which changes no result.
    """

    def __init__(self, path: str, limit: int = 250_000):
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self._keep([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _keep(self, words: list[bytes], met: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.index: defaultdict[bytes, int] = defaultdict(None, zip(words, range(len(words))))
        self.index.default_factory = self.index.__len__
        self.met, self.lengths, self.ids = met, lengths, ids
        self.starts = np.cumsum(lengths) - lengths

    def _shrink(self) -> None:
        kept = np.sort(np.argsort(-self.met, kind="stable")[:self.limit // 2])
        lengths, chosen = self.lengths[kept], np.zeros(len(self.index), bool)
        chosen[kept] = True
        words = [w for w, keep in zip(self.index, chosen.tolist()) if keep]
        self.index.default_factory = None  # else the old index stays in memory, held by itself
        self._keep(words, self.met[kept] // 2, lengths, self.ids[spans(self.starts[kept], lengths)])

    def _ids(self, text: str) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype=np.uint32)

    def _simple(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of simple words: their parts are given to the model spelled byte by byte."""
        parts = [[w] if w.isalpha() else PARTS(w) for w in words]
        n_parts = np.fromiter(map(len, parts), np.int64, len(parts))
        octets = np.frombuffer(" ".join(chain.from_iterable(parts)).lower().encode(), np.uint8)
        spelled = BYTES[octets].tobytes().decode("utf-32-le")
        tokens = [self.model.tokenize(part) for part in spelled.split(" ")]
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))[np.cumsum(n_parts) - 1]
        ids = np.fromiter((t.id for t in chain.from_iterable(tokens)), np.uint32, ends[-1])
        return np.diff(ends, prepend=0), ids

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of any words, encoded with a mark between them."""
        if any(MARK in w for w in words):
            each = [self._ids(w) for w in words]
            return np.array([len(ids) for ids in each], np.int64), np.concatenate(each)
        ids = self._ids(MARK.join(words))
        cuts = np.flatnonzero(ids == MARK_ID)
        return np.diff(cuts, prepend=-1, append=len(ids)) - 1, np.delete(ids, cuts)

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words, many in one call."""
        texts = b" ".join(words).decode("utf-8", "replace").split(" ")
        simple = np.fromiter((SIMPLE(w) is not None for w in texts), bool, len(texts))
        starts, lengths, stored = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [self.ids]
        used = len(self.ids)
        for kind in (True, False):
            places = np.flatnonzero(simple == kind)
            for at in range(0, len(places), WORDS_AT_ONCE):
                some = places[at:at + WORDS_AT_ONCE]
                chosen = [texts[k] for k in some.tolist()]
                sizes, ids = (self._simple if kind else self._marked)(chosen)
                lengths[some], starts[some] = sizes, used + np.cumsum(sizes) - sizes
                stored.append(ids)
                used += len(ids)
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate(stored)
        self.met = np.concatenate([self.met, np.zeros(len(texts), np.int64)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each UTF-8 text, and all their ids one after another."""
        if len(self.index) > self.limit:
            self._shrink()
        known, words, n_words = len(self.index), [], []
        for text in texts:
            own = text.split()
            words += own
            n_words.append(len(own))
        # Only the distinct words of these texts are looked up.
        coded = pa.array(words, pa.large_binary()).dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        codes = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        if new := len(self.index) - known:
            self._learn(list(islice(reversed(self.index), new))[::-1])
        self.met[codes] += np.bincount(at, minlength=len(distinct))
        codes = codes[at]
        lengths = self.lengths[codes]
        word_ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(n_words, dtype=np.int64)]
        return np.diff(word_ends, prepend=0), self.ids[spans(self.starts[codes], lengths)]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one span after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


@lru_cache(maxsize=2)
def word_tokens(path: str, limit: int = 250_000) -> WordTokens:
    """One store for each Python worker, kept from task to task."""
    return WordTokens(path, limit)


def slices(texts, most_bytes: int = 8_000_000):
    """Cut a list of texts into runs of about ``most_bytes``, so that memory stays bounded."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= most_bytes:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_slices(column: pa.Array, most_bytes: int = 8_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of about ``most_bytes`` of a binary column without nulls: the first row's place and the texts. Only those of
    one run become Python objects at a time."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        past = ends[start - 1] if start else 0
        stop = min(len(ends), int(np.searchsorted(ends, past + most_bytes)) + 1)
        yield start, column.slice(start, stop - start).to_pylist()
        start = stop
