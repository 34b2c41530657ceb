"""Ids of a byte-level BPE for whole texts, each distinct part of a text encoded once."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from tarnlake.llm.tokens import spans

# Fixed value: the added token of the vocabulary. It parts words that are encoded together.
MARK, MARK_ID = "<|endoftext|>", 50256
PARTS_AT_ONCE = 20_000
# Text that is encoded at once: its parts take some twenty times as much memory.
TEXT_BYTES = 2_000_000
# Texts of these characters only are cut by the pattern below exactly as the vocabulary's own rule cuts them: every
# letter among them is listed, the digits are the only numbers and the white space is ASCII. (The rule itself
# tells letters, numbers and white space by their Unicode classes.)
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile(rf"[\t-\r -~{LETTERS}]*").fullmatch
# Fixed pattern: the cut of byte-level BPE, its classes spelled out for simple texts.
PARTS = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[{LETTERS}]+| ?[0-9]+| ?[^\t-\r {LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+").findall


class ByteTokens:
    """Encodes with a byte-level BPE, which never joins the parts that its cut makes of a text.

    The ids of a simple text are the ids of its parts, one after another. Distinct parts are encoded once and
    kept, up to about ``limit`` of them; beyond that the half that was met least goes, which changes no result. Any
    other text, and one that holds the added token, is given to the tokenizer whole.
    """

    def __init__(self, path: str, limit: int = 300_000):
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # A token is spelled with one character for each of its bytes.
        self.octets = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.octets[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self._keep([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _keep(self, parts: list[str], met: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.index: defaultdict[str, int] = defaultdict(None, zip(parts, range(len(parts))))
        self.index.default_factory = self.index.__len__
        self.met, self.lengths, self.ids = met, lengths, ids
        self.starts = np.cumsum(lengths) - lengths

    def _shrink(self) -> None:
        kept = np.sort(np.argsort(-self.met, kind="stable")[:self.limit // 2])
        lengths, chosen = self.lengths[kept], np.zeros(len(self.index), bool)
        chosen[kept] = True
        parts = [p for p, keep in zip(self.index, chosen.tolist()) if keep]
        self._keep(parts, self.met[kept] // 2, lengths, self.ids[spans(self.starts[kept], lengths)])

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _spaced(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of parts that begin with a space and end with none: joined, they are cut
        where they were joined, and the bytes of the ids tell which are whose."""
        ids = self._whole("".join(parts))
        ends = np.searchsorted(np.cumsum(self.octets[ids]), np.cumsum([len(p.encode()) for p in parts])) + 1
        return np.diff(ends, prepend=0), ids

    def _marked(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of any parts, encoded with a mark between them."""
        ids = self._whole(MARK.join(parts))
        cuts = np.flatnonzero(ids == MARK_ID)
        return np.diff(cuts, prepend=-1, append=len(ids)) - 1, np.delete(ids, cuts)

    def _learn(self, parts: list[str]) -> None:
        spaced = np.fromiter((p[0] == " " and not p.isspace() for p in parts), bool, len(parts))
        lengths, starts, found = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), [self.ids]
        used = len(self.ids)
        for encode, places in ((self._spaced, np.flatnonzero(spaced)), (self._marked, np.flatnonzero(~spaced))):
            for at in range(0, len(places), PARTS_AT_ONCE):
                some = places[at:at + PARTS_AT_ONCE]
                sizes, ids = encode([parts[k] for k in some.tolist()])
                lengths[some], starts[some] = sizes, used + np.cumsum(sizes) - sizes
                found.append(ids)
                used += len(ids)
        self.lengths, self.starts = np.concatenate([self.lengths, lengths]), np.concatenate([self.starts, starts])
        self.ids, self.met = np.concatenate(found), np.concatenate([self.met, np.zeros(len(parts), np.int64)])

    def _simple(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > self.limit:
            self._shrink()
        known, codes, n_parts = len(self.index), [], []
        find = self.index.__getitem__
        for text in texts:
            own = PARTS(text)
            codes.append(np.fromiter(map(find, own), np.int64, len(own)))
            n_parts.append(len(own))
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        if len(self.index) > known:
            self._learn(list(self.index)[known:])
        self.met += np.bincount(codes, minlength=len(self.met))
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(n_parts, dtype=np.int64)]
        return np.diff(ends, prepend=0), self.ids[spans(self.starts[codes], lengths)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all their ids one after another."""
        plain = [SIMPLE(t) is not None and MARK not in t for t in texts]
        counts, ids = self._simple([t for t, p in zip(texts, plain) if p])
        if all(plain):
            return counts, ids
        runs, each = iter(np.split(ids, np.cumsum(counts)[:-1])), []
        for text, p in zip(texts, plain):
            each.append(next(runs) if p else self._whole(text))
        return np.array([len(e) for e in each], np.int64), np.concatenate(each)


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    """One store for each Python worker, kept from task to task."""
    return ByteTokens(path)
