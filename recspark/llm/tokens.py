"""Token ids of whole texts with the tokenizers library.

Byte-level BPE splits a text by one pattern and encodes each piece on its own,
so the ids of a piece can be kept: a worker remembers the pieces it has seen
(``CACHE`` of them) and sends only new ones through the library, in batches:
those that begin with a blank as one text, which the library splits again.
Pieces are found here only in texts of characters on which every Unicode
version agrees; any other text goes through the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import islice

import numpy as np
import public_tokenizers

from recspark.llm.common import HELD

KIND = "tokens"
TOKENIZER = "byte_bpe_50k.json"
CACHE = 500_000
_PLAIN = re.compile("[^\t\n\x0b\x0c\r -~\xa1-ɏ]")


def _class(kind: str) -> str:
    """Characters of a Unicode category among the plain ones."""
    return "".join(re.escape(chr(c)) for c in range(33, 0x250) if unicodedata.category(chr(c))[0] == kind)


_LETTER, _DIGIT = _class("L"), _class("N")
# public_tokenizers.PATTERN on plain characters, without Unicode properties
_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+")
_LOADED: dict[str, "Encoder"] = {}


class _Codes(dict):
    """Number of each kept piece; a new one gets the next number in ``fresh``."""

    def __init__(self):
        self.fresh: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        return self.fresh.setdefault(piece, len(self) + len(self.fresh))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # such strings in a text are ordinary text
        vocab = self.library.get_vocab()
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of a token: one character each
        self.length[list(vocab.values())] = list(map(len, vocab))
        self._forget()

    def _forget(self) -> None:
        self.kept = _Codes()
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)  # of the kept pieces, by number

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and where each one's end, by one call for all of them."""
        e = self.library.encode(new, is_pretokenized=True, add_special_tokens=False)
        return np.array(e.ids, dtype="<u4"), np.searchsorted(np.array(e.word_ids), np.arange(1, len(new) + 1))

    def _joined(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of a blank and more, which the library finds
        again in one text, without the cost of a text each; bytes tell them apart."""
        ids = np.frombuffer(self._library(["".join(new)])[0], "<u4")
        at = np.cumsum(self.length[ids])
        want = np.cumsum(np.fromiter((len(p.encode()) for p in new), np.int64, len(new)))
        ends = np.searchsorted(at, want, "right")
        if len(ids) and (ends > 0).all() and (at[ends - 1] == want).all() and ends[-1] == len(ids):
            return ids, ends
        return self._pieces(new)

    def _fresh(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        blank = np.fromiter((p[0] == " " and not p.isspace() for p in new), bool, len(new))
        ids, size = [], np.zeros(len(new), np.int64)
        for at, how in ((np.flatnonzero(blank), self._joined), (np.flatnonzero(~blank), self._pieces)):
            if len(at):
                some, ends = how([new[i] for i in at.tolist()])
                ids.append(some)
                size[at] = np.diff(ends, prepend=0)
        # back into the order of ``new``
        order = np.argsort(~blank, kind="stable")
        first = np.empty(len(new), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        return _gather(np.concatenate(ids), first, size), np.cumsum(size)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        plain, codes, other, code = [], [], [], self.kept.__getitem__
        for i, t in enumerate(texts):
            if _PLAIN.search(t):
                other.append(i)
                continue
            pieces = _PIECES.findall(t)
            plain.append(i)
            codes.append(np.fromiter(map(code, pieces), np.int32, len(pieces)))
        ids, ends, fresh = self.ids, self.ends, self.kept.fresh
        if fresh:
            new, at = self._fresh(list(fresh))
            ids, ends = np.concatenate([ids, new]), np.concatenate([ends, len(ids) + at])
        if plain:
            n = np.fromiter(map(len, codes), np.int64, len(codes))
            codes = np.concatenate(codes)
            size = np.diff(ends)[codes]
            found = _gather(ids, ends[codes], size).tobytes()
            edges = 4 * np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
            for i, lo, hi in zip(plain, edges[:-1].tolist(), edges[1:].tolist()):
                out[i] = found[lo:hi]
        self._keep(ids, ends)
        for i, ids in zip(other, self._library([texts[i] for i in other])):
            out[i] = ids
        return out

    def _keep(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """What comes early is what is frequent, so a full cache stays, unless
        the texts have become other ones."""
        kept, fresh = self.kept, self.kept.fresh
        if len(fresh) > CACHE // 8 and len(kept) == CACHE:
            self._forget()
            base, self.ends = len(kept), ends[len(kept):len(kept) + CACHE + 1] - ends[len(kept)]
            self.ids = ids[ends[base]:][:self.ends[-1]].copy()
            self.kept.update(zip(islice(fresh, CACHE), range(CACHE)))
        elif fresh:
            kept.update(islice(fresh.items(), CACHE - len(kept)))
            self.ends = ends[:len(kept) + 1].copy()
            self.ids = ids[:self.ends[-1]].copy()
        self.kept.fresh = {}


def _gather(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[first], values[first + 1], .. of each range, one after the other."""
    return values[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def encoder(path: str | None = None) -> Encoder:
    """This worker's encoder of a tokenizer file, held between tasks of ``KIND``."""
    path = path or public_tokenizers.path(TOKENIZER)
    HELD[KIND] = _LOADED
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
