"""A bidirectional FM-index over word ids, for phrases of bounded length.

The index of a text holds its rows (all places, ordered by their first
``depth`` words), the Burrows-Wheeler transform (the word before each row) and
the LF order (a stable sort of the transform).  A phrase is an interval of rows
of the text's index and one of the reversed text's: extending it to the left by
every word that occurs there is one pass over the LF order, in which equal words
from one interval lie next to each other; to the right likewise in the other
index.  The second interval follows from the first: children of one phrase lie
in order of the word added, after the separators.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0  # ends every piece; no phrase holds it


def order_of(keys: np.ndarray) -> np.ndarray:
    """Stable order of non-negative integers, 16 bits at a time."""
    order, shift, top = None, 0, int(keys.max(initial=0))
    while order is None or top >> shift:
        digit = ((keys if order is None else keys[order]) >> shift).astype(np.uint16)
        by = np.argsort(digit, kind="stable")
        order, shift = by if order is None else order[by], shift + 16
    return order


class Direction:
    """Index of one reading direction."""

    def __init__(self, text: np.ndarray, depth: int):
        rows = np.arange(len(text))
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        for k in range(depth - 1, -1, -1):
            rows = rows[order_of(padded[rows + k])]
        self.bwt = text[rows - 1]  # the word before the first place is the last one, a separator
        self.lf = order_of(self.bwt)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text))])

    def extend(self, low: np.ndarray, size: np.ndarray):
        """All extensions of the intervals by one word: (parent, word, low,
        size, number of smaller words after the parent's separators)."""
        owner = np.full(len(self.bwt), -1, np.int64)
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        owner[at] = np.repeat(np.arange(len(low)), size)
        owner, word = owner[self.lf], self.bwt[self.lf]
        live = np.flatnonzero((owner >= 0) & (word != SEPARATOR))
        owner, word = owner[live], word[live]
        if not len(live):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])]))
        parent, word, child, count = owner[first], word[first], live[first], np.diff(np.append(first, len(live)))
        by = np.argsort(parent, kind="stable")  # within a parent by word
        before = np.cumsum(count[by]) - count[by]
        head = np.concatenate([[True], parent[by][1:] != parent[by][:-1]])
        sums = np.bincount(parent, weights=count, minlength=len(low)).astype(np.int64)
        smaller = np.empty(len(by), np.int64)
        smaller[by] = before - np.repeat(before[head], np.diff(np.append(np.flatnonzero(head), len(by))))
        return parent, word, child, count, smaller + (size - sums)[parent]


def phrases(text: np.ndarray, depth: int, least: int = 1):
    """Yields, for the lengths from 1 to ``depth``, (words, counts, suffix,
    prefix): the phrases of a text of word ids that ends with a separator, how
    often each occurs, and which phrases of the length before it extends to the
    left (its suffix) and to the right (its prefix).  A phrase of fewer than
    ``least`` occurrences is left out, and with it all that hold it."""
    if not len(text):
        return
    left = Direction(text, depth - 1 or 1)
    right = Direction(text[::-1][np.r_[1:len(text), 0]], depth - 1 or 1) if depth > 1 else left
    size = np.diff(left.start)
    words = np.flatnonzero((size >= least) & (np.arange(len(size)) != SEPARATOR))
    low = back = left.start[words]
    size, words = size[words], words[:, None]
    yield words, size, None, None
    for _ in range(depth - 1):
        suffix, first, down, count, shift = left.extend(low, size)
        prefix, last, up, _, gap = right.extend(back, size)
        # the same phrases from both sides: in order of their rows
        one, two = np.argsort(down), np.argsort(low[prefix] + gap)
        suffix, first, down, count, shift = (x[one] for x in (suffix, first, down, count, shift))
        prefix, up = prefix[two], up[two]
        rows = back[suffix] + shift
        assert np.array_equal(rows, up)
        keep = count >= least
        words = np.concatenate([first[keep, None], words[suffix[keep]]], axis=1)
        low, back, size = down[keep], rows[keep], count[keep]
        yield words, size, suffix[keep], prefix[keep]
