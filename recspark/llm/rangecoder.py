"""Adaptive range coder of token ids, many blocks in step.

A block of up to ``BLOCK`` ids is coded by a model that starts empty (blocks
are independent).  Each id is predicted by a mixture of three orders:

* order 2 and order 1 each predict the id that last followed the same two
  ids, or the same id; a confidence of 0 to 3 counts how often it was right;
* which of them is right (order 2, order 1, neither) is coded with adaptive
  frequencies chosen by both confidences and by whether they agree: these
  frequencies are the mixing weights, learned block by block;
* where neither is right, order 0 codes the id as four hexadecimal digits,
  each with adaptive frequencies under the digits before it (the last digit's
  contexts are hashed).

A carry-less 32-bit range coder turns the frequencies into bytes.  All blocks
of a call are coded in lock-step, one numpy operation handling one step of
every block; all arithmetic is on integers, so a decoder on any machine takes
the same steps.

Format of a payload (little endian): ``b"CMR1"``, number of ids (u32), block
length (u32), number of blocks (u32); per block: bytes (u32), crc32 of the
block's ids as u32 (u32); then the blocks' bytes.  ``decode`` checks each crc.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR1"
BLOCK = 2048
_TOP, _BOT = np.uint32(1 << 24), np.uint32(1 << 16)
_LAST = 512                                     # hashed contexts of the last digit
_NODES = 1 + 16 + 256 + _LAST
_SLOTS1, _SLOTS2 = 1024, 2048
_LIMIT = 1 << 14                                # of a frequency total
_UNDER = np.triu(np.ones((16, 16), np.float32))  # row @ _UNDER: running sums, exact below 2 ** 24


class _Coder:
    """Range coder state of every lane."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint32)
        self.range = np.full(lanes, 0xFFFFFFFF, np.uint32)

    def _shift(self, at: np.ndarray, move) -> None:
        while len(at):
            low, rng = self.low[at], self.range[at]
            settled = (low ^ (low + rng)) < _TOP
            need = settled | (rng < _BOT)
            if not need.any():
                return
            at, low, rng, settled = at[need], low[need], rng[need], settled[need]
            rng = np.where(settled, rng, (~low + np.uint32(1)) & (_BOT - np.uint32(1)))
            move(at, low)
            self.low[at] = low << np.uint32(8)
            self.range[at] = rng << np.uint32(8)

    def _narrow(self, at, under, freq, total, move) -> None:
        r = self.range[at] // total
        self.low[at] += r * under
        self.range[at] = r * freq
        self._shift(at, move)


class _Encoder(_Coder):
    def __init__(self, lanes: int):
        super().__init__(lanes)
        self.out = np.zeros((lanes, 4096), np.uint8)
        self.n = np.zeros(lanes, np.int64)

    def _move(self, at, low) -> None:
        if int(self.n[at].max()) >= self.out.shape[1] - 8:
            self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        self.out[at, self.n[at]] = (low >> np.uint32(24)).astype(np.uint8)
        self.n[at] += 1

    def step(self, at, sums, symbol):
        """Codes ``symbol`` under running sums of frequencies."""
        rows = np.arange(len(at))
        over = sums[rows, symbol]
        under = np.where(symbol > 0, sums[rows, symbol - 1], 0)
        self._narrow(at, under.astype(np.uint32), (over - under).astype(np.uint32), sums[:, -1].astype(np.uint32), self._move)
        return symbol

    def finish(self) -> list[bytes]:
        at = np.arange(len(self.low))
        for _ in range(4):
            self._move(at, self.low)
            self.low = self.low << np.uint32(8)
        return [self.out[i, :n].tobytes() for i, n in enumerate(self.n)]


class _Decoder(_Coder):
    def __init__(self, blocks: list[bytes]):
        super().__init__(len(blocks))
        width = max(map(len, blocks)) + 8
        self.data = np.zeros((len(blocks), width), np.uint8)
        for i, b in enumerate(blocks):
            self.data[i, :len(b)] = np.frombuffer(b, np.uint8)
        self.n = np.full(len(blocks), 4, np.int64)
        self.code = np.ascontiguousarray(self.data[:, :4]).view(">u4")[:, 0].astype(np.uint32)

    def _move(self, at, low) -> None:
        self.code[at] = (self.code[at] << np.uint32(8)) | self.data[at, np.minimum(self.n[at], self.data.shape[1] - 1)]
        self.n[at] += 1

    def step(self, at, sums, symbol):
        total = sums[:, -1].astype(np.uint32)
        value = (self.code[at] - self.low[at]) // (self.range[at] // total)
        symbol = (sums <= np.minimum(value, total - np.uint32(1))[:, None]).sum(1)
        rows = np.arange(len(at))
        under = np.where(symbol > 0, sums[rows, symbol - 1], 0)
        self._narrow(at, under.astype(np.uint32), (sums[rows, symbol] - under).astype(np.uint32), total, self._move)
        return symbol


def _run(coder, lengths: np.ndarray, ids: np.ndarray) -> None:
    """Codes ``ids`` [lane, position] (or fills them in) step by step."""
    lanes = len(lengths)
    digits = np.ones((lanes, _NODES, 16), np.uint16)
    which = np.ones((lanes, 32, 3), np.uint16)
    which[:, :, 2] = 2
    last1, sure1 = np.zeros((lanes, _SLOTS1), np.uint16), np.zeros((lanes, _SLOTS1), np.uint8)
    last2, sure2 = np.zeros((lanes, _SLOTS2), np.uint16), np.zeros((lanes, _SLOTS2), np.uint8)
    before1, before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    shortest, encoding = int(lengths.min()), isinstance(coder, _Encoder)
    everyone = np.arange(lanes)
    for t in range(int(lengths.max())):
        at = everyone if t < shortest else np.flatnonzero(lengths > t)
        s1 = (before1[at] * 40503 >> 4) & (_SLOTS1 - 1)
        s2 = (before1[at] * 40503 + before2[at] * 30011 >> 4) & (_SLOTS2 - 1)
        p1, c1, p2, c2 = last1[at, s1], sure1[at, s1], last2[at, s2], sure2[at, s2]
        context = c2.astype(np.int64) * 8 + c1 * 2 + (p1 == p2)
        sums = which[at, context].astype(np.int64)
        np.cumsum(sums, axis=1, out=sums)
        if encoding:
            x = ids[at, t]
            choice = np.where((c2 > 0) & (x == p2), 0, np.where((c1 > 0) & (x == p1), 1, 2))
        else:
            x = choice = None
        choice = coder.step(at, sums, choice)
        which[at, context, choice] += 24
        full = sums[:, -1] > _LIMIT // 2
        if full.any():
            f = np.flatnonzero(full)
            which[at[f], context[f]] = (which[at[f], context[f]] >> 1) + 1
        if not encoding:
            x = np.where(choice == 0, p2, p1).astype(np.int64)
        miss = np.flatnonzero(choice == 2)
        if len(miss):
            m = at[miss]
            node = np.zeros(len(m), np.int64)
            prefix = np.zeros(len(m), np.int64)
            for j, base in enumerate((0, 1, 17, 273)):
                node = base + (prefix if j < 3 else (prefix ^ (prefix >> 3)) & (_LAST - 1))
                row = digits[m, node]
                sums = (row.astype(np.float32) @ _UNDER).astype(np.int64)
                d = coder.step(m, sums, x[miss] >> (12 - 4 * j) & 15 if encoding else None)
                digits[m, node, d] += 32
                full = sums[:, -1] > _LIMIT
                if full.any():
                    f = np.flatnonzero(full)
                    digits[m[f], node[f]] = (digits[m[f], node[f]] >> 1) + 1
                prefix = prefix << 4 | d
            if not encoding:
                x[miss] = prefix
        if not encoding:
            ids[at, t] = x
        for last, sure, s, p, c in ((last1, sure1, s1, p1, c1), (last2, sure2, s2, p2, c2)):
            hit = (x == p) & (c > 0)
            left = np.where(hit, np.minimum(c + 1, 3), c >> 1)
            fresh = left == 0
            last[at, s] = np.where(fresh, x, p)
            sure[at, s] = np.where(fresh, 1, left)
        before2[at] = before1[at]
        before1[at] = x


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Payload of an array of ids below 65536."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError("ids of 65536 and more have no code")
    n = -(-len(ids) // block)
    head = MAGIC + struct.pack("<III", len(ids), block, n)
    if not n:
        return head
    lanes = np.zeros((n, block), np.int64)
    lanes.reshape(-1)[:len(ids)] = ids
    lengths = np.full(n, block)
    lengths[-1] = len(ids) - (n - 1) * block
    coder = _Encoder(n)
    _run(coder, lengths, lanes)
    blocks = coder.finish()
    table = b"".join(struct.pack("<II", len(b), zlib.crc32(ids[i * block:(i + 1) * block].tobytes()))
                     for i, b in enumerate(blocks))
    return head + table + b"".join(blocks)


def decode(payload: bytes) -> np.ndarray:
    """The ids of a payload; a damaged block raises ValueError."""
    if payload[:4] != MAGIC:
        raise ValueError("not a payload of this coder")
    count, block, n = struct.unpack_from("<III", payload, 4)
    if not n:
        return np.zeros(0, "<u4")
    at, blocks, crcs = 16 + 8 * n, [], []
    for i in range(n):
        size, crc = struct.unpack_from("<II", payload, 16 + 8 * i)
        blocks.append(payload[at:at + size])
        crcs.append(crc)
        at += size
    lengths = np.full(n, block)
    lengths[-1] = count - (n - 1) * block
    ids = np.zeros((n, block), np.int64)
    _run(_Decoder(blocks), lengths, ids)
    out = ids.reshape(-1)[:count].astype("<u4")
    for i, crc in enumerate(crcs):
        if zlib.crc32(out[i * block:(i + 1) * block].tobytes()) != crc:
            raise ValueError(f"block {i} is damaged")
    return out
