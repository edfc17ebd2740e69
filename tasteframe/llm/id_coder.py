"""Lossless coding of token ids: adaptive mixtures of order-0 to order-2 predictions drive a range coder.

Blocks are coded side by side, one id of each per step, so that each step is some NumPy operations over all blocks ("lanes").
A block starts from the same state, knows nothing of others, and carries its length and a checksum.

Model of a block. The two ids before predict one id (order 2), the id before predicts one (order 1), each with a confidence of 1 to 4 that
hits raise and misses lower; order 0 is a distribution over all ids, as adaptive cumulative frequencies of the id's
digits to base 64, highest first, each given those before. The three are mixed: the weights of order 2 and order 1 are
learned for every pair of confidences, order 0 has the rest, and an id's interval is cut by the highest order that predicts it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, HEAD = b"TFI1", struct.Struct("<4sIII")
#: Frequencies sum to 2**BITS. Slots of the order-1 and order-2 tables of a block, as powers of two; pairs of confidences.
BITS, SLOTS1, SLOTS2, PAIRS = 15, 11, 12, 25
#: Base of the digits, and the rows of frequencies for the digits after the second, which share them by hash.
BASE, SHARED = 64, 512
ONE, U64, LOW32, HALF = 1 << BITS, np.uint64, np.uint64(0xFFFFFFFF), np.uint64(32)
#: Of a weight: its bounds and its rate; the rate of the digits.
LEAST, MOST, RATE, RATE0 = 64, ONE - 64, 5, 4
#: _PULL[s] is where the cumulative frequencies (up to and with each digit, less one) move when s is seen.
_PULL = np.where(np.arange(BASE)[None, :] < np.arange(BASE)[:, None], np.arange(BASE), ONE - BASE + np.arange(BASE)).astype(np.int16)
_ROW = np.dtype((np.void, 2 * BASE))


class _Lanes:
    """The models and the range coders of blocks of the given lengths, longest first."""

    def __init__(self, lengths: np.ndarray, digits: int):
        n, self.digits = len(lengths), digits
        lane = self.each = np.arange(n, dtype=np.int64)
        rows = 1 + BASE + SHARED * max(0, digits - 2)
        self.first_row = lane * rows
        self.order0 = np.empty((n * rows, BASE), np.int16)
        self.order0[:] = np.arange(1, BASE + 1) * (ONE // BASE) - 1
        self.order0_rows = self.order0.view(_ROW).ravel()
        self.found = np.full(1 + BASE * n * digits, ONE - 1, np.int16)
        self.row_start = np.arange(n * digits, dtype=np.int64) * BASE
        self.slots = np.zeros((n << SLOTS1) + (n << SLOTS2), np.int32)  # order 1, then order 2
        self.first_slot = np.stack([lane << SLOTS1, (n << SLOTS1) + (lane << SLOTS2)])
        self.weights = np.full(2 * n * PAIRS, ONE // 4, np.int32)
        self.first_weight = np.stack([lane * PAIRS, (n + lane) * PAIRS])
        self.before, self.before2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.low, self.range = np.zeros(n, U64), np.full(n, 2**64 - 1, U64)
        # the most lanes that are active at each step
        self.active = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the first n lanes: the ids that order 1 and order 2 predict (-1: none), and where the parts of order 2, 1 and 0 begin and end."""
        b = self.before[:n]
        k = np.empty((2, n), np.int64)
        k[0] = b * 0x9E3779B1 >> 14 & (1 << SLOTS1) - 1
        k[1] = b * 0x85EBCA6B + self.before2[:n] * 0x27D4EB2F >> 13 & (1 << SLOTS2) - 1
        k += self.first_slot[:, :n]
        v = self.slots.take(k)
        p = (v >> 3) - 1
        sure = v & 7
        sure1 = sure[0] * (p[0] != p[1])  # of two equal predictions order 2 has the part
        kw = self.first_weight[:, :n] + (sure[1] * 5 + sure1)
        w = self.weights.take(kw)
        self.state = k, v, p, sure, kw, w
        ends = np.zeros((4, n), np.int32)
        ends[1] = w[1] * (sure[1] > 0)
        ends[2] = ends[1] + (((ONE - 2 - ends[1]) * w[0] >> BITS) + 1) * (sure1 > 0)
        ends[3] = ONE
        return p, ends

    def part(self, ends: np.ndarray, by: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the part of order 2 (``by`` 0), order 1 (1) or order 0 (2)."""
        at = by * n + self.each[:n]
        start = ends.take(at)
        return start, ends.take(at + n) - start

    def learn(self, ids: np.ndarray, by: np.ndarray, n: int) -> None:
        """``ids`` came, within the part of order 2, 1 or 0."""
        k, v, p, sure, kw, w = self.state
        hit = np.empty((2, n), np.int32)
        np.equal(by, 1, out=hit[0], casting="unsafe")
        np.equal(by, 0, out=hit[1], casting="unsafe")
        step = hit * (MOST - LEAST) + LEAST - w >> RATE
        step[0] *= by > 0
        self.weights[kw] = w + step
        new = ((ids + 1) << 3 | 1).astype(np.int32)
        self.slots[k] = np.where(p == ids, v + (sure < 4), np.where(sure > 1, v - 1, new))
        self.before2[:n] = self.before[:n]
        self.before[:n] = ids + 1

    def row(self, lanes: np.ndarray, prefix: np.ndarray, digit: int) -> np.ndarray:
        """Where the frequencies of a digit stand, given those before it."""
        if digit < 2:
            return self.first_row[lanes] + (prefix + 1 if digit else 0)
        return self.first_row[lanes] + (prefix * 0x9E3779B1 >> 16 & SHARED - 1) + (1 + BASE + SHARED * (digit - 2))

    def look(self, rows: np.ndarray) -> np.ndarray:
        u = self.found[1 : 1 + BASE * len(rows)].reshape(len(rows), BASE)
        return np.take(self.order0, rows, axis=0, out=u, mode="clip")

    def interval(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of digit s in the rows just looked at. What stands before a row is ONE - 1: its end wraps to 0."""
        at = self.row_start[: len(s)] + s
        start = self.found.take(at).astype(np.int32) + 1 & ONE - 1
        return start, self.found.take(at + 1).astype(np.int32) + 1 - start

    def adapt(self, rows: np.ndarray, u: np.ndarray, s: np.ndarray) -> None:
        pull = _PULL.take(s, axis=0)
        pull -= u
        pull >>= RATE0
        pull += u
        self.order0_rows[rows] = pull.view(_ROW).ravel()


def encode(blocks: list[np.ndarray], digits: int = 3) -> list[bytes]:
    """Each block of ids (below BASE**digits) as bytes of its own."""
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    x = _Lanes(lengths, digits)
    most, lanes = len(x.active), len(blocks)
    ids = np.zeros((most, lanes), np.int32)
    for lane, i in enumerate(order):
        ids[: len(blocks[i]), lane] = blocks[i]
    words, size = np.zeros((lanes, most // 2 + 600), np.uint32), np.zeros(lanes, np.int64)

    def narrow(low: np.ndarray, rng: np.ndarray, start: np.ndarray, freq: np.ndarray) -> None:
        rng >>= U64(BITS)
        low += rng * start.astype(U64)
        rng *= freq.astype(U64)

    def settle(low: np.ndarray, rng: np.ndarray, who: np.ndarray) -> None:
        """Ranges below 2**32 give away the upper half of ``low``; one that crosses a multiple of 2**32 ends there."""
        short = (rng <= LOW32).nonzero()[0]
        if len(short):
            a, lane = low[short], who[short]
            words[lane, size[lane]] = a >> HALF
            size[lane] += 1
            a &= LOW32
            low[short] = a << HALF
            rng[short] = np.minimum(rng[short], U64(1 << 32) - a) << HALF

    for t in range(most):
        n = int(x.active[t])
        if t % 256 == 0 and size.max() + 2 * 256 + 2 > words.shape[1]:
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
        now = ids[t, :n].astype(np.int64)
        p, ends = x.predict(n)
        by = np.where(now == p[1], 0, 2 - (now == p[0]))
        low, rng = x.low[:n], x.range[:n]
        narrow(low, rng, *x.part(ends, by, n))
        miss = (by == 2).nonzero()[0]
        if len(miss):
            value = now[miss]
            a, r = low[miss], rng[miss]
            prefix = [value >> 6 * (digits - 1 - d) for d in range(digits)]
            s = np.concatenate([y & BASE - 1 for y in prefix])
            rows = np.concatenate([x.row(miss, y >> 6, d) for d, y in enumerate(prefix)])
            u = x.look(rows)
            start, freq = (y.reshape(digits, -1) for y in x.interval(s))
            x.adapt(rows, u, s)
            for d in range(digits):
                if d % 2:
                    settle(a, r, miss)
                narrow(a, r, start[d], freq[d])
            low[miss], rng[miss] = a, r
        settle(low, rng, x.each[:n])
        x.learn(now, by, n)
    out: list[bytes] = [b""] * lanes
    for lane, i in enumerate(order):
        tail = np.array([x.low[lane] >> HALF, x.low[lane] & LOW32], np.uint32)
        body = np.concatenate([words[lane, : size[lane]], tail]).astype("<u4").tobytes()
        out[i] = HEAD.pack(MAGIC, len(blocks[i]), digits, _checksum(body, len(blocks[i]), digits)) + body
    return out


def _checksum(body: bytes, n: int, digits: int) -> int:
    return zlib.crc32(body, zlib.crc32(struct.pack("<II", n, digits)))


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids (little-endian unsigned 32-bit) of blocks that ``encode`` has made; damage is an error."""
    heads = []
    for b in blocks:
        magic, n, digits, crc = HEAD.unpack_from(b) if len(b) >= HEAD.size else (b"", 0, 0, 0)
        if magic != MAGIC or crc != _checksum(b[HEAD.size :], n, digits):
            raise ValueError("a block of ids is damaged")
        heads.append((n, digits))
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(blocks)
    for digits in {d for _, d in heads}:
        some = sorted((i for i, h in enumerate(heads) if h[1] == digits), key=lambda i: -heads[i][0])
        for i, ids in zip(some, _decode([blocks[i][HEAD.size :] for i in some], np.array([heads[i][0] for i in some], np.int64), digits), strict=True):
            out[i] = ids
    return out


def _decode(bodies: list[bytes], lengths: np.ndarray, digits: int) -> list[np.ndarray]:
    x = _Lanes(lengths, digits)
    words = np.concatenate([*[np.frombuffer(b, "<u4") for b in bodies], np.zeros(2, np.uint32)]).astype(U64)
    at = np.cumsum([0, *[len(b) // 4 for b in bodies]])[:-1]
    code = words[at] << HALF | words[at + 1]  # less ``low``, from here on
    at += 2
    ids = np.zeros((len(x.active), len(bodies)), "<u4")

    def value(rng: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Where the code stands in the range; leaves the range divided."""
        rng >>= U64(BITS)
        return np.minimum(code // rng, U64(ONE - 1))

    def narrow(low: np.ndarray, rng: np.ndarray, code: np.ndarray, start: np.ndarray, freq: np.ndarray) -> None:
        skip = rng * start.astype(U64)
        low += skip
        code -= skip
        rng *= freq.astype(U64)

    def settle(low: np.ndarray, rng: np.ndarray, code: np.ndarray, who: np.ndarray) -> None:
        short = (rng <= LOW32).nonzero()[0]
        if len(short):
            a, lane = low[short] & LOW32, who[short]
            low[short] = a << HALF
            rng[short] = np.minimum(rng[short], U64(1 << 32) - a) << HALF
            code[short] = code[short] << HALF | words.take(at[lane], mode="clip")
            at[lane] += 1

    for t in range(len(x.active)):
        n = int(x.active[t])
        p, ends = x.predict(n)
        low, rng, c = x.low[:n], x.range[:n], code[:n]
        v = value(rng, c).astype(np.int32)
        by = (v >= ends[1]).astype(np.int64) + (v >= ends[2])
        narrow(low, rng, c, *x.part(ends, by, n))
        now = np.where(by == 0, p[1], p[0]).astype(np.int64)
        miss = (by == 2).nonzero()[0]
        if len(miss):
            a, r, d_code = low[miss], rng[miss], c[miss]
            got = np.zeros(len(miss), np.int64)
            for d in range(digits):
                if d % 2:
                    settle(a, r, d_code, miss)
                rows = x.row(miss, got, d)
                u = x.look(rows)
                below = u < value(r, d_code).astype(np.int16)[:, None]
                s = np.bitwise_count(np.packbits(below, axis=1).view(U64)).ravel().astype(np.int64)
                narrow(a, r, d_code, *x.interval(s))
                x.adapt(rows, u, s)
                got = got << 6 | s
            low[miss], rng[miss], c[miss], now[miss] = a, r, d_code, got
        settle(low, rng, c, x.each[:n])
        x.learn(now, by, n)
        ids[t, :n] = now
    return [np.ascontiguousarray(ids[:n, lane]) for lane, n in enumerate(lengths)]
