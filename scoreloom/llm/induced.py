"""Induced suffix sorting of one shard of strings, with common-prefix values, on disk-backed queues.

The order of all suffixes is induced from that of the leftmost S-type (LMS) suffixes, as
in external induced sorting (Bingmann, Fischer, Osipov: "Inducing Suffix and LCP Arrays in
External Memory", 2013): suffix tuples leave a priority queue in order, and each sends its
predecessor's tuple back into the queue. Keys leave in the order of their first symbol and,
within a symbol, in the order of arrival, so the queue is one first-in first-out file per
symbol (`_Queues`), which goes to disk beyond `memory` bytes, and a whole symbol's tuples are
handled as arrays. A tuple carries its common prefix with the tuple before it: one more than
the least value between the two that sent them. Values stop at `cap`.

The LMS suffixes themselves are sorted by inducing their substrings from text order, naming
them, and sorting the three times shorter string of names by pairs of names, pairs of pairs,
and so on until `cap` symbols are covered.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

from scoreloom.llm import packed

MEMORY = 64 << 20


class _Queues:
    """First-in first-out queues of (position, common prefix), by symbol; on disk beyond a bound."""

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.held, self.spills = folder, memory, 0, 0
        self.chunks: dict[int, list] = {}

    def put(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.chunks.setdefault(symbol, []).append((positions, prefixes))
        self.held += positions.nbytes + prefixes.nbytes
        if self.held > self.memory:
            for s, chunks in self.chunks.items():
                for suffix, at in (("p", 0), ("l", 1)):
                    with open(os.path.join(self.folder, f"{s}{suffix}"), "ab") as f:
                        for chunk in chunks:
                            f.write(chunk[at].tobytes())
            self.chunks, self.held, self.spills = {}, 0, self.spills + 1

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        chunks = self.chunks.pop(symbol, [])
        self.held -= sum(a.nbytes + b.nbytes for a, b in chunks)
        path = os.path.join(self.folder, str(symbol))
        if os.path.exists(path + "p"):
            chunks.insert(0, (np.fromfile(path + "p", np.int64), np.fromfile(path + "l", np.uint8)))
            os.unlink(path + "p")
            os.unlink(path + "l")
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([a for a, _ in chunks]), np.concatenate([b for _, b in chunks])


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first..last] for each pair, by a table of power-of-two ranges."""
    if not len(first):
        return np.zeros(0, values.dtype)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out, table = np.empty(len(first), values.dtype), values
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[first[at]], table[last[at] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


class _Shard:
    def __init__(self, text: np.ndarray, cap: int, memory: int):
        """`text`: symbols 1 to 255, strings ended by 0."""
        self.text, self.cap, self.memory = text, cap, memory
        n = len(text)
        step = np.sign(text[1:].astype(np.int16) - text[:-1]).astype(np.int8)
        turn = np.where(step != 0, np.arange(n - 1), n - 1)
        turn = np.minimum.accumulate(turn[::-1])[::-1] if n > 1 else turn
        self.rises = np.ones(n, bool)  # S-type
        self.rises[:-1] = np.append(step, 1)[turn] > 0
        self.run = np.minimum(np.append(turn, n - 1) - np.arange(n) + 1, cap).astype(np.uint8)
        lms = self.rises.copy()
        lms[0] = False
        lms[1:] &= ~self.rises[:-1]
        self.is_lms = lms
        self.lms = np.flatnonzero(lms)

    def induce(self, lms: np.ndarray, prefixes: np.ndarray, keep) -> None:
        """Sends all suffixes, symbol by symbol, to keep(rising, positions, common prefixes)."""
        symbols = self.text[lms]
        cuts = np.searchsorted(symbols, np.arange(257))
        with tempfile.TemporaryDirectory() as falling, tempfile.TemporaryDirectory() as rising:
            queues, stored = _Queues(falling, self.memory), _Queues(rising, self.memory)
            least = np.zeros(256, np.uint8)
            for c in range(256):
                last = self._symbol(queues, c, False, least, lambda p, v: stored.put(c, p, v))
                own = slice(cuts[c], cuts[c + 1])
                if own.stop > own.start:
                    values = prefixes[own].copy()
                    values[0] = 0 if last is None else min(self.run[last], self.run[lms[own.start]])
                    self._scan(queues, lms[own], values, False, least)
            queues, least = _Queues(falling, self.memory), np.zeros(256, np.uint8)
            for c in range(255, -1, -1):
                last = self._symbol(queues, c, True, least, lambda p, v: keep(True, p, v))
                positions, values = stored.take(c)
                if len(positions):
                    seam = 0 if last is None else min(self.run[last], self.run[positions[-1]])
                    keep(False, positions, values)
                    if seam >= self.cap:  # a run of one symbol
                        keep(True, np.array([last, positions[-1]]), np.array([0, seam], np.uint8))
                    self._scan(queues, positions[::-1], np.append(np.uint8(seam), values[:0:-1]), True, least)

    def _symbol(self, queues, c: int, rising: bool, least: np.ndarray, out) -> int | None:
        """Handles a symbol's tuples of one type, those that it sends to itself included."""
        last = None
        positions, values = queues.take(c)
        while len(positions):
            if last is None:
                values[0] = 0
            out(positions, values)
            self._scan(queues, positions, values, rising, least)
            last = positions[-1]
            positions, values = queues.take(c)
        return last

    def _scan(self, queues, positions, values, rising: bool, least: np.ndarray) -> None:
        """Puts the predecessors of one type of these suffixes into their queues."""
        before = positions - 1
        at = np.flatnonzero((before >= 0) & (self.rises[before] == rising))
        symbols = self.text[before[at]]
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        start = np.flatnonzero(np.diff(symbols.astype(np.int16), prepend=-1))
        first = np.zeros(len(at), bool)
        first[start] = True
        prefix = np.minimum.accumulate(values)
        out = np.empty(len(at), np.uint8)
        out[start] = np.minimum(prefix[at[start]], least[symbols[start]])
        rest = np.flatnonzero(~first)
        out[rest] = _least(values, at[rest - 1] + 1, at[rest])
        out = np.minimum(out, self.cap - 1) + np.uint8(1)
        np.minimum(least, prefix[-1], out=least)
        ends = np.append(start[1:], len(at))
        suffix = np.append(np.minimum.accumulate(values[::-1])[::-1], np.uint8(255))
        if len(start):
            least[symbols[start]] = suffix[at[ends - 1] + 1]
        for a, b in zip(start.tolist(), ends.tolist()):
            queues.put(int(symbols[a]), before[at[a:b]], out[a:b])

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS positions in the order of their suffixes, and common prefixes of neighbours."""
        lms, n = self.lms, len(self.lms)
        found = []

        def keep(rising, positions, _):
            if rising:
                found.append(positions[self.is_lms[positions]])

        by_symbol = lms[np.argsort(self.text[lms], kind="stable")]
        self.induce(by_symbol, np.zeros(n, np.uint8), keep)
        order = np.concatenate([np.zeros(0, np.int64), *found])[::-1]
        order = np.concatenate([lms[-1:], order[order != lms[-1]]])  # the end of the text is least
        sums = packed.byte_sums(self.text)
        ends = np.minimum(np.append(lms[1:], len(self.text) - 1) + 1, len(self.text))
        end_of = np.empty(len(self.text), np.int64)
        end_of[lms] = ends
        pieces = packed.span_hash(sums, order, end_of[order])
        name = np.empty(len(self.text), np.int64)
        name[order] = np.cumsum(np.append(1, pieces[1:] != pieces[:-1]))
        rank, covered = name[lms], 1
        while 2 * covered < self.cap and rank.max() < n:
            pair = rank * (n + 1)
            pair[:-covered] += rank[covered:]
            rank = np.unique(pair, return_inverse=True)[1] + 1
            covered *= 2
        order = lms[np.argsort(rank, kind="stable")]
        return order, self._common(sums, order)

    def _common(self, sums, order: np.ndarray) -> np.ndarray:
        a, b = order[:-1], order[1:]
        low, n = np.zeros(len(a), np.int64), len(self.text)
        step = 1 << (self.cap.bit_length() - 1)
        while step:
            longer = low + step
            fits = (longer <= self.cap) & (np.maximum(a, b) + longer <= n)
            at = np.flatnonzero(fits)
            x, y, m = a[at] + low[at], b[at] + low[at], longer[at]
            same = packed.span_hash(sums, x, a[at] + m) == packed.span_hash(sums, y, b[at] + m)
            low[at[same]] = m[same]
            step >>= 1
        return np.append(np.uint8(0), low.astype(np.uint8)) if len(order) else np.zeros(0, np.uint8)


def repeated_starts(text: np.ndarray, length: int, memory: int = MEMORY) -> np.ndarray:
    """Which positions start a string of `length` (at most 255) symbols that starts elsewhere as well.

    `text` holds strings of symbols 1 to 255, each ended by 0; only positions at least
    `length` before their string's end mean anything.
    """
    found = np.zeros(len(text), bool)
    if not text.any():
        return found
    shard = _Shard(text, length, memory)
    last = 0

    def keep(_, positions, values):
        nonlocal last
        before = np.append(last, positions[:-1])
        same = values >= length
        found[positions[same]] = True
        found[before[same]] = True
        last = positions[-1]

    order, prefixes = shard.sorted_lms()
    shard.induce(order, prefixes, keep)
    return found
