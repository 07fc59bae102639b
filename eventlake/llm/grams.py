"""Byte models of variable order: frozen counts of every context, scored in arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Bytes scored at once.
_STEP = 1 << 19
_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: What stands before a text's first byte.
_PAD = b"\n"


class Lookup:
    """From 64-bit codes to their places in a sorted array, by open addressing."""

    def __init__(self, codes: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * max(1, len(codes))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY)
        self.places = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(codes), dtype=np.int32), self._slots(codes)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == _EMPTY)
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.places[taken] = codes[left[free[first]]], left[free[first]]
            rest = np.ones(len(left), bool)
            rest[free[first]] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * _MIX) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The code's place, or -1."""
        slot = self._slots(codes)
        keys, places = self.keys[slot], self.places[slot]
        todo = np.flatnonzero((keys != codes) & (keys != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            keys = self.keys[slot[todo]]
            places[todo] = self.places[slot[todo]]
            todo = todo[(keys != codes[todo]) & (keys != _EMPTY)]
        return places


def joined(texts: Sequence[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes, each after ``order`` pads, with their starts and ends."""
    pad = _PAD * order
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + order)
    return np.frombuffer(b"".join(pad + t for t in texts), np.uint8), ends - lengths, ends


def codes_at(data: np.ndarray, places: slice, length: int) -> np.ndarray:
    """The ``length`` bytes up to each place as one number, the last byte lowest."""
    code = np.zeros(places.stop - places.start, np.uint64)
    for back in range(length - 1, -1, -1):
        code <<= np.uint64(8)
        code |= data[places.start - back : places.stop - back]
    return code


class ByteModel:
    """Code lengths in bits of every byte after its context, for several classes at once.

    A class counts its bytes after contexts of 0 to ``order`` bytes. A context seen n times
    before d different bytes gives an escape d / (n + d) and a byte seen c times there
    c / (n + d); below order 0 every byte has 1 / 256. As ``blended``, a seen byte
    also gets the escape's share of its probability after the shorter context, which is
    Witten-Bell smoothing. Counts never change while scoring. For each order the table
    holds the grams seen in any class, with every class's code length worked out.
    """

    def __init__(self, classes: Sequence[Sequence[bytes]], order: int, blended: bool = False):
        self.order, self.classes = order, len(classes)
        self.escapes, self.contexts, self.costs, self.grams = [], [], [], []
        arrays = [joined(texts, order) for texts in classes]
        for k in range(order + 1):
            counted = [self._counts(*array, k) for array in arrays]
            grams = np.unique(np.concatenate([c[0] for c in counted]))
            contexts = np.unique(grams >> np.uint64(8))
            escapes = np.zeros((len(contexts), self.classes), np.float32)
            costs = np.zeros((len(grams), self.classes), np.float32)
            shorter = self._after(grams & np.uint64((1 << (8 * k)) - 1), k - 1)
            parent = np.searchsorted(contexts, grams >> np.uint64(8))
            for j, (mine, count) in enumerate(counted):
                if not len(mine):
                    costs[:, j] = shorter[:, j]
                    continue
                of = np.searchsorted(contexts, mine >> np.uint64(8))
                n = np.bincount(of, weights=count, minlength=len(contexts))
                d = np.bincount(of, minlength=len(contexts))
                seen = n > 0
                escapes[seen, j] = -np.log2(d[seen] / (n[seen] + d[seen]))
                costs[:, j] = escapes[parent, j] + shorter[:, j]
                at = np.searchsorted(grams, mine)
                mass = count / (n[of] + d[of])
                if blended:
                    mass = mass + 2.0 ** -costs[at, j].astype(np.float64)
                costs[at, j] = -np.log2(mass)
            self.grams.append(grams)
            self.contexts.append(contexts)
            self.escapes.append(escapes)
            self.costs.append(costs)
        self.lookup = Lookup(self.grams[order])

    @staticmethod
    def _counts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> tuple:
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = int(starts[0])
        codes = codes_at(data, slice(first, len(data)), k + 1)
        step = np.zeros(len(data) + 1, np.int64)
        np.add.at(step, starts, 1)
        np.add.at(step, ends, -1)
        return np.unique(codes[np.cumsum(step)[first:-1] > 0], return_counts=True)

    def _after(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of the last byte of each gram after its ``k`` bytes before."""
        if k < 0:
            return np.full((len(grams), self.classes), 8, np.float32)
        if k == self.order:
            at = self.lookup.find(grams)
        else:
            at = np.searchsorted(self.grams[k], grams)
            at[at == len(self.grams[k])] = 0
            at = np.where(self.grams[k][at] == grams, at, -1) if len(self.grams[k]) else np.full(len(grams), -1)
        costs = self.costs[k][at] if len(self.costs[k]) else np.zeros((len(grams), self.classes), np.float32)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            lower = self._after(grams[miss] & np.uint64((1 << (8 * k)) - 1), k - 1)
            context = grams[miss] >> np.uint64(8)
            at = np.searchsorted(self.contexts[k], context)
            at[at == len(self.contexts[k])] = 0
            if len(self.contexts[k]):
                known = self.contexts[k][at] == context
                lower += np.where(known[:, None], self.escapes[k][at], np.float32(0))
            costs[miss] = lower
        return costs

    def bits(self, texts: Sequence[bytes]) -> np.ndarray:
        """Code length of each text (row) in each class (column); an empty text's is zero."""
        out = np.zeros((len(texts), self.classes))
        data, starts, ends = joined(texts, self.order)
        for low in range(self.order, len(data), _STEP):
            high = min(len(data), low + _STEP)
            first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
            mine = np.arange(first, last)
            mine = mine[ends[mine] > starts[mine]]
            mine = mine[np.minimum(ends[mine], high) > np.maximum(starts[mine], low)]
            if not len(mine):
                continue
            costs = self._after(codes_at(data, slice(low, high), self.order + 1), self.order)
            edges = np.stack([np.maximum(starts[mine], low), np.minimum(ends[mine], high)], axis=1) - low
            edges = edges.reshape(-1)
            open_end = edges[-1] == high - low
            sums = np.add.reduceat(costs, edges[:-1] if open_end else edges, axis=0, dtype=np.float64)
            out[mine] += sums[::2]
        return out
