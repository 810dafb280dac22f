"""A run-length index of texts: Burrows-Wheeler transform kept as runs, with samples at their ends.

The suffixes of all texts are sorted (each text ends with a symbol of its own, least of all). The symbol
before each suffix, in this order, is the transform; a repetitive collection has few runs of
equal symbols. Kept are one entry a run: where it begins, its symbol, where its first symbol leads (the
LF mapping of a run is a shift), and the texts' positions at both run ends. Runs are cut as well where
the first WIDTH bytes of the suffixes change, so that the suffixes that begin with one string of
WIDTH bytes are whole runs, and the least text number among them is one more sample of each run.

``matching_statistics`` streams texts from right to left and gives, for every position, the length of the
longest match that begins there and a place of it in the index. Where the symbol before
the current suffix is not the next one of the text, the match goes on from the nearest run end with
that symbol above or below, whichever agrees further. ``earlier`` streams the texts of the index themselves
and marks the positions whose next WIDTH bytes also begin in a text of smaller number.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Symbols of the first sorting key: 7 of 9 bits each.
_FIRST = 7


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Sorted order of the keys, the dense rank of each, and whether all differ."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.empty(len(keys), np.int64)
    new[0] = 0
    np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
    rank = np.empty(len(keys), np.int64)
    rank[order] = new
    return order, rank, int(new[-1]) == len(keys) - 1


class RunIndex:
    """Index of the texts ``data[off[i]:off[i + 1]]``, numbered 0, 1, ..."""

    def __init__(self, data: np.ndarray, off: np.ndarray, width: int):
        m, self.width = len(off) - 1, width
        size = np.diff(off)
        self.begin = off[:-1] + np.arange(m)  # in the concatenation, a terminator after each text
        n = len(data) + m
        symbol = np.zeros(n, np.int16)
        number = np.repeat(np.arange(m), size + 1)
        inside = np.ones(n, bool)
        inside[self.begin + size] = False
        symbol[inside] = data.astype(np.int16) + 1
        end = np.repeat(self.begin + size, size + 1)
        at = np.arange(n)

        # suffix order by the first symbols, then by two or three times as many each time
        k, same = min(_FIRST, width), None
        padded = np.concatenate([symbol.astype(_U), np.zeros(k, _U)])
        key = np.zeros(n, _U)
        for j in range(k):
            key = (key << _U(9)) | np.where(at + j <= end, padded[j : j + n], _U(0))
        order, rank, done = _ranks(key)
        # three blocks of k symbols at a time where three ranks fit into one key, else two
        blocks, bits = (3, 21) if n + m < 1 << 21 else (2, 32)
        while not done or same is None:
            if same is None and (done or k <= width < blocks * k):
                same = (rank, k)
            if done:
                break
            key = rank.astype(_U)
            for j in range(1, blocks):
                ahead = at + j * k
                key = (key << _U(bits)) | np.where(ahead > end, number, m + rank[np.minimum(ahead, n - 1)]).astype(_U)
            order, rank, done = _ranks(key)
            k *= blocks
        self._cut(symbol, number, order, at, end, same, width)
        self.symbol_text = symbol

    def _cut(self, symbol, number, order, at, end, same, width) -> None:
        n = len(order)
        rank, k = same
        whole = order + width <= end[order]  # suffixes with WIDTH bytes
        pair = np.zeros(n, bool)
        one, two = order[:-1], order[1:]
        both = whole[:-1] & whole[1:]
        o, t = one[both], two[both]
        # equal first WIDTH symbols: equal in blocks of k that cover them; complete ranks are never equal
        agree = np.ones(len(o), bool)
        for shift in (*range(0, width - k, k), width - k):
            agree &= rank[o + shift] == rank[t + shift]
        pair[1:][both] = agree
        change = np.empty(n, bool)
        change[0] = True
        change[1:] = ~pair[1:] & (whole[1:] | whole[:-1])
        before = symbol[order - 1]  # of the first text's start: the last terminator
        head = change.copy()
        head[1:] |= before[1:] != before[:-1]
        self.head = np.flatnonzero(head)
        tail = np.append(self.head[1:], n) - 1
        self.before, self.n = before[self.head], n
        length = tail - self.head + 1
        by = np.argsort(self.before, kind="stable")
        self.leads = np.empty(len(by), np.int64)
        self.leads[by] = np.cumsum(length[by]) - length[by]
        self.head_at, self.tail_at, self.tail = order[self.head], order[tail], tail
        group = np.cumsum(change[self.head]) - 1
        least = np.minimum.reduceat(np.minimum.reduceat(number[order], self.head), np.flatnonzero(np.diff(group, prepend=-1)))
        self.least = np.where(whole[self.head], least[group], n)
        self.by_symbol = by  # runs by symbol, then order
        self.by_key = self.before[by].astype(np.int64) * (len(by) + 1) + by

    def run_of(self, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.head, row, "right") - 1

    def earlier(self) -> list[np.ndarray]:
        """For each text, the positions whose next WIDTH bytes also begin in a text of smaller number.

        All texts are streamed side by side from their terminators, whose rows come first in the order;
        a text of the index always finds its next symbol, so its match never breaks.
        """
        size = np.diff(np.append(self.begin, self.n)) - 1
        text = np.argsort(-size, kind="stable")
        ordered, row = size[text], text.copy()
        found: list[np.ndarray] = []
        which: list[np.ndarray] = []
        run = self.run_of(row)
        for step in range(1, int(ordered[0]) + 1 if len(ordered) else 0):
            k = int(np.searchsorted(-ordered, -step, "right"))  # texts of at least so many bytes
            run, row = run[:k], row[:k]
            row = self.leads[run] + row - self.head[run]
            run = self.run_of(row)
            if step >= self.width:
                hit = np.flatnonzero(self.least[run] < text[:k])
                found.append(ordered[hit] - step)
                which.append(text[hit])
        if not found:
            return [np.zeros(0, np.int64)] * len(size)
        found, which = np.concatenate(found), np.concatenate(which)
        order = np.lexsort((found, which))
        return np.split(found[order], np.searchsorted(which[order], np.arange(1, len(size))))

    def _agree(self, pattern: np.ndarray, i: int, at: int, most: int) -> int:
        """How many symbols, ``most`` at the utmost, the pattern from ``i`` and the texts from ``at`` have in common."""
        here = self.symbol_text[at : at + most]
        there = pattern[i : i + len(here)]
        differ = np.flatnonzero((here != there) | (here == 0))
        return int(differ[0]) if len(differ) else len(here)

    def matching_statistics(self, pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position of a text (bytes) the length of its longest match and a place of it in the
        concatenated texts."""
        p = pattern.astype(np.int16) + 1
        length, place = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        row, now, at = 0, 0, int(self.head_at[0])
        runs = len(self.head)
        for i in range(len(p) - 1, -1, -1):
            run = int(self.run_of(np.array([row]))[0])
            if self.before[run] != p[i]:
                j = int(np.searchsorted(self.by_key, int(p[i]) * (runs + 1) + run))
                best = None
                for x, rows, ats in ((j - 1, self.tail, self.tail_at), (j, self.head, self.head_at)):
                    if 0 <= x < runs and self.before[self.by_symbol[x]] == p[i]:
                        other = int(self.by_symbol[x])
                        agree = self._agree(p, i + 1, int(ats[other]), now)
                        if best is None or agree > best[0]:
                            best = (agree, other, int(rows[other]), int(ats[other]))
                if best is None:  # a symbol that no text has
                    row, now, at = 0, 0, int(self.head_at[0])
                    continue
                now, run, row, at = best
            row = int(self.leads[run]) + row - int(self.head[run])
            now, at = now + 1, at - 1
            length[i], place[i] = now, at
        return length, place
