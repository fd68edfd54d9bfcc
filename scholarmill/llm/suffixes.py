"""Two-stage suffix sorting of a block of byte strings, and the windows that its strings share.

A suffix is of type B if it is smaller than the suffix one place further on, else of type A. Only the needed suffixes of
type B are sorted directly, eight bytes at a time and among ties only. Those of type A are induced: the order is
scanned bucket by bucket of the first byte, and whatever stands one place before a sorted suffix, if it is of type A,
comes next in the bucket of its own first byte. Common prefixes of neighbours then tell which windows are equal.
"""

from __future__ import annotations

import numpy as np

WORD = 8


class Text:
    """Strings laid end to end, each followed by a mark that is smaller than any byte."""

    def __init__(self, strings: list[bytes], starts: np.ndarray):
        """``starts``: the number of places at the front of each string whose suffixes are to be ordered."""
        length = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        self.begin = np.cumsum(length + 1) - length - 1
        raw = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
        self.symbol = raw.astype(np.int16) + 1
        self.marks = self.begin + length
        self.symbol[self.marks] = 0
        n = len(raw)
        padded = np.append(raw, np.zeros(16 * WORD, dtype=np.uint8))
        words = padded[:n + 15 * WORD].astype(np.uint64)
        for size in (1, 2, 4):  # a window of bytes becomes one big-endian word
            words = words[:-size] << np.uint64(8 * size) | words[size:]
        self.word = words
        self.type_a = self._types()
        wanted = np.zeros(n + 1, dtype=np.int64)
        np.add.at(wanted, self.begin, 1)
        np.add.at(wanted, self.begin + starts, -1)
        self.window = np.cumsum(wanted[:n]) > 0
        self.needed = self._needed()

    def _types(self) -> np.ndarray:
        """Type A: greater than the next symbol, or equal to it and the next is of type A; marks are of type B."""
        s = self.symbol
        n = len(s)
        differs = np.append(s[:-1] != s[1:], True)
        falls = np.append(s[:-1] > s[1:], False)
        last = np.where(differs, np.arange(n), n)
        last = np.minimum.accumulate(last[::-1])[::-1]  # the end of each run of equal symbols
        return falls[last]

    def _needed(self) -> np.ndarray:
        """Windows, and what the last window's type A run leads to: the next suffix of type B."""
        needed = self.window.copy()
        front = np.flatnonzero(needed[:-1] & ~needed[1:] & self.type_a[:-1]) + 1
        while len(front):
            needed[front] = True
            front = front[self.type_a[front]] + 1
            front = front[~needed[front]]
        return needed

    def sorted_directly(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Positions in the order of their first ``depth`` bytes at least."""
        group = np.zeros(len(at), dtype=np.int64)
        tied = np.arange(len(at))
        order = at.copy()
        # the first symbol tells a mark from a zero byte
        for step in range(-1, -(-depth // WORD)):
            part = order[tied]
            key = self.symbol[part].astype(np.uint64) if step < 0 else self.word[part + WORD * step]
            rank = np.lexsort((key, group[tied]))
            order[tied] = part[rank]
            key, own = key[rank], group[tied]
            new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
            group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
            alone = new & np.append(new[1:], True)
            tied = tied[~alone]
            if not len(tied):
                break
        return order

    def order(self, depth: int) -> np.ndarray:
        """All windows, in the order of their first ``depth`` bytes at least."""
        s = self.symbol
        direct = self.sorted_directly(np.flatnonzero(self.needed & ~self.type_a), depth)
        cuts = np.searchsorted(s[direct], np.arange(258))
        arrived: list[list[np.ndarray]] = [[] for _ in range(257)]
        done = []
        induced = self.needed & self.type_a
        for c in range(257):
            wave = np.concatenate(arrived[c]) if arrived[c] else np.zeros(0, dtype=np.int64)
            parts = [wave]
            while len(wave):
                before = wave[wave > 0] - 1
                wave = before[induced[before] & (s[before] == c)]
                parts.append(wave)
            parts.append(direct[cuts[c]:cuts[c + 1]])
            bucket = np.concatenate(parts)
            done.append(bucket)
            before = bucket[bucket > 0] - 1
            before = before[induced[before] & (s[before] > c)]
            if len(before):
                before = before[np.argsort(s[before], kind="stable")]
                heads = s[before]
                edge = np.flatnonzero(heads[1:] != heads[:-1]) + 1
                for part in np.split(before, edge):
                    arrived[s[part[0]]].append(part)
        found = np.concatenate(done)
        return found[self.window[found]]

    def common(self, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
        """Whether the strings at ``a`` and ``b`` have ``least`` bytes in common; both must reach that far."""
        equal = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        for step in range(0, least - WORD + 1, WORD):
            at = at[self.word[a[at] + step] == self.word[b[at] + step]]
        if least % WORD:
            if least >= WORD:
                at = at[self.word[a[at] + least - WORD] == self.word[b[at] + least - WORD]]
            else:
                rest = np.uint64(8 * (WORD - least))
                at = at[self.word[a[at]] >> rest == self.word[b[at]] >> rest]
        equal[:] = False
        equal[at] = True
        return equal


def shared_windows(strings: list[bytes], starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(class, string, place)`` of the windows of ``length`` bytes that stand at two or more places.

    Windows begin at the first ``starts`` places of each string, which must reach ``length`` bytes beyond the last.
    """
    text = Text(strings, starts)
    order = text.order(length)
    same = text.common(order[1:], order[:-1], length)
    member = np.append(same, False) | np.append(False, same)
    number = np.cumsum(~np.append(False, same))[member]
    at = order[member]
    string = np.searchsorted(text.begin, at, side="right") - 1
    return number, string, at - text.begin[string]
