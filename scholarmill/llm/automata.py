"""Weighted acyclic automata over sequences of words: each accepted sequence carries a count.

A state is a list of arcs, sorted by symbol; an arc has a symbol (an index into the sorted words), a weight and a target.
The weight of the arc that a sequence ends with is the sequence's count; 0 means that the sequence only leads on to
others. Sequences come sorted, as *layers*: layer k has a row ``(parent, symbol, weight)`` for every prefix of k + 1
symbols, ``parent`` being its place in layer k - 1. From the longest prefixes up, a prefix is closed when all that
continues it has been read; a register of lists of arcs, by their hash and then compared arc by arc, gives equal lists
one state. So the automaton is the smallest for its weights, which are not moved along paths.

Layers are numpy columns, and all work is done on whole columns.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CODEC = pa.Codec("zstd", compression_level=1)

Layer = tuple[np.ndarray, np.ndarray, np.ndarray]


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin, begin + 1, ...`` of each run, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(begin - before, size) + np.arange(int(size.sum()), dtype=np.int64)


def ordered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, sorted by their bytes, and the place of each of ``words`` among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


@dataclass(frozen=True)
class Automaton:
    """State s has the arcs ``first[s] : first[s + 1]``; state 0 has none, the last state is the start."""

    words: pa.Array
    first: np.ndarray
    symbol: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def layers(self) -> list[Layer]:
        """All accepted sequences and their prefixes, sorted."""
        out: list[Layer] = []
        state = np.array([len(self.first) - 2])
        while True:
            begin, size = self.first[state], self.first[state + 1] - self.first[state]
            at = runs(begin, size)
            if not len(at):
                return out
            out.append((np.repeat(np.arange(len(state)), size), self.symbol[at], self.weight[at]))
            state = self.target[at]

    def packed(self) -> bytes:
        lengths = pc.binary_length(self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        columns = [lengths, np.diff(self.first), self.symbol, self.weight, self.target]
        parts = [b"".join(self.words.to_pylist())]
        kinds = []
        for values in columns:
            kind = np.min_scalar_type(int(values.max(initial=0)))
            kinds += [kind.itemsize, len(values)]
            parts.append(values.astype(kind).tobytes())
        raw = struct.pack("<11q", len(parts[0]), *kinds) + b"".join(parts)
        return struct.pack("<q", len(raw)) + CODEC.compress(raw, asbytes=True)

    @classmethod
    def unpacked(cls, held: bytes) -> Automaton:
        raw = CODEC.decompress(held[8:], struct.unpack("<q", held[:8])[0], asbytes=True)
        size, *kinds = struct.unpack_from("<11q", raw)
        at = 88 + size
        columns = []
        for width, n in zip(kinds[::2], kinds[1::2]):
            columns.append(np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=at).astype(np.int64))
            at += width * n
        lengths, arcs, *rest = columns
        offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[88:88 + size])])
        return cls(words, np.append(0, np.cumsum(arcs)), *rest)


#: Odd multipliers of the hash of arcs (fixed values; any odd numbers will do).
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def list_hashes(arcs: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each list of arcs; an empty list has its own."""
    place = np.arange(len(arcs), dtype=np.int64) - np.repeat(begin, size)
    h = np.full(len(arcs), seed, dtype=np.uint64)
    for column, factor in zip((*arcs.T, place), MIX):
        h = (h ^ column.astype(np.uint64)) * factor
        h ^= h >> np.uint64(31)
    ends = np.append(np.uint64(0), np.cumsum(h))
    return ends[begin + size] - ends[begin] + size.astype(np.uint64) * MIX[0]


def same_lists(left: np.ndarray, begin: np.ndarray, right: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
    """Whether lists of these sizes hold the same arcs on both sides."""
    return bool((left[runs(begin, size)] == right[runs(other, size)]).all())


def built(layers: list[Layer], words: pa.Array, seed: int = 1) -> Automaton:
    """The automaton of sorted sequences; ``words`` that no layer names are left out."""
    used = np.zeros(len(words), dtype=bool)
    for _, symbol, _ in layers:
        used[symbol] = True
    number = np.cumsum(used) - 1
    # the register: arcs of all states so far, where each state's begin, their hashes in order and whose they are
    arcs, first = np.zeros((0, 3), dtype=np.int64), np.zeros(2, dtype=np.int64)
    held, owner = list_hashes(arcs, first[:1], first[:1], seed), np.zeros(1, dtype=np.int64)
    target = np.zeros(len(layers[-1][0]) if layers else 0, dtype=np.int64)
    for depth in range(len(layers) - 1, -1, -1):
        parent, symbol, weight = layers[depth]
        rows = np.stack([number[symbol], weight, target], axis=1)
        size = np.bincount(parent, minlength=len(layers[depth - 1][0]) if depth else 1)
        begin = np.cumsum(size) - size
        own, chosen, group = np.unique(list_hashes(rows, begin, size, seed), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(held, own), len(held) - 1)
        old = held[at] == own
        fresh = np.flatnonzero(~old)
        state = np.where(old, owner[at], 0)
        state[fresh] = len(first) - 1 + np.arange(len(fresh))
        known = state[old]
        like = chosen[group]
        # equal hashes are equal lists, or another hash is taken
        if not ((size == size[like]).all() and (size[chosen[old]] == first[known + 1] - first[known]).all()
                and same_lists(rows, begin, rows, begin[like], size) and same_lists(rows, begin[chosen[old]], arcs, first[known], size[chosen[old]])):
            return built(layers, words, seed + 1)
        new = chosen[fresh]
        arcs = np.concatenate([arcs, rows[runs(begin[new], size[new])]])
        first = np.append(first, first[-1] + np.cumsum(size[new]))
        held, owner = np.append(held, own[fresh]), np.append(owner, state[fresh])
        order = np.argsort(held)
        held, owner = held[order], owner[order]
        target = state[group]
    # the start comes last, also where another state is like it
    if len(first) - 2 != (target[0] if layers else 0):
        at = int(target[0])
        arcs = np.concatenate([arcs, arcs[first[at]:first[at + 1]]])
        first = np.append(first, first[-1] + first[at + 1] - first[at])
    return Automaton(words.filter(pa.array(used)), first, *(np.ascontiguousarray(arcs[:, i]) for i in range(3)))


def united(several: list[Automaton]) -> Automaton:
    """Accepts what any of them accepts, with the sum of the weights."""
    return several[0] if len(several) == 1 else built(*added([(a.layers(), a.words) for a in several]))


def added(several: list[tuple[list[Layer], pa.Array]]) -> tuple[list[Layer], pa.Array]:
    """The layers of all sequences with the sum of their weights, and their words."""
    if len(several) == 1:
        return several[0]
    words, place = ordered(pa.concat_arrays([own for _, own in several]))
    ends = np.cumsum([len(own) for _, own in several])
    named = [place[end - len(own):end] for (_, own), end in zip(several, ends)]
    at = [np.zeros(1, dtype=np.int64) for _ in several]
    out: list[Layer] = []
    width = max(1, len(words))
    for depth in range(max((len(layers) for layers, _ in several), default=0)):
        some = [i for i, (layers, _) in enumerate(several) if depth < len(layers)]
        key = np.concatenate([at[i][several[i][0][depth][0]] * width + named[i][several[i][0][depth][1]] for i in some])
        weight = np.concatenate([several[i][0][depth][2] for i in some])
        distinct, merged, order, begin = grouped(key)
        first = 0
        for i in some:
            n = len(several[i][0][depth][0])
            at[i] = merged[first:first + n]
            first += n
        out.append((distinct // width, distinct % width, np.add.reduceat(weight[order], begin)))
    return out, words


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(distinct, group, order, begin)``: sorted distinct keys, the group of each key, an order of the keys by group, where groups begin."""
    bits = max(1, (len(key) - 1).bit_length())
    if len(key) and int(key.max()).bit_length() + bits < 63:
        # key and place in one number, so that numbers alone are sorted
        packed = np.sort(key << bits | np.arange(len(key)))
        order = packed & ((1 << bits) - 1)
        ordered_key = packed >> bits
    else:
        order = np.argsort(key, kind="stable")
        ordered_key = key[order]
    fresh = np.append(True, ordered_key[1:] != ordered_key[:-1])[:len(key)]
    group = np.empty(len(key), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    begin = np.flatnonzero(fresh)
    return ordered_key[begin], group, order, begin


def at_least(layers: list[Layer], words: pa.Array, least: int) -> Automaton:
    """The automaton of the sequences of at least this weight alone, with what leads to them."""
    keep = [weight >= least for _, _, weight in layers]
    for depth in range(len(layers) - 1, 0, -1):
        keep[depth - 1][layers[depth][0][keep[depth]]] = True
    out: list[Layer] = []
    place = np.zeros(1, dtype=np.int64)
    for (parent, symbol, weight), own in zip(layers, keep):
        if not own.any():
            break
        out.append((place[parent[own]], symbol[own], np.where(weight[own] >= least, weight[own], 0)))
        place = np.cumsum(own) - 1
    return built(out, words)


def cuts(layers: list[Layer], words: list[bytes], bounds: list[tuple[bytes, ...]]) -> np.ndarray:
    """``out[j, k]``: how many sequences of layer k are smaller than ``bounds[j]``, sequences being compared word by word."""
    from bisect import bisect_left

    out = np.zeros((len(bounds), len(layers)), dtype=np.int64)
    for j, bound in enumerate(bounds):
        begin, end, equal = 0, 1, True  # children of the node that is equal so far are begin : end
        for depth, (parent, symbol, _) in enumerate(layers):
            low = int(np.searchsorted(parent, begin))
            if not equal or depth >= len(bound):
                # all that continue the first node not below the bound are above it
                out[j, depth], begin = low, low
                equal = False
                continue
            high = int(np.searchsorted(parent, end))
            word = bisect_left(words, bound[depth])
            same = word < len(words) and words[word] == bound[depth]
            place = low + int(np.searchsorted(symbol[low:high], word))
            equal = same and place < high and symbol[place] == word
            # an equal one is smaller if the bound goes on
            out[j, depth] = place + (equal and depth + 1 < len(bound))
            begin, end = place, place + 1
    return out


def ranged(layers: list[Layer], words: pa.Array, bounds: list[tuple[bytes, ...]]) -> list[tuple[int, Automaton]]:
    """``(range, automaton)``: range j has the sequences from ``bounds[j - 1]`` on that are smaller than ``bounds[j]``."""
    if not layers:
        return []
    whole = np.array([[len(layer[0]) for layer in layers]])
    at = np.concatenate([np.zeros_like(whole), cuts(layers, words.to_pylist(), bounds) if bounds else whole[:0], whole])
    out = []
    for j, (begin, end) in enumerate(zip(at, at[1:])):
        depth = int(np.flatnonzero(end > begin).max(initial=-1)) + 1
        if not depth:
            continue
        part: list[Layer] = []
        lead = begin[:depth].copy()
        for k in range(depth - 1, 0, -1):
            # the path to the first sequence leads on and has no weight here
            if lead[k] < end[k]:
                lead[k - 1] = min(lead[k - 1], layers[k][0][lead[k]])
        for k in range(depth):
            parent, symbol, weight = (c[lead[k]:max(end[k], lead[k])] for c in layers[k])
            weight = weight.copy()
            weight[:begin[k] - lead[k]] = 0
            part.append((parent - (lead[k - 1] if k else 0), symbol, weight))
        out.append((j, built(part, words)))
    return out


def accepting(sequences: list[tuple[bytes, ...]]) -> tuple[list[Layer], list[bytes], np.ndarray, np.ndarray]:
    """Layers of sorted distinct sequences, their sorted words, and depth and place of each sequence."""
    words = sorted({w for s in sequences for w in s})
    number = {w: i for i, w in enumerate(words)}
    held: list[list[tuple[int, int]]] = []
    path: list[bytes] = []
    depths, places = [], []
    for sequence in sequences:
        shared = 0
        while shared < min(len(path), len(sequence)) and path[shared] == sequence[shared]:
            shared += 1
        for k in range(shared, len(sequence)):
            if k == len(held):
                held.append([])
            held[k].append((len(held[k - 1]) - 1 if k else 0, number[sequence[k]]))
        path = list(sequence)
        depths.append(len(sequence) - 1)
        places.append(len(held[len(sequence) - 1]) - 1)
    layers = [(c[:, 0], c[:, 1], np.zeros(len(c), dtype=np.int64)) for c in map(np.array, held)]
    return layers, words, np.array(depths, dtype=np.int64), np.array(places, dtype=np.int64)


def composed(sequences: list[tuple[bytes, ...]], counts: Automaton) -> np.ndarray:
    """The weight of each of the sorted ``sequences``: their acceptor and the transducer of counts are walked together."""
    layers, words, depths, places = accepting(sequences)
    known = pc.index_in(pa.array(words, pa.binary()), value_set=counts.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, len(counts.words))
    arcs = np.repeat(np.arange(len(counts.first) - 1), np.diff(counts.first)) * width + counts.symbol
    state = np.array([len(counts.first) - 2])
    out = np.zeros(len(sequences), dtype=np.int64)
    for depth, (parent, symbol, _) in enumerate(layers):
        own = known[symbol]
        wanted = np.where((own < 0) | (state[parent] < 0), -1, state[parent] * width + own)
        at = np.searchsorted(arcs, wanted)
        at[at == len(arcs)] = 0
        found = (arcs[at] == wanted) if len(arcs) else np.zeros(len(wanted), dtype=bool)
        weight = np.where(found, counts.weight[at], 0) if len(arcs) else np.zeros(len(wanted), dtype=np.int64)
        state = np.where(found, counts.target[at], -1) if len(arcs) else np.full(len(wanted), -1)
        here = depths == depth
        out[here] = weight[places[here]]
    return out
