"""Byte-level BPE by replaying the merges over the words of a whole block of the corpus.

The distinct words of a block (a bounded number of characters from one partition) are laid end to end. An inverted
index leads from each applicable merge to the positions of its token pair; the merges are taken in rank order, each is
applied at all its positions at once, and only the pairs left and right of a merged position are looked up again and
filed in the index. A word that occurs a thousand times in the block is merged once. No shuffle is needed: a block is
closed in itself, memory follows the block and not the corpus, and a lost executor costs its blocks only.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.rows import arrow_type, blocks, column, fields, prepare, texts

#: Characters of text whose words are merged together.
BLOCK_CHARS = 2_000_000

#: Words whose ids a worker keeps from one block to the next.
LEXICON_WORDS = 200_000

#: Ids of one batch on the way out.
OUT_IDS = 300_000

NO_RANK = np.int32(2**31 - 1)

#: White space as the tokenizer's regular expressions understand it (the Unicode property).
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CLASSES = {r"\s": WHITE, r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}"}
ASCII_CLASSES = {r"\s": r"\t\n\x0b\x0c\r ", r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}


def spelled(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with its classes spelled out, since regex libraries differ on white space such as 0x1c to 0x1f."""
    out, inside = "", False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part == r"\S":
            out += f"[^{classes[chr(92) + 's']}]"
        elif part in classes:
            out += classes[part] if inside else f"[{classes[part]}]"
        else:
            inside = part == "[" or (inside and part != "]")
            out += part
    return out


class Vocabulary:
    """Ranks of a tiktoken file, the table of token pairs that merge, and the split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            parts = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in parts}
        self.token = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.token[rank] = token
        self.split = regex.compile(spelled(pattern, CLASSES)).findall
        # on ASCII texts letters and digits are plain ranges, which the standard library scans faster
        self.split_ascii = re.compile(spelled(pattern, ASCII_CLASSES)).findall
        self.known: dict[str, bytes] = {}
        found = []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        found.sort()
        self.pairs = np.array([f[0] for f in found] or [-1], dtype=np.int64)
        self.pair_rank = np.array([f[1] for f in found] or [NO_RANK], dtype=np.int32)
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pair_rank = self.rank_of(self.byte_rank[:, None], self.byte_rank[None, :])

    def words(self, text: str) -> list[str]:
        return self.split_ascii(text) if text.isascii() else self.split(text)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NO_RANK)


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def merge_one(word: bytes, vocab: Vocabulary) -> list[int]:
    """One word, always the lowest rank first and the leftmost among equals."""
    ids = [vocab.ranks[word[i:i + 1]] for i in range(len(word))]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    token = vocab.token

    def rank(i: int) -> int | None:
        j = after[i]
        return vocab.ranks.get(token[ids[i]] + token[ids[j]]) if j < n else None

    heap = [(r, i, ids[i], ids[after[i]]) for i in range(n) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ids[i] != a or ids[j] != b:
            continue
        ids[i], after[i], alive[j] = r, after[j], False
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (r := rank(k)) is not None:
                heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
    return [ids[i] for i in range(n) if alive[i]]


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Token ids of each word as 32-bit integers, all words merged together in rank order."""
    if not words:
        return []
    raw = np.frombuffer(b"".join(words), dtype=np.uint8)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(length)
    n = len(raw)
    # position n stands for "outside the word"; its id is in no pair
    ids = np.append(vocab.byte_rank[raw], np.int64(2**31))
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[ends - 1] = n
    before[ends - length] = n
    alive = np.ones(n + 1, dtype=bool)
    alive[n] = False
    rank = np.full(n + 1, NO_RANK, dtype=np.int32)
    rank[:n - 1] = vocab.byte_pair_rank[raw[:-1], raw[1:]]
    rank[ends - 1] = NO_RANK
    owner = np.repeat(np.arange(len(words)), length)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    odd: set[int] = set()  # words in which a merge of lower rank came up late

    def file(positions: np.ndarray) -> None:
        ranks = rank[positions]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        heads = ranks[np.append(0, cuts)].tolist()
        for r, part in zip(heads, np.split(positions, cuts)):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    start = np.flatnonzero(rank != NO_RANK)
    if len(start):
        file(start)
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = at[rank[at] == r]
        at.sort()
        if len(at) > 1:
            at = at[np.append(True, at[1:] != at[:-1])]
        if not len(at):
            continue
        right = after[at]
        if len(at) > 1 and (chained := np.append(False, right[:-1] == at[1:])).any():
            # of overlapping pairs the leftmost merges, then every second one
            step = np.arange(len(at))
            step -= np.maximum.accumulate(np.where(chained, 0, step))
            at, right = at[step % 2 == 0], right[step % 2 == 0]
        beyond = after[right]
        ids[at] = r
        after[at] = beyond
        before[beyond] = at
        alive[right] = False
        rank[right] = NO_RANK
        left = before[at]
        touched = np.concatenate((at, left[(left < n) & alive[np.minimum(left, n)]]))
        rank[touched] = found = vocab.rank_of(ids[touched], ids[after[touched]])
        if (early := found < r).any():
            odd.update(owner[touched[early]].tolist())
        touched = touched[found != NO_RANK]
        if len(touched):
            file(touched)
    kept = np.flatnonzero(alive)
    count = np.bincount(owner[kept], minlength=len(words))
    flat, stops = ids[kept].astype(np.int32).tobytes(), (4 * np.cumsum(count)).tolist()
    out = [flat[a:b] for a, b in zip([0, *stops], stops)]
    for k in odd:
        out[k] = np.array(merge_one(words[k], vocab), dtype=np.int32).tobytes()
    return out


def encode_block(held: list[str], vocab: Vocabulary) -> Iterator[np.ndarray]:
    """Token ids of each text; as in the library, a word that is a token itself needs no merge.

    What the worker has merged before, up to ``LEXICON_WORDS`` words, is not merged again.
    """
    split = [vocab.words(text) for text in held]
    words = set(chain.from_iterable(split))
    known = vocab.known
    new = [word for word in words if word not in known]
    if len(known) + len(new) > LEXICON_WORDS:
        known.clear()
        new = list(words)
    rest, rest_raw = [], []
    for word in new:
        raw = word.encode("utf-8", "surrogatepass")
        whole = vocab.ranks.get(raw)
        if whole is None:
            rest.append(word)
            rest_raw.append(raw)
        else:
            known[word] = whole.to_bytes(4, sys.byteorder)
    known.update(zip(rest, merge_words(rest_raw, vocab)))
    for words in split:
        yield np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=np.int32)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)``, one row per row of ``docs``; ``path`` must be the same on every executor.

    A null or empty text has no ids. Repeated rows stay; a null id stays null. Special tokens do not exist here: their
    strings are ordinary text. One text longer than the block is a block of its own.
    """
    rows = texts(docs, id_col, text_col)
    key = arrow_type(rows, "doc_id")
    schema = pa.schema([("doc_id", key), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for keys, part in _encoded(batches, vocabulary(path, pattern)):
            yield pa.RecordBatch.from_arrays([pa.array(keys, key), _lists(part)], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, ids array<int>")


def _encoded(batches, vocab: Vocabulary) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Keys and ids of documents, about ``OUT_IDS`` ids together."""
    for keys, held in blocks(batches, BLOCK_CHARS):
        part_keys, part, n = [], [], 0
        for k, ids in zip(keys, encode_block(held, vocab)):
            part_keys.append(k)
            part.append(ids)
            n += len(ids)
            if n > OUT_IDS:
                yield part_keys, part
                part_keys, part, n = [], [], 0
        if part_keys:
            yield part_keys, part


def _lists(part: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(part) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in part], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part)))


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, ids, decoded binary)``: the bytes of the ids; null ids decode to no bytes, an unknown id is an error."""
    prepare(encoded.sparkSession)
    rows = encoded.select(column(id_col).alias("doc_id"), F.coalesce(column(ids_col), F.array().cast("array<int>")).alias("ids"))
    key = arrow_type(rows, "doc_id")
    schema = pa.schema([("doc_id", key), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches):
        token = vocabulary(path, pattern).token
        for batch in batches:
            lists = batch.column(1)
            flat = lists.values.to_numpy(zero_copy_only=False).tolist()
            offsets = lists.offsets.to_numpy().tolist()
            out = [b"".join(map(token.__getitem__, flat[a:b])) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(out, pa.binary())], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` as by ``encode`` and then ``decode``, in one worker per task instead of two."""
    rows = texts(docs, id_col, text_col)
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches):
        vocab = vocabulary(path, pattern)
        for keys, part in _encoded(batches, vocab):
            lists = _lists(part)
            decoded = [b"".join(map(vocab.token.__getitem__, ids.tolist())) for ids in part]
            yield pa.RecordBatch.from_arrays([pa.array(keys, schema.field(0).type), lists, pa.array(decoded, pa.binary())], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the operator's ids and bytes."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
