"""Token counts of whole texts, huge ones by overlapping chunks.

A text longer than a chunk is encoded in chunks that overlap, with the place of every token. Two neighbouring chunks
are spliced at a token boundary that both have and that is proven stable: if no piece of the vocabulary holds two
characters side by side, no merge ever crosses the place between them, so what lies left of it cannot change the
tokens on its right. If the overlap has no such place, the overlap is widened until it has one; if the chunk has none
either, the chunk is doubled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.rows import arrow_type, fields, texts

#: Characters of one chunk and of the overlap that is tried first.
CHUNK, OVERLAP = 16_384, 256

SPACE = "▁"


class Counter:
    """A model and the pairs of neighbouring characters that its pieces hold."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        if not any(map(self.model.is_byte, range(n))) or self.model.normalize("a  \ufb01") != f"{SPACE}a{SPACE * 2}\ufb01":
            raise ValueError("chunks can only be spliced for models with byte pieces that leave texts as they are")
        pieces = map(self.model.id_to_piece, range(n))
        self.joined = {piece[i:i + 2] for piece in pieces for i in range(len(piece) - 1)}

    def stable(self, text: str, at: int) -> bool:
        """No token can hold both the character before ``at`` and the one at it."""
        return text[at - 1:at + 1].replace(" ", SPACE) not in self.joined

    def starts(self, text: str, begin: int, stop: int) -> list[int]:
        """Start of each token of ``text[begin:stop]``; the character before ``begin`` keeps the dummy prefix away."""
        before = min(begin, 1)
        part = text[begin - before:stop]
        found = [piece.begin for piece in self.model.encode(part, return_type="proto").pieces]
        if not part.isascii():  # the library counts bytes
            raw = np.frombuffer(part.encode(), dtype=np.uint8)
            found = (np.cumsum((raw & 0xC0) != 0x80) - 1)[np.array(found, dtype=np.int64)].tolist()
        return [x for x in (begin - before + y for y in found) if x >= begin]

    def spliced(self, text: str, chunk: int, overlap: int) -> list[int]:
        """Start of each token of the whole text, from overlapping chunks; a character's bytes share a start."""
        out: list[int] = []
        begin, end = 0, min(chunk, len(text))
        held = self.starts(text, begin, end)
        while end < len(text):
            stop = min(len(text), end + max(chunk, end - begin))
            width, cut = overlap, None
            while True:
                start = max(begin, end - width)
                following = self.starts(text, start, stop)
                both = set(held).intersection(following)
                cut = max((x for x in both if start < x < end and self.stable(text, x)), default=None)
                if cut is not None or start == begin:
                    break
                width *= 2
            if cut is None:
                held = following  # from the last splice on, which is stable
            else:
                out += [x for x in held if x < cut]
                held = [x for x in following if x >= cut]
                begin = cut
            end = stop
        return out + held


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
          overlap: int = OVERLAP, limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    A null or empty text has no bytes and no tokens; repeated rows stay. ``path`` must be the same on every executor.
    """
    rows = texts(docs, id_col, text_col)
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(batches):
        own = counter(path)
        for batch in batches:
            held = batch.column(1).to_pylist()
            short = [t for t in held if len(t) <= chunk]
            lengths = iter([len(ids) for ids in own.model.encode(short, num_threads=1)] if short else [])
            n = [next(lengths) if len(t) <= chunk else len(own.spliced(t, chunk, overlap)) for t in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in held], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, n_bytes bigint, n_tokens bigint, over_limit boolean")
