"""Which of many terms a text holds, in one pass over the text.

The terms become one automaton (goto and failure links over characters), which a task builds once and runs over each of
its texts. A text is read once however many terms there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from scholarmill.session import ship

#: Found terms that leave a task together.
ROWS_TOGETHER = 100_000


class TermSearch:
    """Finds terms inside texts, within words too; terms are known by their place in the list."""

    def __init__(self, terms: Sequence[str]):
        from ahocorasick import Automaton

        self.everywhere = [i for i, t in enumerate(terms) if t == ""]
        self.automaton = Automaton()
        places: dict[str, list[int]] = {}
        for i, term in enumerate(terms):
            if term:
                places.setdefault(term, []).append(i)
        for term, own in places.items():
            self.automaton.add_word(term, tuple(own))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def found(self, text: str) -> list[int]:
        """Places of the terms that ``text`` holds, rising; a term that is listed twice has both."""
        if self.empty:
            return list(self.everywhere)
        hits = {own for _, own in self.automaton.iter(text)}
        return sorted([*self.everywhere, *(i for own in hits for i in own)])


@lru_cache(maxsize=4)
def search_of(terms: tuple[str, ...]) -> TermSearch:
    return TermSearch(terms)


def terms_in(texts: DataFrame, terms: Sequence[str], first: int | None = None) -> DataFrame:
    """``(key, rank, place)`` of every term, or the ``first`` ones, that ``texts(key, text)`` hold.

    ``place`` is that of the term in the list, ``rank`` counts a text's terms from 1. A null text holds nothing. No join and no shuffle: each text is searched
    where it lies.
    """
    ship(texts.sparkSession)
    terms = tuple(terms)
    kind = texts.schema["key"].dataType

    def run(batches):
        search = search_of(terms)
        for batch in batches:
            rows, ranks, places = [], [], []
            # a text at a time: all of a batch as Python strings would be held beside the batch
            for row, text in enumerate(batch.column(1)):
                own = search.found(text.as_py())[:first] if text.is_valid else []
                places += own
                ranks += range(1, len(own) + 1)
                rows += [row] * len(own)
                if len(rows) >= ROWS_TOGETHER:
                    yield held(batch, rows, ranks, places)
                    rows, ranks, places = [], [], []
            if rows:
                yield held(batch, rows, ranks, places)

    def held(batch, rows, ranks, places):
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(ranks, pa.int32()), pa.array(places, pa.int32())], names=["key", "rank", "place"])

    return texts.select("key", "text").mapInArrow(run, f"key {kind.simpleString()}, rank int, place int")
