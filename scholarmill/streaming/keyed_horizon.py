"""Running citation counts with one state entry per paper, which a timer ends.

A paper's counts can change until its longest horizon is over.  Then an event-time timer takes its entry out of the
state and the counts are final, so the state holds the papers of about two years, however long the stream runs.

Events of one paper are dealt over ``SALTS`` entries by their own key, so a paper that draws a third of all events is
not one task's work; reading adds the entries up.

A call of the state costs far more than an event, so entries lie in ``GROUPS`` groups by the hash of paper and salt: a
group's entries are one packed value, which a micro-batch with events of the group reads and writes once.  A group has a
timer for the entry that ends first; when it fires, the entries that are over leave and the next one's is set.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from scholarmill.operators.horizon import DAYS_PER_MONTH, MONTHS
from scholarmill.session import DEFAULTS, settings

#: Entries among which the events of one paper are dealt.
SALTS = 16

#: Groups that entries are dealt into. A checkpoint keeps the number it was made with.
GROUPS = 1024

#: An entry in the state; ``ends`` is the time in milliseconds from which its counts are final.
ENTRY = np.dtype([("paper_id", "<i8"), ("salt", "<i4"), ("near", "<i8"), ("far", "<i8"), ("ends", "<i8")])

COUNTED = "paper_id bigint, salt int, near bigint, far bigint, final boolean"

DAY_MS = 86_400_000

#: Values and timers are column families, which the default store lacks; any session gets the one of ours.  Many small
#: stores do not reserve room on disk beforehand.
STATE_STORE = {
    **{key: value for key, value in DEFAULTS.items() if ".stateStore." in key},
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# the processor is also loaded by a Python process beside the driver, which knows no files sent to executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def united(held: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry per paper and salt with the counts of both, and which of them are in ``more``; the first one's end stays."""
    both = np.concatenate([held, more])
    order = np.lexsort((both["salt"], both["paper_id"]))
    both = both[order]
    other = (both["paper_id"][1:] != both["paper_id"][:-1]) | (both["salt"][1:] != both["salt"][:-1])
    starts = np.flatnonzero(np.concatenate([[True], other]))
    entries = both[starts]
    for name in ("near", "far"):
        entries[name] = np.add.reduceat(both[name], starts)
    return entries, np.logical_or.reduceat(order >= len(held), starts)


class PaperCounts(StatefulProcessor):
    """Counts of the two horizons per paper and salt in a group of them; ``days`` are the horizons' lengths."""

    def __init__(self, days: tuple[int, int]):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getValueState("entries", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        held, fresh = self.held(), np.empty(0, ENTRY)
        for chunk in rows:
            fresh = united(fresh, self.counted(chunk))[0]
        entries, changed = united(held, fresh)
        self.keep(entries, held["ends"].min() if len(held) else None)
        yield self.out(entries[changed], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.held()
        over = held["ends"] <= timerValues.getCurrentWatermarkInMs()
        if over.any():
            self.keep(held[~over], None)
            yield self.out(held[over], True)

    def close(self) -> None:
        pass

    def held(self) -> np.ndarray:
        return np.frombuffer(self.entries.get()[0], ENTRY) if self.entries.exists() else np.empty(0, ENTRY)

    def keep(self, entries: np.ndarray, timer: int | None) -> None:
        """Stores the entries and sets a timer for the first end, unless ``timer``, the one that is set, is as early."""
        if not len(entries):
            self.entries.clear()
            return
        self.entries.update((entries.tobytes(),))
        first = int(entries["ends"].min())
        if timer is None or first < timer:
            self.handle.registerTimer(first)

    def counted(self, chunk: pd.DataFrame) -> np.ndarray:
        """An entry for each row; its event counts once for each row of its paper."""
        entries = np.empty(len(chunk), ENTRY)
        for name in ("paper_id", "salt", "ends"):
            entries[name] = chunk[name]
        entries["far"] = chunk["n_papers"]
        entries["near"] = np.where(chunk["age"] <= self.days[0], chunk["n_papers"], 0)
        return entries

    @staticmethod
    def out(entries: np.ndarray, final: bool) -> pd.DataFrame:
        return pd.DataFrame({**{name: entries[name] for name in ("paper_id", "salt", "near", "far")}, "final": final})


def paper_counts(events: DataFrame, papers: DataFrame, event_key: Sequence[str], delay: str, months: tuple[int, int] = MONTHS,
                 salts: int = SALTS, groups: int = GROUPS) -> DataFrame:
    """``COUNTED`` rows: the counts of each changed entry, and once more, as final, when its time is over.

    ``events`` has ``paper_id``, ``cited_at`` (timestamp) and its key; ``papers`` has ``paper_id`` and ``submitted``.
    Events outside the longest horizon are left out before the state.  An event later than ``delay`` is dropped.

    Repeats under a key that holds paper and time are all inside or all outside the horizon, so events outside do not
    reach the state that tells repeats apart either.
    """
    days = tuple(DAYS_PER_MONTH * m for m in months)
    together = {"paper_id", "cited_at"} <= set(event_key)
    fresh = events.withWatermark("cited_at", delay)
    if not together:
        fresh = fresh.dropDuplicatesWithinWatermark(list(event_key))
    # a paper's rows of one day are one with their number, so that no event is taken for a repeat of itself
    dated = papers.groupBy("paper_id", "submitted").agg(F.count("*").alias("n_papers"))
    age = F.date_diff(F.to_date("cited_at"), "submitted")
    inside = fresh.join(dated, "paper_id").where((age >= 0) & (age <= days[1]))
    if together:
        inside = inside.dropDuplicatesWithinWatermark([*event_key, "submitted"])
    salt = F.pmod(F.xxhash64(*event_key), F.lit(salts)).cast("int")
    # late events are gone by now, so the time itself, slow to hand to Python, stays behind; the last day of the horizon counts, so the entry ends with it
    ends = F.unix_millis(F.date_add("submitted", days[1] + 1).cast("timestamp"))
    counted = (inside.select(F.col("paper_id").cast("bigint").alias("paper_id"), salt.alias("salt"), age.alias("age"), ends.alias("ends"), "n_papers")
               .withColumn("group", F.pmod(F.xxhash64("paper_id", "salt"), F.lit(groups)).cast("int")))
    return counted.groupBy("group").transformWithStateInPandas(PaperCounts(days), COUNTED, "update", "eventtime")


def start_paper_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the changed entries of each micro-batch under its own number; a replay overwrites its own folder only."""
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    with settings(counts.sparkSession, STATE_STORE):  # the query keeps the settings it starts with
        return writer.trigger(availableNow=True).start()


def stored_horizon(papers: DataFrame, path: str, months: tuple[int, int] = MONTHS) -> DataFrame:
    """Every paper with the latest counts of its entries, and whether they are final; zero without events."""
    spark: SparkSession = papers.sparkSession
    stored = spark.read.schema(f"{COUNTED}, batch int").parquet(path)
    latest = stored.groupBy("paper_id", "salt").agg(*(F.max_by(c, F.struct("batch", "final")).alias(c) for c in ("near", "far", "final")))
    names = [f"citations_{m}mo" for m in months]
    summed = latest.groupBy("paper_id").agg(F.sum("near").alias(names[0]), F.sum("far").alias(names[1]), F.bool_and("final").alias("final"))
    return papers.join(summed, "paper_id", "left").fillna(0, names).fillna({"final": False})


def end_of(submitted: dt.date, months: int = MONTHS[1]) -> dt.date:
    """The first day on which a paper's counts cannot change."""
    return submitted + dt.timedelta(days=DAYS_PER_MONTH * months + 1)
