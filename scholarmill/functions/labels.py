"""Names and verdicts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feature groups by the prefix of the feature's name.
GROUP_PREFIXES = ("tfidf", "cat", "has")


def feature_group(name: Column) -> Column:
    out = F.lit("other")
    for g in reversed(GROUP_PREFIXES):
        out = F.when(F.startswith(name, F.lit(g + "_")), g).otherwise(out)
    return out


def pretty_feature(name: Column) -> Column:
    """``tfidf_x`` reads ``x``, ``has_x`` reads ``has:x``, ``cat_x`` reads ``cat:x``."""
    plain = F.replace(name, F.lit("tfidf_"), F.lit(""))
    flagged = F.replace(plain, F.lit("has_"), F.lit("has:"))
    return F.replace(flagged, F.lit("cat_"), F.lit("cat:"))


def tagged_feature(name: Column) -> Column:
    """As above with ``[kw]`` and ``[cat]`` tags."""
    plain = F.replace(name, F.lit("tfidf_"), F.lit(""))
    flagged = F.replace(plain, F.lit("has_"), F.lit("[kw] "))
    return F.replace(flagged, F.lit("cat_"), F.lit("[cat] "))


def fit_gap(train_r2: Column, test_r2: Column) -> Column:
    gap = train_r2 - test_r2
    return (F.when(gap < 0.05, "good").when(gap > 0.15, "overfit").otherwise("moderate"))


def ablation_verdict(pct_change: Column) -> Column:
    """A large negative change counts as moderate."""
    return (F.when(F.abs(pct_change) < 5, "none").when(pct_change > 15, "substantial")
            .otherwise("moderate"))


def one_hot(category: Column, values: list[str]) -> dict[str, Column]:
    """One 0/1 column per fitted value, in the order of the values."""
    return {f"cat_{v}": F.coalesce((category == v).cast("int"), F.lit(0)) for v in sorted(values)}


def decode_one_hot(values: list[str]) -> Column:
    """The first category whose column exceeds one half, else null."""
    return F.coalesce(*(F.when(F.col(f"`cat_{v}`") > 0.5, v) for v in sorted(values)), F.lit(None))
