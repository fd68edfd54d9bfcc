"""Language of a text by the nearest of several centroids per language.

A text becomes a vector of hashed byte n-grams (two and three bytes of the lower-cased text, all but letters as one
separator), weighted by TF-IDF and normalised. The vectors of a bounded sample of each language are clustered on the
executors; a text gets the language of the centroid with the largest cosine. The cosine grows with the length of a
text, so the fit also scores pieces of its sample, from a letter to the whole text, each by the centroids of the half of
the sample that it is not in. A text much further from its centroid than such pieces of its length is rejected.

The fit is the only part that samples: ``FIT_ROWS`` rows per language at most, whole texts, chosen by a hash of the id.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmill.llm.rows import arrow_type, column, fields, prepare, texts
from scholarmill.session import write_once

#: Documented bound of the fit: sampled rows per language.
FIT_ROWS = 400

#: Number of n-gram buckets, a power of two; centroids per language; rounds of clustering.
BITS, CENTROIDS, ROUNDS = 14, 3, 8
BUCKETS = 1 << BITS

#: A text is rejected below this share of the least cosine of pieces of its length (the hundredth part left out).
REJECT_SHARE = 0.4

#: Lengths are told apart by the binary digits of the number of different n-grams; a limit rests on so many pieces at least.
BANDS, ENOUGH = BITS + 2, 50

UNKNOWN = "und"

TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Occurrences per bucket over the whole text."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(TABLE) + b" ", dtype=np.uint8).astype(np.uint32)
    two = raw[:-1] << np.uint32(8) | raw[1:]
    three = two[:-1] << np.uint32(8) | raw[2:]
    hashed = np.concatenate((two | np.uint32(1 << 24), three)) * np.uint32(2654435761)
    return np.bincount(hashed >> np.uint32(32 - BITS), minlength=BUCKETS)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    norm = np.sqrt((weighted * weighted).sum(axis=-1, keepdims=True))
    return weighted / np.maximum(norm, 1e-12)


def band(counts: np.ndarray) -> int:
    """Length of a text by its different n-grams, so that repeating a line does not make it longer."""
    return int(np.count_nonzero(counts)).bit_length()


def pieces(text: str) -> list[str]:
    """One piece of 1, 2, 4, ... characters each, begun at a word if one begins shortly before, and the whole text."""
    draw = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    cut = []
    for size in (1 << i for i in range((len(text) - 1).bit_length())):
        at = draw.randrange(len(text) - size + 1)
        word = text.rfind(" ", max(0, at - 16), at) + 1
        at = word if word or at <= 16 else at
        cut.append(text[at:at + size])
    return [*cut, text]


def limits(bands: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """Per band the cosine that all but a hundredth of its pieces reach; a band with few is taken together with its neighbours."""
    out, groups, held = np.zeros(BANDS), [], []
    for b in range(BANDS):
        held.append(b)
        if np.isin(bands, held).sum() >= ENOUGH:
            groups.append(held)
            held = []
    groups = [*groups[:-1], (groups[-1] if groups else []) + held]
    for group in groups:
        inside = cosines[np.isin(bands, group)]
        out[group] = np.quantile(inside, 0.01) if len(inside) else 0.0
    return out


def clustered(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids by cosine.

    They start from the means of ``k`` equal parts in order of nearness to the common mean, so no outlier gets one.
    """
    order = np.argsort(-(vectors @ vectors.mean(axis=0)), kind="stable")
    centres = np.array([vectors[part].mean(axis=0) for part in np.array_split(order, min(k, len(vectors)))])
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        member = (vectors @ centres.T).argmax(axis=1)
        centres = np.array([vectors[member == c].mean(axis=0) if (member == c).any() else centres[c] for c in range(len(centres))])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


class Model:
    """What a prediction needs: idf, centroids, their languages and the languages' least cosines by band."""

    def __init__(self, idf: np.ndarray, centres: np.ndarray, langs: list[str], least: np.ndarray):
        self.idf, self.centres, self.langs, self.least = idf, centres, langs, least

    def predict(self, text: str) -> tuple[str, float, bool]:
        """``(language, cosine, rejected)``; ties go to the language that comes first in the alphabet."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = gram_counts(text)
        near = self.centres @ unit(counts, self.idf).astype(np.float32)
        best = int(near.argmax())
        return self.langs[best], float(min(max(near[best], 0.0), 1.0)), bool(near[best] < REJECT_SHARE * self.least[best, band(counts)])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Model:
    """A model from rows with a language and a letter in their text; without any such row it knows no language."""
    prepare(labelled.sparkSession)
    rows = labelled.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), column(lang_col).cast("string").alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("draw", F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)))
    n = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not n:
        return Model(np.ones(BUCKETS), np.zeros((0, BUCKETS)), [], np.zeros((0, BANDS)))
    # thin each language to about twice the bound before anything is ordered
    share = F.create_map(*(x for lang, c in n.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * fit_rows / c)))))
    thinned = rows.filter((F.pmod("draw", F.lit(1_000_000)) / 1e6) < share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text"))
    ranked = thinned.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= fit_rows)
    sample = write_once(ranked.select("lang", "text", (F.col("rank") % 2).alias("half")), "language-sample")

    schema = pa.schema([("lang", pa.string()), ("half", pa.int32()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def vectors(batches):
        for batch in batches:
            out = {"lang": [], "half": [], "buckets": [], "counts": []}
            for lang, text, half in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    counts = gram_counts(text)
                    used = np.flatnonzero(counts)
                    out["lang"].append(lang)
                    out["half"].append(half)
                    out["buckets"].append(used.astype(np.int32))
                    out["counts"].append(np.minimum(counts[used], 2**31 - 1).astype(np.int32))
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    sparse = write_once(sample.mapInArrow(vectors, "lang string, half int, buckets array<int>, counts array<int>"), "grams")
    total = sparse.count()
    idf = np.full(BUCKETS, np.log(1.0 + total))
    for r in sparse.select(F.explode("buckets").alias("b")).groupBy("b").count().collect():  # one row per bucket at most
        idf[r.b] = np.log((1.0 + total) / (1.0 + r["count"])) + 0.1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("buckets", key=lambda c: c.map(lambda b: (len(b), *b[:20])), kind="stable")
        dense = np.zeros((len(group), BUCKETS), dtype=np.int32)
        for i, (b, c) in enumerate(zip(group["buckets"], group["counts"])):
            dense[i, b] = c
        vectors, half = unit(dense, idf), group["half"].to_numpy()
        out = []
        for part, inside in ((-1, half >= 0), (0, half == 0), (1, half == 1)):
            if inside.any():
                out += [(group["lang"].iloc[0], part, no, c.astype(np.float32).tobytes()) for no, c in
                        enumerate(clustered(vectors[inside], centroids, ROUNDS))]
        return pd.DataFrame(out, columns=["lang", "part", "no", "centre"])

    # a group is a language's sample, FIT_ROWS rows at most
    found = sorted(sparse.groupBy("lang").applyInPandas(cluster, "lang string, part int, no int, centre binary").collect(),
                   key=lambda r: (r.lang, r.no))

    def model(part: int) -> Model:
        rows = [r for r in found if r.part == part]
        centres = np.array([np.frombuffer(r.centre, dtype=np.float32) for r in rows]).reshape(-1, BUCKETS)
        return Model(idf, centres, [r.lang for r in rows], np.zeros((len(rows), BANDS)))

    whole = model(-1)
    # what a half's model gives the pieces of the other half
    other = labelled.sparkSession.sparkContext.broadcast((model(1), model(0)))

    def scores(batches):
        for batch in batches:
            out = {"lang": [], "band": [], "cosine": []}
            for text, half in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for piece in pieces(text):
                    lang, cosine, _ = other.value[half].predict(piece)
                    if lang != UNKNOWN:
                        out["lang"].append(lang)
                        out["band"].append(band(gram_counts(piece)))
                        out["cosine"].append(cosine)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("lang", pa.string()), ("band", pa.int32()), ("cosine", pa.float64())]))

    def limit(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "least": [limits(group["band"].to_numpy(), group["cosine"].to_numpy())]})

    # a group is a language's pieces, a few per row of the sample
    by_lang = sample.mapInArrow(scores, "lang string, band int, cosine double").groupBy("lang").applyInPandas(limit, "lang string, least array<double>")
    least = {r.lang: r.least for r in by_lang.collect()}
    whole.least = np.array([least.get(lang, [0.0] * BANDS) for lang in whole.langs]).reshape(-1, BANDS)
    return whole


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)``, one row per row of ``docs``, from the whole text alone.

    A null text or one without a letter is ``und`` with score 0 and rejected. Repeated rows stay.
    """
    rows = texts(docs, id_col, text_col)
    sent = rows.sparkSession.sparkContext.broadcast(model)  # languages x centroids x buckets, not more with more texts
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("rejected", pa.bool_())])

    def run(batches):
        own = sent.value
        for batch in batches:
            out = [own.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
                 pa.array([x[2] for x in out], pa.bool_())], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id"):
    """The third of the ids that no fit may see; a null id is not held out."""
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the model does not reject; all columns stay, and no text is shuffled."""
    sent = prepare(docs.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(held):
        return held.map(lambda text: text is not None and not sent.value.predict(text)[2]).astype(bool)

    return docs.filter(known(column(text_col)))
