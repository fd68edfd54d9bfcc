"""Near copies among vectors by an epsilon grid order join.

Unit vectors with a cosine of at least ``t`` are at most ``sqrt(2 - 2t)`` apart, also along any axis. Vectors are ordered
by their grid cells of that width along the leading principal axes; the order is cut into blocks, and only pairs of
blocks whose boxes are near enough are joined. Within a pair the two sequences are halved again and again, and halves
whose boxes are too far apart are skipped. What is left is compared by matrix products in double precision.

Equal vectors are one row with a number of copies. A pair of blocks gives a count of links per vector and a spanning
forest of its links, never all pairs. The axes steer the order only, so they are fitted on ``AXIS_ROWS`` vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.components import components
from scholarmill.llm.rows import column, prepare
from scholarmill.session import settings, write_once

LEAST_COSINE = 0.98

#: Documented bound of the sample that the principal axes come from; leading axes used; vectors of a block and of a leaf.
#: A block goes to every block near it, so blocks are large; within a pair of them halving skips what is apart.
AXIS_ROWS, AXES, BLOCK_ROWS, LEAF_ROWS = 20_000, 4, 2048, 32

#: Rows of two blocks each that Arrow hands over at once.
TOGETHER = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def units(lists: pa.Array) -> list[np.ndarray]:
    """Each vector at length one, in double precision; the largest component comes first lest squares overflow."""
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    cuts = lists.offsets.to_numpy()
    out = []
    for a, b in zip(cuts, cuts[1:]):
        v = flat[a:b] / np.abs(flat[a:b]).max()
        out.append(v / np.sqrt(v @ v))
    return out


def element(classes: DataFrame) -> np.dtype:
    """What a component is sent as: single precision where the vectors come so, else double."""
    kind = classes.schema["embedding"].dataType.elementType.simpleString()
    return np.dtype("<f4" if kind == "float" else "<f8")


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The same for rows of one length."""
    rows = vectors.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """For each length of vectors the leading axes of a sample, as rows."""
    share = min(1.0, AXIS_ROWS / max(1, n))
    sample = classes.filter(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(share * 1_000_000)).select("embedding").limit(AXIS_ROWS)

    def gram(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for v in units(batch.column(0)):
                sums[len(v)] = sums.get(len(v), 0) + np.outer(v, v)
        for dim, total in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": [dim], "gram": [total.tobytes()]})

    axes: dict[int, np.ndarray] = {}
    for r in sample.mapInArrow(gram, "dim long, gram binary").collect():
        axes[r.dim] = axes.get(r.dim, 0) + np.frombuffer(r.gram).reshape(r.dim, r.dim)
    return {dim: np.linalg.eigh(total)[1][:, ::-1].T[:AXES].copy() for dim, total in axes.items()}


def placed(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Classes with their cells and coordinates along the axes; missing axes count as zero."""
    schema = pa.schema([("rep", pa.int64()), ("copies", pa.int64()), ("label", pa.int64()), ("dim", pa.int64()),
                        *((f"c{i}", pa.int64()) for i in range(AXES)), ("place", pa.binary()), ("vector", pa.binary())])
    kind = element(classes)

    def run(batches):
        for batch in batches:
            own = units(batch.column(3))
            flat, cuts = batch.column(3).values.to_numpy(zero_copy_only=False).astype(kind), batch.column(3).offsets.to_numpy()
            place = np.zeros((len(own), AXES))
            for i, v in enumerate(own):
                basis = axes.get(len(v))
                if basis is not None:
                    place[i, :len(basis)] = basis @ v
            cells = np.floor(place / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([len(v) for v in own], pa.int64()),
                 *(pa.array(cells[:, i]) for i in range(AXES)), pa.array([p.tobytes() for p in place], pa.binary()),
                 pa.array([flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], schema=schema)

    cells = ", ".join(f"c{i} long" for i in range(AXES))
    return classes.select("rep", "copies", "label", "embedding").mapInArrow(
        run, f"rep long, copies long, label long, dim long, {cells}, place binary, vector binary")


def cut(sequence: DataFrame) -> DataFrame:
    """Blocks of the ordered vectors, none of which spans two labels or lengths, with the box of each."""
    schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("dim", pa.int64()), ("low", pa.list_(pa.float64())),
                        ("high", pa.list_(pa.float64())), ("reps", pa.binary()), ("copies", pa.binary()),
                        ("places", pa.binary()), ("vectors", pa.binary())])

    def run(batches):
        part, made, held, key = TaskContext.get().partitionId(), 0, [], None

        def block():
            place = np.frombuffer(b"".join(h[2] for h in held)).reshape(-1, AXES)
            return pa.RecordBatch.from_pydict({
                "block": [part << 32 | made], "label": [key[0]], "dim": [key[1]], "low": [place.min(axis=0)], "high": [place.max(axis=0)],
                "reps": [np.array([h[0] for h in held], dtype=np.int64).tobytes()],
                "copies": [np.array([h[1] for h in held], dtype=np.int64).tobytes()],
                "places": [place.tobytes()], "vectors": [b"".join(h[3] for h in held)]}, schema=schema)

        for batch in batches:
            for rep, copies, label, dim, place, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((label, dim) != key or len(held) == BLOCK_ROWS):
                    yield block()
                    made, held = made + 1, []
                key = label, dim
                held.append((rep, copies, place, vector))
        if held:
            yield block()

    order = ["label", "dim", *(f"c{i}" for i in range(AXES)), "rep"]
    ordered = sequence.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("rep", "copies", "label", "dim", "place", "vector").mapInArrow(
        run, "block long, label long, dim long, low array<double>, high array<double>, reps binary, copies binary, "
             "places binary, vectors binary")


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """``(first, second)``: pairs of blocks, each with itself too, whose boxes are within ``eps``; boxes alone are shuffled."""
    boxes = blocks.select("block", "label", "dim", "low", "high")

    def cells(df: DataFrame, name: str, margin: int) -> DataFrame:
        def along(i):
            return F.explode(F.sequence(F.floor(F.col("low")[i] / eps) - margin, F.floor(F.col("high")[i] / eps) + margin))

        return df.withColumn("x", along(0)).withColumn("y", along(1)).select(
            "label", "dim", "x", "y", F.col("block").alias(name), F.col("low").alias(f"{name}_low"), F.col("high").alias(f"{name}_high"))

    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col("second_low")[i] - F.col("first_high")[i], F.col("first_low")[i] - F.col("second_high")[i]), 2)
               for i in range(AXES)), F.lit(0.0))
    return cells(boxes, "first", 0).join(cells(boxes, "second", 1), ["label", "dim", "x", "y"]).filter(
        (F.col("first") <= F.col("second")) & (gap <= eps * eps)).select("first", "second").distinct()


class Side:
    def __init__(self, kind: np.dtype, reps: bytes, copies: bytes, places: bytes, vectors: bytes):
        self.reps, self.copies = np.frombuffer(reps, dtype=np.int64), np.frombuffer(copies, dtype=np.int64)
        self.place = np.frombuffer(places).reshape(-1, AXES)
        self.unit = unit_rows(np.frombuffer(vectors, dtype=kind).reshape(len(self.reps), -1))


def join_sequences(a: Side, b: Side, same: bool, least: float, eps: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Positions of linked vectors in both sequences, by halving them; with ``same`` each pair once."""
    left, right, todo = [], [], [(0, len(a.reps), 0, len(b.reps))]
    while todo:
        i, j, k, m = todo.pop()
        if same and i > k:
            continue
        p, q = a.place[i:j], b.place[k:m]
        gap = np.maximum(0, np.maximum(q.min(axis=0) - p.max(axis=0), p.min(axis=0) - q.max(axis=0)))
        if gap @ gap > eps * eps:
            continue
        if max(j - i, m - k) > LEAF_ROWS:
            ij = [(i, (i + j) // 2), ((i + j) // 2, j)] if j - i > LEAF_ROWS else [(i, j)]
            km = [(k, (k + m) // 2), ((k + m) // 2, m)] if m - k > LEAF_ROWS else [(k, m)]
            todo += [(*x, *y) for x in ij for y in km]
            continue
        r, c = np.nonzero(a.unit[i:j] @ b.unit[k:m].T >= least)
        r, c = r + i, c + k
        if same:
            r, c = r[once := r < c], c[once]
        if len(r):
            left.append(r)
            right.append(c)
    return left, right


def forest(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Indices of links that together connect what all links connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    kept = []
    for at, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(at)
    return kept


def compared(pairs: DataFrame, blocks: DataFrame, kind: np.dtype, least: float, eps: float) -> DataFrame:
    """``(a, b, n)``: with ``b`` null the links of ``a`` in this pair of blocks, else a link of the pair's spanning forest."""
    data = ("reps", "copies", "places", "vectors")

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in data))

    full = pairs.join(side("first"), "first").join(side("second"), "second")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for first, second, *raw in zip(*(c.to_pylist() for c in batch.columns)):
                same = first == second
                a, b = Side(kind, *raw[:4]), Side(kind, *raw[4:])
                left, right = join_sequences(a, b, same, least, eps)
                if not left:
                    continue
                left, right = np.concatenate(left), np.concatenate(right)
                ends = np.concatenate((a.reps[left], b.reps[right]))
                reps, at = np.unique(ends, return_inverse=True)
                n = np.bincount(at, weights=np.concatenate((b.copies[right], a.copies[left])).astype(np.float64)).astype(np.int64)
                half = len(left)
                kept = forest(at[:half], at[half:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((reps, ends[:half][kept]))),
                     pa.concat_arrays([pa.nulls(len(reps), pa.int64()), pa.array(ends[half:][kept])]),
                     pa.array(np.concatenate((n, np.zeros(len(kept), dtype=np.int64))))], schema=schema)

    return full.select("first", "second", *(f"first_{c}" for c in data), *(f"second_{c}" for c in data)).mapInArrow(
        run, "a long, b long, n long")


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                least: float = LEAST_COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per distinct row of ``vectors``.

    Vectors are compared when their labels are equal and not null and their lengths are equal. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without an id, link with nothing: they have no links and
    are their own component. Wholly repeated rows count once. Ids and labels are integers; ``kept`` is false for a null
    id.
    """
    spark = prepare(vectors.sparkSession)
    eps = float(np.sqrt(2 - 2 * least)) * (1 + 1e-9) + 1e-9
    rows = vectors.select(column(id_col).cast("long").alias("vec_id"), column(label_col).cast("long").alias("label"),
                          column(vec_col).alias("embedding")).distinct()
    linkable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    classes = write_once(rows.filter(linkable).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    axes = principal_axes(classes, classes.count())
    blocks = write_once(cut(placed(classes, axes, eps)), "vector-blocks")
    with settings(spark, TOGETHER):
        found = write_once(compared(near_blocks(blocks, eps), blocks, element(classes), least, eps), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("outer_links"))
    groups = components(found.filter("b IS NOT NULL").select("a", "b"))
    named = classes.join(counts, "rep", "left").join(groups, F.col("rep") == F.col("id"), "left").select(
        "label", "embedding", (F.coalesce("outer_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"))
    linked = rows.filter(linkable).join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~linkable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
