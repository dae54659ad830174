"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors of a label are one class. Classes are range-sorted by their leading principal coordinate and cut into
tiles; two tiles of a label meet unless their leading coordinates are too far apart for the threshold. In a pair of
tiles the leading principal coordinates are accumulated first; what the rest can add is bounded by the product of the
suffix norms, and pairs that cannot reach the threshold stop there. Those that can are measured on the original
vectors. A pair of tiles reports link counts and a spanning forest of its links, so output grows with the rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.components import connected_components, forest
from hourcast.llm.store import shuffle_partitions, table, written
from hourcast.llm.vectors import usable

TILE = 1024
STEPS = (8, 16, 32)
_SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the principal axes of the unit vectors, by falling variance (one small matrix each)."""

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for f in frames:
            for dim, g in f.groupby("dim"):
                x = unit(np.stack(g["embedding"]).astype(np.float64))
                sums[dim] = sums.get(dim, 0) + x.T @ x
        if sums:
            yield pd.DataFrame({"dim": list(sums), "m": [s.ravel() for s in sums.values()]})

    def added(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": f["dim"].iloc[:1].tolist(), "m": [np.sum(f["m"].tolist(), axis=0)]})

    rows = classes.select("dim", "embedding").mapInPandas(moments, "dim int, m array<double>").groupBy("dim").applyInPandas(added, "dim int, m array<double>")
    out = {}
    for r in rows.collect():
        values, axes = np.linalg.eigh(np.array(r["m"]).reshape(r["dim"], r["dim"]))
        out[r["dim"]] = axes[:, np.argsort(-values, kind="stable")]
    return out


def make_tiles(classes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """(tile, label, dim, low, high, reps, sizes, data): at most TILE classes each, near in the leading coordinate."""
    sent = classes.sparkSession.sparkContext.broadcast(axes)

    @F.pandas_udf("double")
    def lead(v: pd.Series) -> pd.Series:
        return v.map(lambda x: float(unit(np.asarray(x, np.float64)[None, :])[0] @ sent.value[len(x)][:, 0]))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: dict[tuple, pd.DataFrame] = {}
        n = 0
        for f in frames:
            for key, g in f.groupby(["label", "dim"], sort=True):
                g = pd.concat([rest.pop(key), g]) if key in rest else g
                while len(g) >= TILE:
                    n += 1
                    yield _tile(g.iloc[:TILE], n)
                    g = g.iloc[TILE:]
                if len(g):
                    rest[key] = g
        for g in rest.values():
            n += 1
            yield _tile(g, n)

    def _tile(g: pd.DataFrame, n: int) -> pd.DataFrame:
        data = np.stack(g["embedding"]).astype(np.float64)
        return pd.DataFrame({"tile": [(int(g["part"].iloc[0]) << 32) + n], "label": g["label"].iloc[:1].tolist(), "dim": g["dim"].iloc[:1].tolist(), "low": [g["lead"].min()], "high": [g["lead"].max()],
                             "reps": [g["rep"].to_numpy()], "sizes": [g["n"].to_numpy()], "data": [data.astype(np.float32).tobytes() if np.array_equal(data, data.astype(np.float32)) else data.tobytes()]})

    parts = shuffle_partitions(classes.sparkSession)
    rows = classes.withColumn("lead", lead("embedding")).repartitionByRange(parts, "label", "dim", "lead").sortWithinPartitions("label", "dim", "lead", "rep")
    return rows.withColumn("part", F.spark_partition_id()).mapInPandas(cut, "tile long, label long, dim int, low double, high double, reps array<long>, sizes array<long>, data binary")


def _matrix(blob: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.float32 if len(blob) == 4 * rows * dim else np.float64).reshape(rows, dim).astype(np.float64)


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of a and b with a cosine of ``threshold`` or more (i < j if both are the same tile)."""
    p, q = unit(a) @ axes, unit(b) @ axes
    dim = a.shape[1]
    done = 0
    total = np.zeros((len(a), len(b)))
    alive = None
    for upto in [s for s in STEPS if s < dim] + [dim]:
        rest = np.sqrt(np.maximum(0, (p[:, upto:] ** 2).sum(1)))[:, None] * np.sqrt(np.maximum(0, (q[:, upto:] ** 2).sum(1)))[None, :]
        if alive is None or len(alive[0]) > 0.2 * total.size:
            total += p[:, done:upto] @ q[:, done:upto].T
            hold = total + rest >= threshold - _SLACK
            if alive is not None:
                keep = np.zeros_like(hold)
                keep[alive] = True
                hold &= keep
            elif same:
                hold = np.triu(hold, 1)
            alive = np.nonzero(hold)
        else:
            i, j = alive
            total[i, j] += np.einsum("ij,ij->i", p[i, done:upto], q[j, done:upto])
            stay = total[i, j] + rest[i, j] >= threshold - _SLACK
            alive = i[stay], j[stay]
        done = upto
        if not len(alive[0]):
            return alive
    i, j = alive
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    cosine = np.empty(len(i))
    for k in range(0, len(i), 100_000):
        x, y = a[i[k:k + 100_000]], b[j[k:k + 100_000]]
        cosine[k:k + 100_000] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
    return i[cosine >= threshold], j[cosine >= threshold]


def compare_tiles(pairs: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(x, links, y): links of class x in a pair of tiles (y null), and the links (x, y) of a spanning forest."""
    sent = pairs.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {n: batch.column(n)[k] for n in batch.schema.names}
                reps_a, reps_b = (r[n].values.to_numpy(zero_copy_only=False) for n in ("reps_a", "reps_b"))
                sizes_a, sizes_b = (r[n].values.to_numpy(zero_copy_only=False) for n in ("sizes_a", "sizes_b"))
                dim, same = r["dim"].as_py(), r["a"].as_py() == r["b"].as_py()
                i, j = linked_pairs(_matrix(r["data_a"].as_buffer(), len(reps_a), dim), _matrix(r["data_b"].as_buffer(), len(reps_b), dim), sent.value[dim], threshold, same)
                if not len(i):
                    continue
                x = np.concatenate([reps_a[i], reps_b[j]])
                ids, at = np.unique(x, return_inverse=True)
                links = np.bincount(at, np.concatenate([sizes_b[j], sizes_a[i]]).astype(np.float64)).astype(np.int64)
                tree = forest(reps_a[i].tolist(), reps_b[j].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, [t[0] for t in tree]]).astype(np.int64)), pa.array(np.concatenate([links, np.zeros(len(tree))]).astype(np.int64)),
                                                  pa.array([None] * len(ids) + [t[1] for t in tree], pa.int64())], ["x", "links", "y"])

    return pairs.mapInArrow(run, "x long, links long, y long")


def near_embeddings(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label are read).

    Rows link when their labels are equal and not null and their cosine in double precision is at least ``threshold``.
    Vectors without vec_id, null, zero, or with null or non-finite components link with nothing, nor do vectors of
    different lengths. n_links counts linked rows, equal ones included; component_id is the smallest vec_id reachable
    by links; kept says whether it is the row's own.
    """
    marked = usable(vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label")).where("label is not null"))
    classes = marked.groupBy("label", "dim", "h1", "h2").agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"), F.first("embedding").alias("embedding"))
    classes = written(classes, "vector-classes")
    axes = principal_axes(classes)
    tiles = written(make_tiles(classes, axes), "vector-tiles")

    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _SLACK
    bounds = tiles.select("tile", "label", "dim", "low", "high")
    a, b = bounds.alias("a"), bounds.alias("b")
    meet = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.tile") <= F.col("b.tile"))
    meet &= (F.col("b.low") - F.col("a.high") <= reach) & (F.col("a.low") - F.col("b.high") <= reach)
    pairs = a.join(b, meet).select(F.col("a.tile").alias("a"), F.col("b.tile").alias("b"), "a.dim")
    full = tiles.select("tile", "reps", "sizes", "data")
    pairs = pairs.join(full.toDF("a", "reps_a", "sizes_a", "data_a"), "a").join(full.toDF("b", "reps_b", "sizes_b", "data_b"), "b")
    found = written(compare_tiles(pairs, axes, threshold), "vector-links")

    links = found.where("y is null").groupBy("x").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("y is not null"), "x", "y")
    placed = classes.join(links, F.col("rep") == F.col("x"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    placed = placed.select("label", "dim", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    rows = vectors.select(F.col("vec_id").alias("id"))
    known = marked.select("vec_id", "label", "dim", "h1", "h2").join(placed, ["label", "dim", "h1", "h2"]).select("vec_id", "n_links", "component")
    known = known.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    out = rows.join(known, F.col("id") == F.col("vec_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
