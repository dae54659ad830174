"""Partitioning of hourly series for window functions at scale.

Every window in the engine is keyed by station.  A single station may hold a
large share of all rows, so windows are never partitioned by station alone:
rows are cut into fixed *blocks* of ``block_hours`` consecutive hours
(``blk = floor(epoch_hour / block_hours)``) and each block carries a *halo* —
copies of the neighbouring rows that bounded frames (lags, rolling windows,
leads) reach into.  Windows then run over ``(station_id, blk)`` and only the
block's own (``_core``) rows are kept.  Unbounded look-ups (last/first valid
value) are done in two steps: inside the block, then over a small per-block
summary table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.config import KEY, TIME
from hourcast.session import conf_int

BLOCK_CONF = "hourcast.series.blockHours"
DEFAULT_BLOCK_HOURS = 8192
POS = "_pos"
BLK = "_blk"
CORE = "_core"


def block_hours(df: DataFrame, override: int | None = None) -> int:
    if override:
        return int(override)
    return conf_int(df.sparkSession, BLOCK_CONF, DEFAULT_BLOCK_HOURS)


EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_hour(c: str = TIME) -> Column:
    """Whole hours since the epoch of a TIMESTAMP_NTZ wall-clock value, from
    its calendar fields only (independent of the session time zone)."""
    col = F.col(c)
    return (F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("long") * 24
            + F.hour(col)).cast("long")


def hour_to_ntz(pos) -> Column:
    """Inverse of ``epoch_hour``: epoch hour -> TIMESTAMP_NTZ (pure wall-clock arithmetic)."""
    p = F.col(pos) if isinstance(pos, str) else pos
    days = F.floor(p / 24).cast("int")
    hours = (p - F.floor(p / 24) * 24).cast("int")
    return (F.lit(EPOCH_NTZ).cast("timestamp_ntz")
            + F.make_dt_interval(days=days, hours=hours))


def with_pos(df: DataFrame, time_col: str = TIME) -> DataFrame:
    return df if POS in df.columns else df.withColumn(POS, epoch_hour(time_col))


def with_halo(df: DataFrame, back: int, fwd: int, block: int) -> DataFrame:
    """Assign each row to its block and copy it into neighbour blocks' halos.

    A row at position p of block b is also needed by blocks b+1..b+ceil(back/B)
    (as history) and b-1..b-ceil(fwd/B) (as future).  ``_core`` marks the copy
    that belongs to its own block.
    """
    df = with_pos(df)
    b = F.floor(F.col(POS) / F.lit(block)).cast("long")
    reach_back = -(-back // block) if back > 0 else 0
    reach_fwd = -(-fwd // block) if fwd > 0 else 0
    cands = [F.struct(b.alias("b"), F.lit(True).alias("c"))]
    for j in range(1, reach_back + 1):
        # copy into block b+j when that block's first row minus `back` reaches p
        cands.append(F.when((b + j) * block - back <= F.col(POS),
                            F.struct((b + j).alias("b"), F.lit(False).alias("c"))))
    for j in range(1, reach_fwd + 1):
        cands.append(F.when((b - j + 1) * block - 1 + fwd >= F.col(POS),
                            F.struct((b - j).alias("b"), F.lit(False).alias("c"))))
    tgt = F.explode(F.filter(F.array(*cands), lambda s: s.isNotNull())).alias("_t")
    return (df.select("*", tgt)
              .withColumn(BLK, F.col("_t.b")).withColumn(CORE, F.col("_t.c")).drop("_t"))


def series_keys(df: DataFrame) -> list[str]:
    """A series is a station, or a (station, mode, horizon) target series."""
    return [KEY] + [c for c in ("mode", "horizon") if c in df.columns]


def block_window(keys=None, order: str = POS) -> Window:
    return Window.partitionBy(*(keys or [KEY]), BLK).orderBy(order)


def core_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORE)).drop(CORE, BLK)


def nearest_valid(df: DataFrame, cols: list[str], block: int) -> DataFrame:
    """For each column c add ``_pv_c`` / ``_nv_c``: struct(pos, value) of the last
    non-null value at or before the row and the first at or after it, over the
    whole station history, without an unbounded per-station window.
    """
    df = with_pos(df)
    df = df.withColumn(BLK, F.floor(F.col(POS) / F.lit(block)).cast("long"))
    w = Window.partitionBy(KEY, BLK).orderBy(POS)
    w_back = w.rowsBetween(Window.unboundedPreceding, 0)
    w_fwd = w.rowsBetween(0, Window.unboundedFollowing)

    def sv(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(c).alias("v")))

    local = df.select("*", *[F.last(sv(c), ignorenulls=True).over(w_back).alias(f"_lp_{c}") for c in cols],
                      *[F.first(sv(c), ignorenulls=True).over(w_fwd).alias(f"_ln_{c}") for c in cols])
    # per-block summary: last / first valid (pos, value) in the block
    summ = df.groupBy(KEY, BLK).agg(
        *[F.max_by(sv(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_bl_{c}") for c in cols],
        *[F.min_by(sv(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_bf_{c}") for c in cols])
    wb = Window.partitionBy(KEY).orderBy(BLK)
    carry = summ.select(
        KEY, BLK,
        *[F.last(f"_bl_{c}", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cp_{c}")
          for c in cols],
        *[F.first(f"_bf_{c}", ignorenulls=True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias(f"_cn_{c}")
          for c in cols])
    out = local.join(carry, [KEY, BLK], "left")
    fills = []
    for c in cols:
        fills += [F.coalesce(F.col(f"_lp_{c}"), F.col(f"_cp_{c}")).alias(f"_pv_{c}"),
                  F.coalesce(F.col(f"_ln_{c}"), F.col(f"_cn_{c}")).alias(f"_nv_{c}")]
    tmp = {f"_{t}_{c}" for c in cols for t in ("lp", "cp", "ln", "cn")}
    out = out.select(*[F.col(f"`{x}`") for x in out.columns if x not in tmp], *fills)
    return out.drop(BLK)


def value_counts(df: DataFrame, col: str, keys: list[str], bins: int = 256) -> DataFrame:
    """(keys..., _v, _cnt, _before, _n): every distinct value of a group with its
    count, the number of smaller rows, and the group's rows.  Equal values are
    combined map-side, so a value that fills a third of a group is one row; the
    distinct values are cut into bins by approximate quantiles, so no group is
    sorted in one task."""
    vc = df.groupBy(*keys, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    edges = vc.groupBy(*keys).agg(F.percentile_approx("_v", [i / bins for i in range(1, bins)], 10 * bins).alias("_e"))
    vc = vc.join(edges, keys).withColumn("_b", F.size(F.filter("_e", lambda e: e < F.col("_v")))).drop("_e")
    per_bin = vc.groupBy(*keys, "_b").agg(F.sum("_cnt").alias("_bn"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.select(*keys, "_b", F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_off"),
                             F.sum("_bn").over(Window.partitionBy(*keys)).alias("_n"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    vc = vc.withColumn("_in", F.coalesce(F.sum("_cnt").over(inside), F.lit(0))).join(per_bin, [*keys, "_b"])
    return vc.select(*keys, "_v", "_cnt", (F.col("_off") + F.col("_in")).alias("_before"), "_n")


def exact_quantiles(df: DataFrame, col: str, keys: list[str], probs: list[float], bins: int = 256,
                    name: str = "q") -> DataFrame:
    """Exact linear-interpolated quantiles (numpy 'linear', Spark ``percentile``)
    per key from the counts of distinct values: only the values that hold the
    wanted order statistics go on.  Returns (keys..., ``name``: array<double> in
    the order of ``probs``)."""
    keys = list(keys)
    d = df.select(*keys, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    vc = value_counts(d, "_x", keys, bins)
    # 0-based order statistics floor and ceil of (n-1)p for every p
    pos = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    want = F.array(*[F.struct(F.lit(i).alias("i"), p.alias("p"), F.floor(p).alias("lo"), F.ceil(p).alias("hi")) for i, p in enumerate(pos)])

    def held(k):
        return (k >= F.col("_before")) & (k < F.col("_before") + F.col("_cnt"))

    hits = vc.select(*keys, "_v", "_before", "_cnt", F.explode(F.filter(want, lambda w: held(w["lo"]) | held(w["hi"]))).alias("w"))
    per = hits.groupBy(*keys, "w").agg(F.max(F.when(held(F.col("w.lo")), F.col("_v"))).alias("_vlo"),
                                       F.max(F.when(held(F.col("w.hi")), F.col("_v"))).alias("_vhi"))
    val = F.when(F.col("w.hi") == F.col("w.lo"), F.col("_vlo")).otherwise(
        (F.col("w.hi") - F.col("w.p")) * F.col("_vlo") + (F.col("w.p") - F.col("w.lo")) * F.col("_vhi"))
    out = per.select(*keys, F.struct(F.col("w.i").alias("i"), val.alias("q")).alias("_s"))
    return out.groupBy(*keys).agg(F.array_sort(F.collect_list("_s")).alias("_s")).select(
        *keys, F.transform("_s", lambda s: s["q"]).alias(name))
