"""Cleaning of hourly sensor series (panel form: every step keyed by station).

Order of the composed ``clean_series`` is fixed: hourly grid of the outer
merge -> trim leading missing target -> null outliers -> missing flags ->
capped linear interpolation -> forward fill -> leading fill.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast import config as C
from hourcast.config import KEY, TIME
from hourcast.operators.series import POS, block_hours, epoch_hour, hour_to_ntz, nearest_valid, with_pos

PARTITION_COLS = ("year", "month")


# --------------------------------------------------------------------------
# row-level steps
# --------------------------------------------------------------------------
def dedupe_hourly(readings: DataFrame, tie_break: str = "seq") -> DataFrame:
    """Keep the first reading per (station, hour); ``tie_break`` orders duplicates.

    An aggregate (``min_by``) rather than a window: duplicates are combined
    map-side, so even a station-hour holding a large share of all rows never
    lands whole in one task."""
    rest = [c for c in readings.columns if c not in (KEY, TIME)]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(tie_break)).alias("_r")
    return readings.groupBy(KEY, TIME).agg(first).select(KEY, TIME, *[F.col("_r")[c].alias(c) for c in rest])


def drop_partition_cols(df: DataFrame) -> DataFrame:
    """Drop lake partition columns (``year``, ``month``, ``year_*``, ``month_*``)."""
    drop = [c for c in df.columns if c in PARTITION_COLS or c.startswith("year_") or c.startswith("month_")]
    return df.drop(*drop)


def detect_time_column(df: DataFrame, candidates=("datetime", "date", "time")) -> DataFrame:
    """Rename the first present candidate to ``datetime`` as TIMESTAMP_NTZ."""
    for c in candidates:
        if c in df.columns:
            out = df.withColumn(c, F.to_timestamp_ntz(F.col(c).cast("string"))
                                if dict(df.dtypes)[c] == "string" else F.col(c).cast("timestamp_ntz"))
            return out.withColumnRenamed(c, TIME) if c != TIME else out
    raise ValueError(f"no time column among {candidates}")


def localize_time(df: DataFrame, col: str = TIME, source_tz: str | None = None,
                  target_tz: str = C.LOCAL_TZ) -> DataFrame:
    """Naive local time stays as is; an aware instant (TIMESTAMP) or a naive
    value in ``source_tz`` is converted to local wall-clock TIMESTAMP_NTZ."""
    dtype = dict(df.dtypes)[col]
    if dtype == "timestamp":
        return df.withColumn(col, F.convert_timezone(F.lit("UTC"), F.lit(target_tz),
                                                     F.to_utc_timestamp(F.col(col), df.sparkSession.conf.get(
                                                         "spark.sql.session.timeZone")).cast("timestamp_ntz")))
    if source_tz:
        return df.withColumn(col, F.convert_timezone(F.lit(source_tz), F.lit(target_tz), F.col(col)))
    return df


def null_outliers(df: DataFrame, cols=None, low: float = C.OUTLIER_LOW, high: float = C.OUTLIER_HIGH) -> DataFrame:
    """Values outside [low, high] -> NULL for the pollution columns present."""
    cols = cols or [c for c in C.POLLUTION_COLUMNS if c in df.columns]
    return df.select(*[F.when(F.col(c).between(low, high), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    skip = {POS, "_blk", "_core"}
    return [c for c, t in df.dtypes
            if c not in skip and c != KEY and t in ("double", "float", "int", "bigint", "smallint", "tinyint")
            and not c.endswith("_missing_flag")]


def missing_flags(df: DataFrame, cols=None) -> DataFrame:
    """``<c>_missing_flag`` (TINYINT 0/1) for every numeric column."""
    cols = cols or numeric_columns(df)
    return df.select("*", *[F.col(c).isNull().cast("tinyint").alias(f"{c}_missing_flag") for c in cols])


# --------------------------------------------------------------------------
# grid and merge
# --------------------------------------------------------------------------
OFFSET = "_offset"


def _with_offset(df: DataFrame) -> DataFrame:
    """Position (whole hours) and ``_offset`` (milliseconds past the hour) of each row's time."""
    ms = F.expr(f"minute({TIME}) * 60000 + cast(extract(SECOND FROM {TIME}) * 1000 as int)")
    return with_pos(df).withColumn(OFFSET, ms.cast("int"))


def _station_bounds(aq: DataFrame, weather: DataFrame | None, trim: bool) -> DataFrame:
    """Per station the grid's first and last position and its anchor: the offset of the first time of all."""
    at = F.struct(POS, OFFSET)
    rows = _with_offset(aq)
    b = rows.groupBy(KEY).agg(F.min(at).alias("_from"), F.max(at).alias("_to"))
    if weather is not None:
        # the shared weather range is a scalar subquery inside the plan
        w = _with_offset(weather)
        b = b.select(KEY, F.least("_from", w.agg(F.min(at)).scalar()).alias("_from"), F.greatest("_to", w.agg(F.max(at)).scalar()).alias("_to"))
    late = (F.col("_to")[OFFSET] < F.col("_from")[OFFSET]).cast("long")  # the last hour is not reached
    b = b.select(KEY, F.col("_from")[OFFSET].alias(OFFSET), F.col("_from")[POS].alias("_lo"), (F.col("_to")[POS] - late).alias("_hi"))
    if trim:
        known = rows.filter(F.col(C.TARGET).isNotNull()).join(b, [KEY, OFFSET]).groupBy(KEY).agg(F.min(POS).alias("_first"))
        b = b.join(known, KEY, "left").select(KEY, OFFSET, F.coalesce("_first", "_lo").alias("_lo"), "_hi")
    return b


def spine(bounds: DataFrame, block: int) -> DataFrame:
    """Every hour lo..hi per station, generated block by block so that no
    single row ever holds a station's whole history as one array."""
    blocks = bounds.select(KEY, OFFSET, "_lo", "_hi", F.explode(F.sequence(
        F.floor(F.col("_lo") / block), F.floor(F.col("_hi") / block))).alias("_b"))
    hours = blocks.select(KEY, OFFSET, F.explode(F.sequence(
        F.greatest(F.col("_lo"), F.col("_b") * block),
        F.least(F.col("_hi"), F.col("_b") * block + (block - 1)))).alias(POS))
    return hours.withColumn(TIME, hour_to_ntz(POS) + F.make_dt_interval(secs=F.col(OFFSET).cast("decimal(18,6)") / 1000))


def hourly_grid(aq: DataFrame, weather: DataFrame | None = None, trim: bool = False,
                block: int | None = None) -> DataFrame:
    """Gap-free hourly grid per station over min..max of (station times ∪
    weather times), anchored at the first of them; rows that are not a whole
    number of hours from it vanish, missing hours become NULL rows.
    This is the panel form of the full outer merge of AQ and weather."""
    block = block_hours(aq, block)
    sp = spine(_station_bounds(aq, weather, trim), block)
    out = sp.join(_with_offset(aq).drop(TIME), [KEY, POS, OFFSET], "left")
    if weather is not None:
        out = out.join(_with_offset(weather).drop(TIME), [POS, OFFSET], "left")
    rest = [c for c in out.columns if c not in (KEY, POS, TIME, OFFSET)]
    return out.select(KEY, POS, TIME, *rest)


def merge_outer(aq: DataFrame, weather: DataFrame, block: int | None = None) -> DataFrame:
    """Rows of the full outer merge on (station, datetime): each station's own
    hours plus every weather hour inside the station's grid, no filling."""
    block = block_hours(aq, block)
    sp = spine(_station_bounds(aq, weather, trim=False), block)
    a = _with_offset(aq).drop(TIME).withColumn("_in_aq", F.lit(True))
    w = _with_offset(weather).drop(TIME).withColumn("_in_w", F.lit(True))
    out = sp.join(a, [KEY, POS, OFFSET], "left").join(w, [POS, OFFSET], "left")
    rest = [c for c in out.columns if c not in (KEY, POS, TIME, OFFSET, "_in_aq", "_in_w")]
    return out.filter(F.col("_in_aq").isNotNull() | F.col("_in_w").isNotNull()).select(KEY, POS, TIME, *rest)


def trim_leading_missing(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Drop rows before the station's first non-null target (no-op if none)."""
    df = with_pos(df)
    first = df.groupBy(KEY).agg(F.min(F.when(F.col(target).isNotNull(), F.col(POS))).alias("_first"))
    return (df.join(first, KEY, "left")
              .filter(F.col("_first").isNull() | (F.col(POS) >= F.col("_first"))).drop("_first"))


# --------------------------------------------------------------------------
# fills
# --------------------------------------------------------------------------
def fill_capped(df: DataFrame, cols=None, limit: int = C.INTERPOLATION_LIMIT, block: int | None = None,
                causal: bool = False) -> DataFrame:
    """Capped linear interpolation + forward fill + leading fill in one pass.

    With previous valid (p, vp) and next valid (n, vn) at position i:
    both -> (vn-vp)/(n-p)·min(i-p, limit) + vp; only previous -> vp;
    only next -> vn; none -> 0.0.  ``causal=True`` never looks ahead
    (previous value carried, leading rows NULL -> 0.0 is not applied).
    """
    cols = cols or [c for c in numeric_columns(df)]
    block = block_hours(df, block)
    nv = nearest_valid(with_pos(df), cols, block)
    vals = {}
    for c in cols:
        pv, nx = F.col(f"_pv_{c}"), F.col(f"_nv_{c}")
        step = F.least(F.col(POS) - pv["p"], F.lit(limit)).cast("double")
        interp = (nx["v"] - pv["v"]) / (nx["p"] - pv["p"]).cast("double") * step + pv["v"]
        if causal:
            val = F.coalesce(F.col(c), pv["v"])
        else:
            val = (F.when(F.col(c).isNotNull(), F.col(c))
                   .when(pv.isNotNull() & nx.isNotNull(), interp)
                   .when(pv.isNotNull(), pv["v"])
                   .when(nx.isNotNull(), nx["v"])
                   .otherwise(F.lit(0.0)))
        vals[c] = val.cast("double").alias(c)
    tmp = {f"_{t}_{c}" for c in cols for t in ("pv", "nv")}
    return nv.select(*[vals.get(x, F.col(f"`{x}`")) for x in nv.columns if x not in tmp])


def interpolate_capped(df: DataFrame, cols=None, limit: int = C.INTERPOLATION_LIMIT,
                       block: int | None = None) -> DataFrame:
    """Linear interpolation of interior gaps, at most ``limit`` forward steps
    (later gap rows stay NULL; trailing gaps take the last value for ``limit`` rows)."""
    cols = cols or numeric_columns(df)
    block = block_hours(df, block)
    out = nearest_valid(with_pos(df), cols, block)
    for c in cols:
        pv, nx = F.col(f"_pv_{c}"), F.col(f"_nv_{c}")
        k = F.col(POS) - pv["p"]
        interp = (nx["v"] - pv["v"]) / (nx["p"] - pv["p"]).cast("double") * k.cast("double") + pv["v"]
        val = (F.when(F.col(c).isNotNull(), F.col(c))
               .when(pv.isNotNull() & (k <= limit), F.coalesce(interp, pv["v"])))
        out = out.withColumn(c, val).drop(f"_pv_{c}", f"_nv_{c}")
    return out


def forward_fill(df: DataFrame, cols=None, block: int | None = None) -> DataFrame:
    """Carry the last non-null value forward (leading NULLs stay)."""
    cols = cols or numeric_columns(df)
    block = block_hours(df, block)
    out = nearest_valid(with_pos(df), cols, block)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_pv_{c}")["v"])).drop(f"_pv_{c}", f"_nv_{c}")
    return out


def leading_fill(df: DataFrame, cols=None) -> DataFrame:
    """Fill NULLs with the station's first valid value (0.0 when none)."""
    cols = cols or numeric_columns(df)
    df = with_pos(df)
    firsts = df.groupBy(KEY).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_f_{c}")
                                   for c in cols])
    out = df.join(firsts, KEY, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_f_{c}"), F.lit(0.0))).drop(f"_f_{c}")
    return out


def clean_series(aq: DataFrame, weather: DataFrame | None = None, block: int | None = None,
                 causal: bool = False) -> DataFrame:
    """Composed cleaning: grid (trimmed) -> outliers -> flags -> fills.

    Output: station_id, datetime, _pos, 7 measures (no NULLs), 7 flags.
    """
    g = hourly_grid(drop_partition_cols(aq), None if weather is None else drop_partition_cols(weather),
                    trim=True, block=block)
    g = null_outliers(g)
    cols = numeric_columns(g)
    g = missing_flags(g, cols)
    return fill_capped(g, cols, block=block, causal=causal)


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """Per station and column: NULL count and share in percent (long form)."""
    cols = cols or numeric_columns(df)
    agg = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"),
                              *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr(KEY, "n_rows", f"stack({len(cols)}, {stack}) as (column_name, n_missing)")
    return long.withColumn("pct_missing", F.round(F.col("n_missing") * 100.0 / F.col("n_rows"), 6))
