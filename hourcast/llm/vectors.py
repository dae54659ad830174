"""Vector rows shared by the embedding operators: which vectors take part, and classes of equal vectors."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with a vec_id and a vector that is not null, not zero and has finite components only, with their length
    ``dim`` and a 128-bit name (h1, h2) of the vector."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    return rows.withColumn("dim", F.size("embedding")).withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit("second"), "embedding"))
