"""Filter of a shared-patient graph by a set of providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_docgraph(
    graph: DataFrame,
    keys: DataFrame,
    key_col: str = "distinct_npi",
    mode: str = "either",
    patient_floor: int = 50,
) -> DataFrame:
    """Edges with one end (``either``) or both ends (``both``) in the key set and enough patients.

    One pass over the edges: the patient floor is applied in the scan, then each end is looked up
    in the distinct key set. Spark broadcasts the set when its measured size allows; a larger set is
    joined by shuffle, where adaptive execution splits the partitions of a provider that is on very
    many edges. The key side has one row per key, so such a split repeats one row only.
    """
    if mode not in ("either", "both"):
        raise ValueError(mode)
    wanted = keys.where(F.col(key_col).isNotNull()).select(F.col(key_col).cast("bigint").alias("k")).distinct()
    kept = graph.where(F.col("patient_count") >= patient_floor)
    for end in ("from_npi", "to_npi"):
        hit = wanted.select(F.col("k").alias(end), F.lit(True).alias(f"_{end}"))
        kept = kept.join(hit, end, "left_semi" if mode == "both" else "left")
    if mode == "either":
        kept = kept.where(F.coalesce("_from_npi", "_to_npi"))
    return kept.select(*graph.columns)
