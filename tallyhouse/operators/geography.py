"""Geography dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import surrogate_key
from ..schemas import GEOGRAPHY_ATTRIBUTES


def build_dim_geography(silver: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """One row per country of the lines; attributes come from an optional table keyed by
    `country`, and are NULL where it has none."""
    countries = silver.where(F.col("country").isNotNull()).select("country").distinct()
    if attributes is not None:
        countries = countries.join(attributes, "country", "left")
    given = set(countries.columns)
    return countries.select(
        surrogate_key("country").alias("geography_key"),
        "country",
        *[
            (F.col(name) if name in given else F.lit(None)).cast(kind).alias(name)
            for name, kind in GEOGRAPHY_ATTRIBUTES
        ],
    )
