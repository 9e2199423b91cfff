"""Reproducible route sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit.sources.tables import distinct_routes

SAMPLE_SIZE = 500
SAMPLE_SEED = 42


def sample_routes(routes: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """Seeded pick of ``size`` routes, the same for every partitioning of the input."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("route_id")))
    return distinct_routes(routes).orderBy(key, "route_id").limit(size)
