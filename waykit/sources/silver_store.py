"""The five silver tables as one value: from documents, from storage, to storage.

Storage holds the travel table a second time as bucketed matrix blocks, which scoring and packing read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from waykit import schemas
from waykit.operators import silver
from waykit.sources import keyed_json, tables
from waykit.sources.travel_blocks import TravelBlocks, load_blocks, write_blocks


@dataclass(frozen=True)
class Silver:
    """The five silver tables."""

    routes: DataFrame
    stops: DataFrame
    packages: DataFrame
    sequences: DataFrame
    travel: DataFrame
    blocks: TravelBlocks | None = None

    @property
    def times(self) -> DataFrame | TravelBlocks:
        """Where to look travel times up: the blocks if there are any, else the edges."""
        return self.blocks or self.travel

    def semi(self, ids: DataFrame) -> "Silver":
        """All five tables cut down to the given route ids, which are broadcast only if few."""
        keep = tables.broadcast_if_small(ids.select("route_id").distinct())
        return Silver(
            *(
                getattr(self, f).join(keep, "route_id", "left_semi")
                for f in ("routes", "stops", "packages", "sequences", "travel")
            ),
            blocks=self.blocks and self.blocks.semi(keep),
        )


def silver_from_documents(docs: dict[str, DataFrame]) -> Silver:
    """Flatten the frames of ``keyed_json.read_bronze``."""
    return Silver(
        routes=silver.dim_routes(docs["routes"]),
        stops=silver.fact_stops(docs["routes"]),
        packages=silver.dim_packages(docs["packages"]),
        sequences=silver.fact_actual_sequences(docs["sequences"]),
        travel=silver.fact_travel_times(docs["travel"]),
    )


def write_documents(docs: dict[str, DataFrame], root: str) -> None:
    """The silver tables of ``keyed_json.read_bronze``, and beside them the records that cannot be read."""
    write_silver(silver_from_documents(docs), root)
    tables.write_overwrite(keyed_json.rejected_documents(docs), f"{root}/rejected_documents")


def write_silver(silver: Silver, root: str) -> None:
    for name in ("routes", "stops", "packages", "sequences", "travel"):
        tables.write_overwrite(getattr(silver, name), f"{root}/{name}")
    spark = silver.travel.sparkSession
    write_blocks(spark.read.schema(schemas.FACT_TRAVEL_TIMES).parquet(f"{root}/travel"), f"{root}/travel_blocks")


def load_silver(spark: SparkSession, root: str) -> Silver:
    def scan(name: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    return Silver(
        routes=scan("routes", schemas.DIM_ROUTES),
        stops=scan("stops", schemas.FACT_STOPS),
        packages=scan("packages", schemas.DIM_PACKAGES),
        sequences=scan("sequences", schemas.FACT_ACTUAL_SEQUENCES),
        travel=scan("travel", schemas.FACT_TRAVEL_TIMES),
        blocks=load_blocks(spark, f"{root}/travel_blocks"),
    )
