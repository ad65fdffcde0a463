"""The given tables as a small warehouse: feed, dimensions, silver, gold.

Dimensions, silver and gold are stored tables in this product, so what reads them gets a
stored table here too: each is built once per session and data folder, in the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.operators.gold import build_features
from headway.operators.silver import build_silver
from headway.session import stage, use_utc
from headway.sources import adapters

# The generated month holds few rows per prior cell, so cells of three rows count.
MIN_CELL = 3

_built: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = stage(build(), name)
    return _built[key]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        use_utc(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def trip_updates(self) -> DataFrame:
        return adapters.trip_updates(self.spark, self.sf_dir)

    def vehicle_positions(self) -> DataFrame:
        return adapters.vehicle_positions(self.spark, self.sf_dir)

    def dims(self) -> dict[str, DataFrame]:
        """Stored like refreshed static files, so that joins are planned on their real size."""
        makers = (adapters.stop_times, adapters.stops, adapters.trips, adapters.routes)
        return {
            make.__name__: _once(
                self.spark, self.sf_dir, make.__name__, lambda: make(self.spark, self.sf_dir)
            )
            for make in makers
        }

    def weather(self) -> DataFrame:
        return adapters.weather(self.spark, self.sf_dir)

    def cost_items(self) -> DataFrame:
        return adapters.cost_items(self.spark, self.sf_dir)

    def fresh_silver(self) -> DataFrame:
        """Silver as a plan over the feed, not the stored table."""
        return build_silver(self.trip_updates(), **self.dims())

    def silver(self) -> DataFrame:
        return _once(self.spark, self.sf_dir, "silver", self.fresh_silver)

    def fresh_gold(self) -> DataFrame:
        return build_features(
            self.silver(), None, self.weather(), min_count=MIN_CELL, exact=True
        )

    def gold(self) -> DataFrame:
        return _once(self.spark, self.sf_dir, "gold", self.fresh_gold)

    def predictions(self) -> DataFrame:
        return adapters.predictions(self.silver())
