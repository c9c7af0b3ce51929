"""The tables of all layers, each built from the ones below on first use."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stintlake.plans import gold, marts, silver
from stintlake.sources.adapters import bronze_from_tables
from stintlake.sources.writers import read_table

BRONZE = ("bronze_sessions", "bronze_drivers", "bronze_laps", "bronze_locations")
SILVER = ("silver_sessions", "silver_drivers", "silver_laps", "silver_locations")
DIMENSIONS = ("dim_sessions", "dim_drivers")
FACTS = ("fact_laps",)
MARTS = ("session_leaderboard", "driver_session_summary", "team_performance")


class Warehouse:
    """Lazy tables over bronze sources.

    A name is taken from ``sources`` if it is there (a written table, say) and is
    otherwise built from the layer below, so the same models serve ad-hoc runs
    and tables at rest.
    """

    def __init__(
        self, sources: dict[str, Callable[[], DataFrame]], run_ts: str | None = None
    ) -> None:
        self._sources = sources
        self.run_ts = run_ts

    @classmethod
    def over_tables(
        cls, spark: SparkSession, sf_dir: str, run_ts: str | None = None
    ) -> Warehouse:
        return cls(bronze_from_tables(spark, sf_dir), run_ts)

    @classmethod
    def at_path(cls, spark: SparkSession, path: str) -> Warehouse:
        """Tables written by :func:`stintlake.plans.build.build_all`."""
        names = (*BRONZE, *SILVER, *DIMENSIONS, *FACTS, *MARTS)
        return cls({n: (lambda n=n: read_table(spark, f"{path}/{n}")) for n in names})

    @classmethod
    def in_schema(cls, spark: SparkSession, schema: str) -> Warehouse:
        """The named tables of a schema; those it lacks are built from the others."""
        names = (*BRONZE, *SILVER, *DIMENSIONS, *FACTS, *MARTS)
        present = [n for n in names if spark.catalog.tableExists(f"{schema}.{n}")]
        return cls({n: (lambda n=n: spark.table(f"{schema}.{n}")) for n in present})

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._sources.get(name, build)()

    def _source(self, name: str) -> DataFrame:
        return self._sources[name]()

    @cached_property
    def bronze_sessions(self) -> DataFrame:
        return self._source("bronze_sessions")

    @cached_property
    def bronze_drivers(self) -> DataFrame:
        return self._source("bronze_drivers")

    @cached_property
    def bronze_laps(self) -> DataFrame:
        return self._source("bronze_laps")

    @cached_property
    def bronze_locations(self) -> DataFrame:
        return self._source("bronze_locations")

    @cached_property
    def event_sessions(self) -> DataFrame:
        return self._source("event_sessions")

    @cached_property
    def silver_sessions(self) -> DataFrame:
        return self._get(
            "silver_sessions",
            lambda: silver.build_silver_sessions(self.bronze_sessions, self.run_ts),
        )

    @cached_property
    def silver_drivers(self) -> DataFrame:
        return self._get(
            "silver_drivers", lambda: silver.build_silver_drivers(self.bronze_drivers, self.run_ts)
        )

    @cached_property
    def silver_laps(self) -> DataFrame:
        return self._get(
            "silver_laps", lambda: silver.build_silver_laps(self.bronze_laps, self.run_ts)
        )

    @cached_property
    def silver_locations(self) -> DataFrame:
        return self._get(
            "silver_locations",
            lambda: silver.build_silver_locations(self.bronze_locations, self.run_ts),
        )

    @cached_property
    def dim_sessions(self) -> DataFrame:
        return self._get("dim_sessions", lambda: gold.build_dim_sessions(self.silver_sessions))

    @cached_property
    def dim_drivers(self) -> DataFrame:
        return self._get("dim_drivers", lambda: gold.build_dim_drivers(self.silver_drivers))

    @cached_property
    def fact_laps(self) -> DataFrame:
        return self._get("fact_laps", lambda: gold.build_fact_laps(self.silver_laps))

    @cached_property
    def driver_session_summary(self) -> DataFrame:
        return self._get(
            "driver_session_summary",
            lambda: marts.build_driver_session_summary(
                self.fact_laps, self.dim_sessions, self.dim_drivers, self.run_ts
            ),
        )

    @cached_property
    def session_leaderboard(self) -> DataFrame:
        return self._get(
            "session_leaderboard",
            lambda: marts.build_session_leaderboard(
                self.fact_laps, self.dim_sessions, self.dim_drivers, self.run_ts
            ),
        )

    @cached_property
    def team_performance(self) -> DataFrame:
        return self._get(
            "team_performance",
            lambda: marts.build_team_performance(self.driver_session_summary, self.run_ts),
        )
