"""The lakehouse over one folder of given tables: what is landed, and where."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.domain import INVENTORY, KEYS
from tidemark.functions.envelope import MONTH, envelope, with_month
from tidemark.operators.state import stage
from tidemark.session import configure, scratch, tidy
from tidemark.sources import changelog
from tidemark.sources.log import read_log, write_log

_OPEN: dict[tuple[str, str], Lake] = {}


def write_bronze(bronze: DataFrame, path: str) -> None:
    """Bronze by commit month: rows of a month come together for few files, a full month is split."""
    with tidy(bronze.sparkSession):
        with_month(bronze).hint("rebalance", MONTH).write.option("compression", "zstd").partitionBy(MONTH).parquet(path)


class Lake:
    """Lands each topic's log and bronze table once; everything above stays lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder
        self.root = scratch(spark, "lake")
        self.prefix = f"tidemark_{self.root[-8:]}_"
        self._lines: DataFrame | None = None
        self._landed: set[str] = set()
        self._bronze: dict[str, str] = {}
        self._staged: dict[str, str] = {}
        self.built: dict[str, DataFrame] | None = None

    def _derive(self, topic: str) -> DataFrame:
        if topic in ("order_items", INVENTORY):
            if self._lines is None:
                self._lines = changelog.numbered_lines(self.spark, self.folder)
            build = changelog.order_items_log if topic == "order_items" else changelog.inventory_log
            return build(self._lines)
        return getattr(changelog, f"{topic}_log")(self.spark, self.folder)

    def log_path(self, *topics: str) -> str:
        """The log folder, with the topics asked for landed in it."""
        path = f"{self.root}/log"
        for topic in topics:
            if topic not in self._landed:
                write_log(self._derive(topic), path, ranged=True)
                self._landed.add(topic)
        return path

    def log(self, topic: str) -> DataFrame:
        return read_log(self.spark, self.log_path(topic), [topic])

    def bronze(self, entity: str) -> DataFrame:
        if entity not in self._bronze:
            path = f"{self.root}/bronze/{entity}"
            write_bronze(envelope(self.log(entity), KEYS[entity]), path)
            self._bronze[entity] = path
        return self.spark.read.parquet(self._bronze[entity])

    def stage(self, entity: str, *fields: str) -> DataFrame:
        """The staging plan over bronze."""
        return stage(self.bronze(entity), entity, *fields)

    def staged(self, entity: str) -> DataFrame:
        """Staging as a table, written once. Silver and gold join these: a join directly on a
        staging plan takes over the partitioning of its ranking, and without a shuffle of its
        own on each side the rows of a hot key could not be split."""
        if entity not in self._staged:
            path = f"{self.root}/staging/{entity}"
            with tidy(self.spark):
                self.stage(entity).write.option("compression", "zstd").parquet(path)
            self._staged[entity] = path
        return self.spark.read.parquet(self._staged[entity])


def lake(spark: SparkSession, folder: str) -> Lake:
    """The session's lake over ``folder``, opened on first use."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Lake(spark, folder)
    configure(spark)
    return _OPEN[key]
