"""Named queries: a Spark implementation and, where SQL can say it, an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirflow.session import prepare

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one directory: ``t.orders`` is a DataFrame."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a key, with its SQL where one exists."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Tables(prepare(spark), directory))

        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return wrap


def load_catalog() -> None:
    """Import every catalog module, which registers its queries."""
    import importlib
    import pkgutil

    import weirflow.catalog as catalog

    for module in pkgutil.iter_modules(catalog.__path__):
        importlib.import_module(f"weirflow.catalog.{module.name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_catalog()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    load_catalog()
    return dict(_ORACLES)
