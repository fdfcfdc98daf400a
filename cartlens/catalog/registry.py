"""Named queries over the supplied tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens import session
from cartlens.catalog.base_sql import with_tables
from cartlens.plans import factored, wide
from cartlens.plans.features import CustomerFacts
from cartlens.sources import testdata


class Data:
    """The commerce tables of one folder and the frames most queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = session.configure(spark)
        self.folder = folder
        self.tables = testdata.load(spark, folder)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def raw(self, name: str) -> DataFrame:
        return self.tables.raw(name)

    @cached_property
    def wide(self) -> DataFrame:
        return wide.build_wide(self.tables, drop=False)

    @cached_property
    def raw_wide(self) -> DataFrame:
        return wide.raw_wide(self.tables)

    @cached_property
    def view(self) -> DataFrame:
        return wide.dashboard_view(self.wide, testdata.MONTH_CUTOFF)

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        return wide.cleaned_tables(self.tables, drop=False)

    @cached_property
    def facts(self) -> CustomerFacts:
        return CustomerFacts(self.wide, factored.order_facts(self.cleaned), self.cleaned)

    def counted_view(self, *order: str, **wanted) -> DataFrame:
        """Counted rows of the view: the same figures, without the rows of the wide join."""
        return factored.counted_rows(factored.dashboard_tables(self.tables, testdata.MONTH_CUTOFF), order, **wanted)

    def counted_wide(self, *order: str, **wanted) -> DataFrame:
        return factored.counted_rows(self.cleaned, order, **wanted)

    def counted_raw(self, *order: str, **wanted) -> DataFrame:
        return factored.counted_rows(wide.raw_tables(self.tables), order, **wanted)


FUNCTIONS: dict[str, Callable[[Data], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(Data) -> DataFrame; sql is the body of the checking query."""

    def register(fn: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        FUNCTIONS[name] = fn
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int | Mapping[str, int], *columns: str) -> DataFrame:
    """Round double columns; engines add doubles in different orders."""
    places = digits if isinstance(digits, Mapping) else {c: digits for c in columns}
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in places.items()})


def text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that both engines print the same."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})
