"""Insights of a stored fact from roll-ups kept for each of its periods.

A load touches the files of a few periods. The roll-ups of a period say which files they were made of, so a report
reads the lines of periods whose files have changed since, and the roll-ups of the others. These merge exactly: days, and
with them invoice rows, belong to one period, revenue is a decimal, and invoices and customers are kept as keys.

The roll-ups are a table with versions, like the fact: reports may run beside each other and beside loads.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.plans.insights import HOME_MARKET, day_rollup, insights_of_rollups, invoice_rollup, product_rollup
from basketry.session import delete_path, input_bytes, list_names, move_path
from basketry.sources import snapshots
from basketry.sources.fact_table import PERIOD, PERIOD_FORMATS, period_of, read_files, stored_files
from basketry.sources.snapshots import Change, StoredFile

_REVENUE = T.StructField("revenue_eur", T.DecimalType(38, 4))
_INVOICE_DAY = T.StructField("invoice_date", T.TimestampType())
_COUNTRY = T.StructField("country", T.StringType())

INVOICES, PRODUCTS, DAYS = "invoices", "products", "days"
_SCHEMAS = {
    INVOICES: T.StructType(
        [T.StructField("invoice_no", T.StringType()), T.StructField("customer_id", T.StringType()), _COUNTRY,
         _INVOICE_DAY, _REVENUE, T.StructField("lines", T.LongType())]
    ),
    PRODUCTS: T.StructType(
        [T.StructField("stock_code", T.StringType()), T.StructField("description", T.StringType()), _REVENUE]
    ),
    DAYS: T.StructType([_INVOICE_DAY, _COUNTRY, _REVENUE]),
}
# How often a report begins anew because another one was first with the same periods.
_ATTEMPTS = 20


@dataclass(frozen=True)
class Rollups:
    """The roll-ups of one version of the fact, and which periods had to be worked out for it."""

    invoices: DataFrame
    products: DataFrame
    days: DataFrame
    renewed: tuple[str, ...]

    def insights(self, home: str = HOME_MARKET) -> dict[str, DataFrame]:
        return insights_of_rollups(self.invoices, self.days, self.products, home)


def _made_of(listed: list[StoredFile]) -> dict[str, str]:
    """What tells the files of each period from any others; files never change."""
    names: dict[str, list[str]] = {}
    for f in listed:
        names.setdefault(f.period, []).append(f.file)
    return {p: hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:32] for p, found in names.items()}


def _folder_of(kind: str, period: str, files: str) -> str:
    return f"{kind}/{PERIOD}={period}/files={files}"


def _kind(stored: StoredFile) -> str:
    return stored.file.split("/")[0]


def _write(
    spark: SparkSession, state: str, lines: DataFrame, grain: str, made_of: dict[str, str]
) -> list[StoredFile]:
    """The roll-ups of some periods as new folders, which belong to no version yet. One job a kind, however many periods."""
    build = uuid.uuid4().hex
    incoming = f"{state}/_incoming/{build}"

    def write(rollup: DataFrame, kind: str) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in _SCHEMAS[kind]]
        rows = rollup.select(*columns, PERIOD).hint("rebalance", PERIOD)
        rows.write.partitionBy(PERIOD).parquet(f"{incoming}/{kind}")

    by_period = period_of(grain)
    write(invoice_rollup(lines).withColumn(PERIOD, by_period), INVOICES)
    # The smallest roll-up comes from the largest, not from the lines.
    invoices = spark.read.schema(_SCHEMAS[INVOICES]).parquet(f"{incoming}/{INVOICES}")
    write(day_rollup(invoices).withColumn(PERIOD, by_period), DAYS)
    write(product_rollup(lines.withColumn(PERIOD, by_period), PERIOD), PRODUCTS)

    added = []
    for kind in _SCHEMAS:
        for name in list_names(spark, f"{incoming}/{kind}"):
            if not name.startswith(f"{PERIOD}="):
                continue
            period = name.split("=", 1)[1]
            target = f"{_folder_of(kind, period, made_of[period])}/build={build}"
            size = input_bytes(spark, [f"{incoming}/{kind}/{name}"])
            move_path(spark, f"{incoming}/{kind}/{name}", f"{state}/{target}")
            added.append(StoredFile(target, period, 0, size, 0, 0))
    delete_path(spark, incoming)
    return added


def rollups(spark: SparkSession, fact: str, state: str) -> Rollups:
    """The roll-ups of the newest version of a stored fact, kept in the folder ``state``.

    Periods whose files are not those their roll-ups were made of are worked out anew, in one job for each kind of
    roll-up; periods the fact no longer has go. A crash leaves folders that belong to no version. If another report was first
    with one of the periods, this one begins anew, with the fact as it then is. Files that were only put together count as
    changed: their period is read once more. An empty fact gives empty roll-ups.
    """
    state = state.rstrip("/")
    for _ in range(_ATTEMPTS):
        listed = stored_files(spark, fact)
        made_of = _made_of(listed)
        base = snapshots.current(spark, state)
        kept = snapshots.files(spark, state, base)
        # A period of lines without products has no roll-up of these; that of its invoices stands for all three.
        good = {f.period for f in kept if _kind(f) == INVOICES and f"/files={made_of.get(f.period)}/" in f.file}
        stale = sorted(set(made_of) - good)
        old = [f for f in kept if f.period not in good]
        view = [f for f in kept if f.period in good]
        if not stale and not old:
            return _view(spark, state, view, ())
        added = []
        if stale:
            grain = next(g for g, form in PERIOD_FORMATS.items() if len(form) == len(stale[0]))
            lines = read_files(spark, fact, [f for f in listed if f.period in set(stale)])
            added = _write(spark, state, lines, grain, made_of)
        change = Change(added, [f.file for f in old], frozenset(stale) | {f.period for f in old})
        if snapshots.commit(spark, state, base, change):
            # Not the files of the version: others may have committed periods of a newer fact to it.
            return _view(spark, state, view + added, tuple(stale))
        snapshots.discard(spark, state, change)
    raise RuntimeError(f"other reports were first with the same periods of {state} {_ATTEMPTS} times")


def _view(spark: SparkSession, state: str, stored: list[StoredFile], renewed: tuple[str, ...]) -> Rollups:
    def read(kind: str) -> DataFrame:
        paths = [f"{state}/{f.file}" for f in stored if _kind(f) == kind]
        schema = _SCHEMAS[kind]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    return Rollups(read(INVOICES), read(PRODUCTS), read(DAYS), renewed)
