"""Continuous load of sales files as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketry.operators.contracts import check_unique_countries
from basketry.operators.enrich import data_bytes, normalize_countries
from basketry.plans.runs import Converted, convert, stage_sales
from basketry.schemas import FACT
from basketry.session import delete_path, run_scratch, scratch_path, stage
from basketry.sources.fact_table import upsert_into
from basketry.sources.sales import read_sales_parquet


def load_stream(
    spark: SparkSession,
    sales: DataFrame,
    countries: DataFrame,
    fx: DataFrame,
    fact_path: str,
    checkpoint: str,
    grain: str = "month",
    once: bool = True,
    on_loaded: Callable[[int, Converted, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Transform and upsert every micro-batch of a sales stream.

    Each micro-batch is held to the contracts of a batch run before it is loaded: one that breaks them stops the
    query, and the fact stays as it was. ``on_loaded`` gets the number of each micro-batch with lines, what was
    converted (with its quality report and metrics) and the counts of the upsert; a micro-batch that runs again after a failure is
    reported again.

    Such a micro-batch upserts the same keys, so the fact holds each of them once, and a line that comes again
    in a later one changes nothing. Which files are new is the checkpoint's business; the high-water mark
    filter belongs to the batch runs only. What a micro-batch stages goes once it is loaded, its lines once they are converted. ``once`` stops when all landed files are loaded.
    """

    def load(lines: DataFrame, batch_id: int) -> None:
        session = lines.sparkSession
        with run_scratch(session, f"stream-{batch_id}"):
            path = scratch_path(session, "sales")
            counters = stage_sales(lines, path)
            if not counters["rows_in"]:
                return
            rates = stage(fx, "rates")  # as of now; read several times
            converted = convert(read_sales_parquet(session, path), counters, countries, rates, size)
            delete_path(session, path)
            fact = session.read.schema(FACT).parquet(converted.fact)
            counts = upsert_into(session, fact_path, fact, grain)
            if on_loaded:
                on_loaded(batch_id, converted, counts)

    if fx.isEmpty():
        raise ValueError("there are sales to convert but no FX rates")
    size = data_bytes(check_unique_countries(normalize_countries(countries)))
    writer = sales.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
