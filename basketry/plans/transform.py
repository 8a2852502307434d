"""Raw sales lines -> fact."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.operators.clean import clean_sales
from basketry.operators.enrich import enrich_with_countries, normalize_countries, normalize_sales
from basketry.operators.fact import build_fact_records
from basketry.operators.fx import apply_fx_historical


def to_fact(
    sales: DataFrame, countries: DataFrame, fx: DataFrame, countries_bytes: int | None = None
) -> DataFrame:
    """Clean, normalize, enrich, convert and shape; one scan of the sales and no shuffle of them.

    ``countries_bytes``: the measured size of the normalized countries, if it is known.
    """
    return (
        sales.transform(clean_sales)
        .transform(normalize_sales)
        .transform(enrich_with_countries, normalize_countries(countries), side_bytes=countries_bytes)
        .transform(apply_fx_historical, fx)
        .transform(build_fact_records)
    )
