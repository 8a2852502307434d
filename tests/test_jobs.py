import json

import pytest
from samples import utc
from test_load import FIRST, SECOND, feeds

from basketry.__main__ import main
from basketry.sources.watermark import get_last_watermark


def test_load_then_insights(spark, tmp_path, capsys):
    sales, countries, fx = feeds(tmp_path, FIRST, SECOND)
    fact, meta, out = (str(tmp_path / n) for n in ("fact", "meta", "out"))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    main(["load", "--sales", sales, "--countries", countries, "--fx", fx, "--fact", fact,
          "--metadata", meta, "--min-countries", "1", "--grain", "day", "--one-line-per-row"])
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions  # the submitter's setting stays
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (result["received"], result["added"], result["changed"]) == (5, 4, 0)
    assert get_last_watermark(spark, meta) == utc("2011-01-11")

    main(["insights", "--fact", fact, "--out", out])
    assert spark.read.parquet(f"{out}/headline_metrics").first()["transactions"] == 4
    main(["insights", "--fact", fact, "--state", f"{out}-state", "--out", f"{out}-kept"])
    assert spark.read.parquet(f"{out}-kept/headline_metrics").first()["transactions"] == 4
    main(["insights", "--sales", sales, "--out", f"{out}-feed", "--breaks-in-quotes"])
    home = spark.read.parquet(f"{out}-feed/home_market_share").first()
    assert (home["home_market"], home["home_revenue"]) == ("United Kingdom", 8.775)


def test_a_feed_needs_to_be_described(tmp_path):
    with pytest.raises(SystemExit):
        main(["insights", "--sales", str(tmp_path), "--out", str(tmp_path)])
    with pytest.raises(SystemExit):
        main(["insights", "--sales", str(tmp_path), "--out", str(tmp_path), "--one-line-per-row", "--state", "s"])
