"""What the plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F
from samples import countries, fact_row, facts, rates, sales, utc

import __spark_entry__ as registered
from basketry.operators.clean import clean_sales
from basketry.operators.enrich import enrich_with_countries, normalize_countries, normalize_sales
from basketry.operators.upsert import classify
from basketry.plans.transform import to_fact
from basketry import session
from basketry.session import fit_shuffles, input_bytes, list_names, stage
from basketry.sources import star_schema as star
from basketry.sources.fact_table import read_fact, upsert_into
from basketry.sources.sales import newer_than

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    n for n in registered.queries()
    if not re.match("two_run|stream|.*_scan|staged|customer_concentration|.*_concentration|run_metrics|fx_asof_lines|last_purchase|op|pipeline", n)
]


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(registered.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search("Python|MapInPandas|Scan ExistingRDD.*l_", plan)


def test_fact_shuffles_no_sales(spark, tmp_path):
    path = str(tmp_path / "sales")
    sales(spark).write.parquet(path)
    plan = plan_of(to_fact(spark.read.parquet(path), countries(spark), rates(spark)), "simple")
    # The shuffles of the plan belong to the rate table.
    main = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l or "SinglePartition" in l]
    assert all("date" in l or "SinglePartition" in l for l in main)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "sales")
    sales(spark).write.parquet(path)
    newer = newer_than(spark.read.parquet(path), utc("2011-01-03")).select("InvoiceNo")
    plan = plan_of(newer)
    assert "GreaterThan(InvoiceDate,2011-01-03" in plan
    assert "ReadSchema: struct<InvoiceNo:string,InvoiceDate:timestamp>" in plan


def test_upsert_sorts_no_stored_rows_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts(spark, [fact_row()]).write.parquet(path)
    target = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(classify(target, facts(spark, [fact_row()]), unique_target=True), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored, batch = plan.split("SortMergeJoin")[1].split("+- SortAggregate", 1)
    # The stored rows: one exchange, straight from the scan. The batch: copies go by hash first.
    assert stored.count("Exchange") == 1 and "Aggregate" not in stored
    assert batch.count("HashAggregate") == 2 and "partial_count" in batch and "partial_min" in batch


def test_reference_scans_land_no_sales(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("sales were landed")

    monkeypatch.setattr(star, "land_sales", refuse)
    assert registered.queries()["countries_json_scan"](spark, SF_DIR).count() == 25
    assert registered.queries()["fx_json_scan"](spark, SF_DIR).count() > 0


def test_shuffles_are_sized_by_the_input(spark, tmp_path, monkeypatch):
    for name, size in (("a.csv", 1000), ("b.csv", 500)):
        (tmp_path / name).write_bytes(b"x" * size)
    assert input_bytes(spark, [str(tmp_path), str(tmp_path / "none")]) == 1500
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fit_shuffles(spark, [str(tmp_path)])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # the submitter's setting stays
    monkeypatch.setattr(type(spark.sparkContext.getConf()), "contains", lambda *_: False)
    monkeypatch.setattr(session, "input_bytes", lambda *_: 100 * 2**30)
    try:
        fit_shuffles(spark, [str(tmp_path)])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stored_fact_is_pruned_by_period_and_time(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [fact_row(row_hash=m, invoice_date=utc(f"2011-{m}-01")) for m in ("01", "02", "03")]
    upsert_into(spark, path, stage(facts(spark, rows), "batch"))
    plan = plan_of(read_fact(spark, path).filter("invoice_period = '2011-02' and invoice_date > '2011-02-01'"))
    assert "PartitionFilters: [isnotnull(invoice_period" in plan
    assert "GreaterThan(invoice_date" in plan


def test_cleaning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "sales")
    sales(spark).write.parquet(path)
    plan = plan_of(clean_sales(spark.read.parquet(path)).select("InvoiceNo"))
    for pushed in ("IsNotNull(CustomerID)", "GreaterThan(Quantity,0)", "GreaterThan(UnitPrice,0.0)"):
        assert pushed in plan


def test_fact_stage_can_be_compiled(spark, tmp_path):
    """The JVM interprets methods over 8000 bytes of bytecode, which made the fact several times slower."""
    path = str(tmp_path / "sales")
    sales(spark).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for fact in (
            to_fact(spark.read.parquet(path), countries(spark), rates(spark)),
            to_fact(*[read(spark, SF_DIR) for read in (star.sales, star.countries, star.fx_rates)]),
        ):
            sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan_of(fact, "codegen"))
            assert sizes and max(map(int, sizes)) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_country_is_split_when_its_join_is_shuffled(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, "Norway").otherwise(F.concat(F.lit("Land "), F.col("id") % 5000))
        lines = spark.range(0, 60000, 1, 8).select(
            F.col("id").cast("string").alias("InvoiceNo"), F.lit("c1").alias("CustomerID"), hot.alias("Country")
        )
        joined = enrich_with_countries(
            normalize_sales(lines), normalize_countries(countries(spark)), limit_bytes=0
        )
        found = joined.groupBy("region").agg(F.count_distinct("InvoiceNo"))
        assert dict(found.collect()) == {"Europe": 20000, "unknown": 40000}
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_landing_sorts_no_lines_by_folder(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    landed = star.land_sales(spark, SF_DIR, str(tmp_path), "1998-01-01")
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    plan = next(p for p in reversed(plans) if f"{tmp_path}/sales" in p)
    assert not re.search(r"\[part#\d+ ASC", plan)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    found = spark.read.csv(list(landed.values()), header=True)
    assert found.count() == star.sales(spark, SF_DIR).count()


def test_packed_landing_holds_the_same_lines_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "_PACKED_LINES", 1000)
    plain = star.land_sales(spark, SF_DIR, str(tmp_path / "plain"), "1998-01-01")
    packed = star.land_sales(spark, SF_DIR, str(tmp_path / "packed"), "1998-01-01", packed=True)
    for part in plain:
        rows, wanted = (spark.read.csv(found[part], header=True) for found in (packed, plain))
        assert sorted(rows.collect(), key=str) == sorted(wanted.collect(), key=str)
        assert input_bytes(spark, [packed[part]]) < input_bytes(spark, [plain[part]]) / 2
        assert max(r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()) <= 1000
        assert all(name.endswith(".csv.gz") for name in list_names(spark, packed[part]) if name.startswith("part-"))


def test_stream_load_lands_packed_files(spark, monkeypatch):
    landed, land = [], star.land_sales
    monkeypatch.setattr(star, "land_sales", lambda *args: landed.append(land(*args)) or landed[-1])
    found, read = [], registered.load_stream
    monkeypatch.setattr(
        registered, "load_stream", lambda *args: found.extend(n for p in landed[0].values() for n in list_names(spark, p)) or read(*args)
    )
    rows = registered.queries()["stream_load"](spark, SF_DIR)
    assert found and all(n.endswith(".csv.gz") for n in found if n.startswith("part-"))
    assert rows.count()
