import json
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from samples import RATES, countries, fact_row, facts, line, rates, sales, sorted_rows, utc

import basketry.sources.fact_table as fact_table
import basketry.sources.key_filters as key_filters
import basketry.sources.snapshots as snapshots
from basketry.operators.contracts import ContractViolation, check_unique_key
from basketry.operators.fact import without_key_text
from basketry.operators.upsert import classify, deduplicate, upsert, upsert_counts
from basketry.plans import runs
from basketry.plans.transform import to_fact
from basketry.schemas import FACT, SALES
from basketry.session import list_names, run_scratch, scratch_dir, stage
from basketry.sources.fact_table import one_row_per_key, read_fact, upsert_into
from basketry.sources.sales import read_sales_csv, read_sales_parquet, stream_sales_csv
from basketry.sources.watermark import get_last_watermark
from basketry.streaming.sales_stream import load_stream

NAMES = FACT.fieldNames()


def stored(spark, path):
    return sorted_rows(read_fact(spark, path).select(*NAMES))


def test_same_triple_with_two_hashes_is_two_rows(spark):
    merged = upsert(None, facts(spark, [fact_row(), fact_row(row_hash="def456", quantity=2)]))
    assert merged.count() == 2 and merged.columns == NAMES


def test_upsert_overwrites_inserts_and_keeps(spark):
    target = facts(spark, [fact_row(row_hash="kept"), fact_row(row_hash="hit"), fact_row(row_hash="same")])
    batch = facts(spark, [
        fact_row(row_hash="hit", region="Asia"), fact_row(row_hash="same"), fact_row(row_hash="new")
    ])
    found = {r["row_hash"]: (r["_change"], r["region"]) for r in classify(target, batch).collect()}
    assert found == {
        "kept": ("keep", "Europe"), "hit": ("update", "Asia"), "same": ("same", "Europe"),
        "new": ("insert", "Europe"),
    }
    assert tuple(upsert_counts(target, batch).first()) == (3, 1, 1)


def test_null_key_parts_match(spark):
    target = facts(spark, [fact_row(invoice_no=None, stock_code=None)])
    batch = facts(spark, [fact_row(invoice_no=None, stock_code=None, region="Asia")])
    assert [r["region"] for r in upsert(target, batch).collect()] == ["Asia"]


def test_rows_of_one_key_collapse_to_the_smallest_description_then_country(spark):
    rows = [fact_row(description="b"), fact_row(description="a", country="z"), fact_row(description="a", country="y")]
    only = deduplicate(facts(spark, rows)).collect()
    assert [(r["description"], r["country"]) for r in only] == [("a", "y")]
    assert deduplicate(facts(spark, rows + [fact_row(description=None)])).first()["description"] is None


def test_upsert_agrees_with_brute_force(spark):
    chance = random.Random(11)

    def some(n):
        return [
            fact_row(
                invoice_no=chance.choice(["i1", "i2", None]),
                row_hash=f"h{chance.randint(0, 40)}",
                description=chance.choice(["a", "b", "c"]),
                region=chance.choice(["Europe", "Asia"]),
            )
            for _ in range(n)
        ]

    def once(rows):
        key = [NAMES.index(n) for n in ("invoice_no", "stock_code", "customer_id", "row_hash")]
        at = [NAMES.index(n) for n in ("description", "country", "region")]
        kept = {}
        for row in sorted(rows, key=lambda r: [r[i] for i in at], reverse=True):
            kept[tuple(row[i] for i in key)] = row
        return kept

    old, new = some(150), some(150)
    expected = {**once(old), **once(new)}
    merged = upsert(deduplicate(facts(spark, old)), facts(spark, new))
    at = [NAMES.index(n) for n in ("invoice_no", "row_hash", "description", "region")]
    assert sorted(map(str, merged.select("invoice_no", "row_hash", "description", "region").rdd.map(tuple).collect())) \
        == sorted(str(tuple(row[i] for i in at)) for row in expected.values())


@pytest.mark.parametrize("grain", ["month", "day"])
def test_stored_fact_through_its_life(spark, tmp_path, grain):
    path = str(tmp_path / "fact")

    def load(*rows):
        return upsert_into(spark, path, stage(facts(spark, list(rows)), "batch"), grain)

    january = [fact_row(row_hash=f"j{i}", invoice_date=utc(f"2011-01-0{i}")) for i in range(1, 5)]
    february = fact_row(row_hash="f", invoice_date=utc("2011-02-01"))
    assert read_fact(spark, path).count() == 0
    assert load() == {"records": 0, "upserted": 0, "modified": 0}
    assert load(*january, january[0]) == {"records": 5, "upserted": 4, "modified": 0}
    assert load(*january) == {"records": 4, "upserted": 0, "modified": 0}
    assert load(february, january[3]) == {"records": 2, "upserted": 1, "modified": 0}
    changed = fact_row(row_hash="j2", invoice_date=utc("2011-01-02"), region="Asia")
    extra = fact_row(row_hash="x", invoice_date=utc("2011-03-01"))
    assert load(changed, extra) == {"records": 2, "upserted": 1, "modified": 1}
    assert load(changed, extra) == {"records": 2, "upserted": 0, "modified": 0}
    hashes = {r["row_hash"]: r["region"] for r in read_fact(spark, path).collect()}
    assert hashes == {"j1": "Europe", "j2": "Asia", "j3": "Europe", "j4": "Europe", "f": "Europe", "x": "Europe"}
    check_unique_key(read_fact(spark, path))


def test_one_table_has_one_grain(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = stage(facts(spark, [fact_row()]), "batch")
    upsert_into(spark, path, batch, "month")
    with pytest.raises(ValueError, match="not partitioned by day"):
        upsert_into(spark, path, batch, "day")


def test_undated_rows_are_refused(spark, tmp_path):
    batch = stage(facts(spark, [fact_row(invoice_date=None)]), "batch")
    with pytest.raises(ContractViolation, match="missing in 1 rows"):
        upsert_into(spark, str(tmp_path / "fact"), batch)


def die(*_):
    raise RuntimeError("driver died")


@pytest.mark.parametrize("at", ["claim", "_write_list"])
def test_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "fact")
    rows = [fact_row(row_hash=f"j{i}") for i in range(4)]
    upsert_into(spark, path, stage(facts(spark, rows), "batch"), mark=5)
    change = stage(facts(spark, [fact_row(row_hash="j0", region="Asia")]), "batch")
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, at, die)
        with pytest.raises(RuntimeError, match="driver died"):
            upsert_into(spark, path, change, mark=9)
    assert set(regions(spark, path).values()) == {"Europe"} and fact_table.stored_mark(spark, path) == 5
    assert upsert_into(spark, path, change, mark=9) == {"records": 1, "upserted": 0, "modified": 1}
    assert regions(spark, path) == {"j0": "Asia", "j1": "Europe", "j2": "Europe", "j3": "Europe"}
    assert fact_table.stored_mark(spark, path) == 9


def feeds(tmp_path, *files):
    header = "InvoiceNo,StockCode,Description,Quantity,UnitPrice,InvoiceDate,CustomerID,Country"
    folder = tmp_path / "feed"
    folder.mkdir(exist_ok=True)
    for name, rows in files:
        (folder / name).write_text("\n".join([header, *rows, ""]))
    listed = [{"name": {"common": "United Kingdom"}, "region": "Europe", "population": 60_100_000}, {"region": "none"}]
    (tmp_path / "countries.json").write_text(json.dumps(listed))
    days = [json.dumps({"date": d.isoformat(), "rates": {"EUR": r}}) for d, r in RATES]
    (tmp_path / "fx.json").write_text("\n".join(days))
    return str(folder), str(tmp_path / "countries.json"), str(tmp_path / "fx.json")


FIRST = ("1.csv", [
    "K1,M4,bowl,3,2.5,2011-01-01,c1,United Kingdom", "K2,M5,jar,-4,1.25,2011-01-06,n8,Norway",
    "K3,M6,lid,2,1.5,2011-01-08,n9,Atlantis", "K3,M6,lid too,2,1.5,2011-01-08,n9,Atlantis",
    "K4,M6,lid,2,0,2011-01-09,n9,Atlantis",
])
SECOND = ("2.csv", ["K5,M8,cup,1,8.0,2011-01-11, N5 , United Kingdom ", "K0,M8,late,1,8.0,2011-01-02,n7,Italy"])


def test_runs(spark, tmp_path):
    before = scratch_names(spark)
    fact, meta = str(tmp_path / "fact"), str(tmp_path / "meta")

    def run(inputs):
        return runs.run_daily(spark, *inputs, fact, meta, min_countries=1, multi_line=True)

    first = run(feeds(tmp_path, FIRST))
    assert (first.received, first.added, first.changed, first.newer_than) == (3, 2, 0, None)
    assert first.quality["rows_input"] == 5 and first.quality["rows_output"] == 3
    assert first.metrics == {
        "unmatched_rows": 2, "total_rows": 3, "fallback_lines": 0, "fallback_rate": 1.25, "days_needed": 4,
        "days_missing": 0, "rates_fetched": 5, "min_rate": 1.2, "max_rate": 1.3, "skipped_countries": 1,
    }
    # The mark is that of the cleaned fact: the free item of a later day does not move it.
    assert get_last_watermark(spark, meta) == utc("2011-01-08")

    second = run(feeds(tmp_path, FIRST, SECOND))
    assert second.newer_than == "2011-01-08T00:00:00+00:00"
    assert (second.received, second.added, second.quality["rows_input"]) == (1, 1, 2)
    assert get_last_watermark(spark, meta) == utc("2011-01-11")

    third = run(feeds(tmp_path, FIRST, SECOND))
    assert (third.received, third.added, third.quality, third.metrics) == (0, 0, {}, {})
    assert get_last_watermark(spark, meta) == utc("2011-01-11")
    rows = {r["invoice_no"]: r for r in read_fact(spark, fact).collect()}
    assert set(rows) == {"K1", "K3", "K5"}
    assert rows["K3"]["description"] == "lid" and rows["K3"]["region"] == "unknown"
    assert rows["K5"]["customer_id"] == "n5" and rows["K5"]["revenue_eur"] == 10.0
    assert scratch_names(spark) == before


def scratch_names(spark):
    return list_names(spark, f"{scratch_dir(spark)}/basketry/{spark.sparkContext.applicationId}")


def test_colliding_countries_fail_the_run(spark, tmp_path):
    sales_csv, countries_json, fx_json = feeds(tmp_path, FIRST)
    listed = [{"name": {"common": n}, "region": "Europe", "population": 1} for n in ("Norway", " norway ")]
    (tmp_path / "countries.json").write_text(json.dumps(listed))
    with pytest.raises(ContractViolation, match="collide"):
        runs.run_daily(spark, sales_csv, countries_json, fx_json, str(tmp_path / "fact"), str(tmp_path / "meta"),
                       min_countries=1, multi_line=False)


def test_lost_lines_fail_the_run(spark, tmp_path, monkeypatch):
    inputs = feeds(tmp_path, FIRST)
    monkeypatch.setattr(runs, "to_fact", lambda *args: to_fact(*args).limit(2))
    with pytest.raises(ContractViolation, match="3 lines kept, but 2"):
        runs.run_daily(spark, *inputs, str(tmp_path / "fact"), str(tmp_path / "meta"), min_countries=1, multi_line=False)


def test_stored_key_held_twice_fails_the_load(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_into(spark, path, stage(facts(spark, [fact_row()]), "batch"))
    fact_table.append_rows(spark, path, facts(spark, [fact_row(region="Asia")]))
    with pytest.raises(Exception, match="business key is not unique"):
        upsert_into(spark, path, stage(facts(spark, [fact_row(row_hash="new")]), "batch"))


def test_files_put_together_still_hold_rows_added_as_they_are(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_into(spark, path, stage(facts(spark, [fact_row()]), "batch"))
    fact_table.append_rows(spark, path, facts(spark, [fact_row(region="Asia")]))
    assert fact_table.compact(spark, path, small_files=1) == 2
    assert [f.as_given for f in fact_table.stored_files(spark, path)] == [True]
    with pytest.raises(Exception, match="business key is not unique"):
        upsert_into(spark, path, stage(facts(spark, [fact_row(row_hash="new")]), "batch"))


def test_a_batch_without_repeated_keys_is_not_combined(spark):
    rows = [fact_row(row_hash=f"h{i}") for i in range(5)] + [fact_row(row_hash=None), fact_row(stock_code=None)]
    again = [fact_row(row_hash="h1", description="a"), fact_row(row_hash="h2"), fact_row(row_hash=None, country="a")]
    alone, repeated = stage(facts(spark, rows), "alone"), stage(facts(spark, rows + again), "repeated")
    for batch in (alone, repeated):
        wanted = sorted_rows(deduplicate(batch))
        assert len(wanted) == len(rows)
        assert sorted_rows(fact_table.one_row_per_key(batch)) == wanted
        assert sorted_rows(fact_table.one_row_per_key(batch, many=1)) == wanted
    plan = fact_table.one_row_per_key(alone)._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_a_micro_batch_reads_the_rates_once(spark, tmp_path, monkeypatch):
    import basketry.streaming.sales_stream as streaming

    seen, inner = [], streaming.convert
    monkeypatch.setattr(streaming, "convert", lambda s, n, c, fx, size: seen.append(fx.inputFiles()) or inner(s, n, c, fx, size))
    lines = stream_sales_csv(spark, feeds(tmp_path, FIRST)[0], multi_line=True)
    fact, checkpoint = str(tmp_path / "fact"), str(tmp_path / "checkpoint")
    load_stream(spark, lines, countries(spark), rates(spark), fact, checkpoint).awaitTermination()
    assert len(seen) == 1 and seen[0]  # staged, not worked out again by everything that reads them


MONTHS = [fact_row(row_hash=f"{m}{i}", invoice_date=utc(f"2011-{m}-0{i}")) for m in ("01", "02", "03") for i in (1, 2)]


def test_a_micro_batch_drops_its_lines_once_they_are_converted(spark, tmp_path, monkeypatch):
    import basketry.streaming.sales_stream as streaming

    staged, left = [], []
    stage_sales, upsert = streaming.stage_sales, streaming.upsert_into
    monkeypatch.setattr(streaming, "stage_sales", lambda lines, path: staged.append(path) or stage_sales(lines, path))
    monkeypatch.setattr(streaming, "upsert_into", lambda *args: left.extend(map(os.path.exists, staged)) or upsert(*args))
    lines = stream_sales_csv(spark, feeds(tmp_path, FIRST)[0], multi_line=True)
    fact, checkpoint = str(tmp_path / "fact"), str(tmp_path / "checkpoint")
    load_stream(spark, lines, countries(spark), rates(spark), fact, checkpoint).awaitTermination()
    assert left == [False] and read_fact(spark, fact).count()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_staged_shuffle_leaves_no_files(spark):
    before, rows = shuffle_files(spark), spark.range(1000)
    kept = stage(rows.repartition(8, "id"), "ids", packed=True)
    for _ in range(100):  # they are dropped beside what runs next
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and kept.count() == 1000


def test_passes_take_neighbouring_periods_of_about_as_many_rows():
    months = [Row(n=10, first=i * 100, last=i * 100 + 50) for i in range(6)]
    assert fact_table._passes(months, 3, 20) == [(0, 150), (200, 350), (400, 550)]
    assert fact_table._passes(months, 6, 60) == [(0, 550)]
    assert fact_table._passes(months, 2, 1) == [(0, 250), (300, 550)]
    large = [Row(n=1, first=0, last=5), Row(n=1000, first=10, last=15), Row(n=1, first=20, last=25)]
    assert fact_table._passes(large, 6, 100) == [(0, 5), (10, 15), (20, 25)]


def test_a_batch_laid_out_in_passes_is_one_version_with_the_same_rows(spark, tmp_path, monkeypatch):
    again = [MONTHS[0], fact_row(row_hash="021", invoice_date=utc("2011-02-01"), description="0", region="Asia")]
    collided = fact_row(row_hash="012", invoice_date=utc("2011-03-05"), description="b")  # a key of another month
    batch = stage(facts(spark, MONTHS + again + [collided]), "batch")
    whole, passes = str(tmp_path / "whole"), fact_table._passes
    wanted = upsert_into(spark, whole, batch, mark=5)
    monkeypatch.setattr(fact_table, "_passes", lambda found: passes(found, rows=1))
    for many in (0, fact_table._MANY_REPEATED):
        monkeypatch.setattr(fact_table, "one_row_per_key", lambda b, many=many: one_row_per_key(b, many))
        path = str(tmp_path / f"passes{many}")
        assert upsert_into(spark, path, batch, mark=5) == wanted == {"records": 9, "upserted": 6, "modified": 0}
        assert stored(spark, path) == stored(spark, whole) == sorted_rows(deduplicate(batch))
        files = fact_table.stored_files(spark, path)
        assert len({fact_table._load_of(f.file) for f in files}) == 3 == len({f.period for f in files})
        assert snapshots.current(spark, path).number == 1 and fact_table.stored_mark(spark, path) == 5


def changed(row, region="Asia"):
    return tuple(region if n == "region" else v for n, v in zip(NAMES, row))


def regions(spark, path):
    return {r["row_hash"]: r["region"] for r in read_fact(spark, path).collect()}


def between(monkeypatch, act):
    """Run ``act`` once just before the next load claims its version."""
    claim = snapshots.claim
    waiting = [act]

    def claim_later(*args):
        if waiting:
            waiting.pop()()
        return claim(*args)

    monkeypatch.setattr(snapshots, "claim", claim_later)


def counted(monkeypatch):
    calls = []
    monkeypatch.setattr(
        fact_table, "classify", lambda *args, **options: calls.append(1) or classify(*args, **options)
    )
    return calls


def test_interleaved_loads_of_one_period_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    upsert_into(spark, path, stage(facts(spark, MONTHS), "batch"))
    mine = stage(facts(spark, [changed(MONTHS[0]), fact_row(row_hash="a", invoice_date=utc("2011-01-01"))]), "mine")
    theirs = stage(facts(spark, [
        changed(MONTHS[0], "Africa"), changed(MONTHS[1], "Africa"), fact_row(row_hash="b", invoice_date=utc("2011-01-01"))
    ]), "theirs")
    other = []
    between(monkeypatch, lambda: other.append(upsert_into(spark, path, theirs, mark=8)))
    calls = counted(monkeypatch)
    assert upsert_into(spark, path, mine, mark=7) == {"records": 2, "upserted": 1, "modified": 1}
    assert other == [{"records": 3, "upserted": 1, "modified": 2}] and len(calls) == 3  # mine was worked out twice
    assert regions(spark, path) == {
        "011": "Asia", "012": "Africa", "021": "Europe", "022": "Europe", "031": "Europe", "032": "Europe",
        "a": "Europe", "b": "Europe",
    }
    assert fact_table.stored_mark(spark, path) == 8
    check_unique_key(read_fact(spark, path))


def test_interleaved_loads_of_different_periods_are_worked_out_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    upsert_into(spark, path, stage(facts(spark, MONTHS), "batch"))
    mine, theirs = (stage(facts(spark, [changed(MONTHS[i])]), "batch") for i in (0, 2))
    between(monkeypatch, lambda: upsert_into(spark, path, theirs))
    calls = counted(monkeypatch)
    upsert_into(spark, path, mine)
    assert len(calls) == 2
    found = regions(spark, path)
    assert found["011"] == found["021"] == "Asia" and len(found) == len(MONTHS)


def test_first_loads_at_the_same_moment(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    both = [stage(facts(spark, [fact_row(row_hash="same"), fact_row(row_hash=name)]), "batch") for name in "ab"]
    between(monkeypatch, lambda: upsert_into(spark, path, both[1]))
    assert upsert_into(spark, path, both[0]) == {"records": 2, "upserted": 1, "modified": 0}
    assert set(regions(spark, path)) == {"same", "a", "b"}
    check_unique_key(read_fact(spark, path))


def test_only_one_writer_claims_a_version(spark, tmp_path):
    path = str(tmp_path / "fact")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: snapshots.claim(spark, path, snapshots.Version(1, mark=i)), range(8)))
    assert sum(won) == 1 and snapshots.current(spark, path).mark == won.index(True)


def test_a_reader_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_into(spark, path, stage(facts(spark, MONTHS), "batch"))
    before = read_fact(spark, path)
    for region in ("Asia", "Africa"):
        upsert_into(spark, path, stage(facts(spark, [changed(r, region) for r in MONTHS]), "batch"))
        assert {r["region"] for r in before.collect()} == {"Europe"} and before.count() == len(MONTHS)
        assert set(regions(spark, path).values()) == {region}


def test_only_files_with_changes_are_replaced(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = [fact_row(row_hash=f"d{d}", invoice_date=utc(f"2011-01-{d:02}")) for d in range(1, 7)]
    for row in days:
        upsert_into(spark, path, stage(facts(spark, [row]), "batch"))
    before = {f.file for f in fact_table.stored_files(spark, path)}
    assert len(before) == 6
    upsert_into(spark, path, stage(facts(spark, [changed(days[1]), days[3]]), "batch"))
    after = {f.file for f in fact_table.stored_files(spark, path)}
    assert len(before - after) == 1 and len(after - before) == 1
    assert regions(spark, path) == {f"d{d}": "Asia" if d == 2 else "Europe" for d in range(1, 7)}


def test_files_outside_the_times_of_a_batch_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    days = [fact_row(row_hash=f"d{d}", invoice_date=utc(f"2011-01-{d:02}")) for d in range(1, 7)]
    for row in days:
        upsert_into(spark, path, stage(facts(spark, [row]), "batch"))
    read = []
    inner = fact_table._merged
    monkeypatch.setattr(fact_table, "_merged", lambda s, p, near, *rest: read.append(len(near)) or inner(s, p, near, *rest))
    assert upsert_into(spark, path, stage(facts(spark, [changed(days[2])]), "batch"))["modified"] == 1
    assert read == [1]


def test_a_late_line_reads_only_files_that_may_hold_its_key(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    day = utc("2011-01-05")
    for i in range(6):  # six files of the same time
        rows = [fact_row(row_hash=f"f{i}-{n}", invoice_date=day) for n in range(20)]
        upsert_into(spark, path, stage(facts(spark, rows), "batch"))
    read = []
    inner = fact_table._merged
    monkeypatch.setattr(fact_table, "_merged", lambda s, p, near, *rest: read.append(len(near)) or inner(s, p, near, *rest))
    new = fact_row(row_hash="late", invoice_date=day)
    assert upsert_into(spark, path, stage(facts(spark, [new]), "batch"))["upserted"] == 1
    known = fact_row(row_hash="f3-7", invoice_date=day, region="Asia")
    assert upsert_into(spark, path, stage(facts(spark, [known]), "batch"))["modified"] == 1
    assert sum(read) <= 3  # the file that holds it; a filter rarely takes one key for another
    assert regions(spark, path)["f3-7"] == "Asia" and len(regions(spark, path)) == 121
    check_unique_key(read_fact(spark, path))


def test_key_filters_know_every_key_and_few_others(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("file"), F.col("id") % 7).alias("f"), F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("part"),
    )
    sizes = {r["f"]: r["count"] for r in rows.groupBy("f").count().collect()}
    words = spark.createDataFrame([(f, key_filters.words_for(n)) for f, n in sizes.items()], "file string, words long")
    hashed = key_filters.key_hash("key", "part")
    filters = key_filters.build(rows, "f", hashed, words).cache()
    assert filters.groupBy("file").count().filter("count > 1024").count() == 0
    own = rows.select(F.col("f").alias("file"), hashed.alias("h")).join(words, "file")
    assert key_filters.may_hold(own.filter("file = 'file3'").limit(1), filters).first()["file"] == "file3"
    # One by one: each pair as a file of its own, so that every key is asked for by itself.
    asked = own.select(key_filters._word(F.col("h"), F.col("words")).alias("word"), key_filters._mask(F.col("h")).alias("mask"), "file")
    known = asked.join(filters, ["file", "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    assert known.count() == 20_000
    others = spark.range(20_000).select(F.lit("file1").alias("file"), F.xxhash64(F.col("id") + 10**9).alias("h")).join(words, "file")
    asked = others.select(key_filters._word(F.col("h"), F.col("words")).alias("word"), key_filters._mask(F.col("h")).alias("mask"), "file")
    wrong = asked.join(filters, ["file", "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    assert wrong.count() < 600


def test_versions_and_what_they_dropped_go(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    monkeypatch.setattr(snapshots, "KEPT", 3)
    monkeypatch.setattr(snapshots, "_LISTS", 4)
    for i in range(9):
        rows = [fact_row(row_hash="r", region=f"Region {i}"), fact_row(row_hash=f"e{i}")]
        upsert_into(spark, path, stage(facts(spark, rows), "batch"))
    assert len([n for n in list_names(spark, f"{path}/_versions") if n[0] == "0"]) == 3
    assert len([n for n in list_names(spark, f"{path}/_versions") if n.startswith("files-")]) <= 4 + 3
    assert not [n for n in list_names(spark, f"{path}/_versions") if n.startswith("claim")]
    live = {f.file for f in fact_table.stored_files(spark, path)}
    on_disk = {str(f.relative_to(path)) for f in (tmp_path / "fact").glob("invoice_period=*/*/part-*.parquet")}
    assert live <= on_disk and len(on_disk - live) <= 3
    loads = {f.split("load=")[1].split("/")[0] for f in on_disk}
    assert {n.split("=")[1] for n in list_names(spark, f"{path}/_keys")} == loads
    assert regions(spark, path) == {"r": "Region 8"} | {f"e{i}": "Europe" for i in range(9)}


def test_many_small_loads_leave_few_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    monkeypatch.setattr(fact_table, "SMALL_FILES", 4)
    monkeypatch.setattr(fact_table.compact, "__defaults__", (None, fact_table.FILE_BYTES, 4))
    rows = [fact_row(row_hash=f"r{i}", invoice_date=utc(f"2011-0{1 + i % 2}-{1 + i % 9:02}")) for i in range(24)]
    for row in rows:
        upsert_into(spark, path, stage(facts(spark, [row]), "batch"))
    assert len(fact_table.stored_files(spark, path)) <= 2 * 5
    assert sorted(regions(spark, path)) == sorted(f"r{i}" for i in range(24))
    check_unique_key(read_fact(spark, path))


def test_put_together_files_keep_their_size_and_yield_to_loads(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    days = [fact_row(row_hash=f"d{d}", invoice_date=utc(f"2011-01-{d:02}")) for d in range(1, 9)]
    for row in days:
        upsert_into(spark, path, stage(facts(spark, [row]), "batch"))
    listed = fact_table.stored_files(spark, path)
    size = listed[0].bytes * 3
    with monkeypatch.context() as patch:
        between(patch, lambda: upsert_into(spark, path, stage(facts(spark, [changed(days[0])]), "batch")))
        assert fact_table.compact(spark, path, file_bytes=size, small_files=2) == 0
    assert regions(spark, path)["d1"] == "Asia"
    assert fact_table.compact(spark, path, file_bytes=size, small_files=2) >= 6
    after = fact_table.stored_files(spark, path)
    assert 3 <= len(after) <= 5 and sum(f.rows for f in after) == 8
    assert all(a.last <= b.first for a, b in zip(after, after[1:]))
    assert sorted(regions(spark, path)) == sorted(f"d{d}" for d in range(1, 9))


def test_a_fact_without_versions_is_refused(spark, tmp_path):
    path = tmp_path / "fact"
    (path / "invoice_period=2011-01").mkdir(parents=True)
    with pytest.raises(ValueError, match="without versions"):
        read_fact(spark, str(path))


def test_only_touched_periods_are_read_and_a_replay_writes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    year = [fact_row(row_hash=f"m{m}", invoice_date=utc(f"2011-{m:02}-03")) for m in range(1, 13)]
    upsert_into(spark, path, stage(facts(spark, year), "batch"))
    files = sorted(f for f in os.listdir(path) if "=" in f)
    assert len(files) == 12
    plans = []
    monkeypatch.setattr(
        fact_table, "classify",
        lambda target, batch, **options: plans.append(target) or classify(target, batch, **options),
    )
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    counts = upsert_into(spark, path, stage(facts(spark, [year[0], year[11]]), "batch"))
    assert counts == {"records": 2, "upserted": 0, "modified": 0}
    assert {str(f): f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")} == before
    scan = [p.select(F.input_file_name()).distinct().count() for p in plans]
    assert scan == [2]


def test_failed_load_is_repeated(spark, tmp_path, monkeypatch):
    fact, meta = str(tmp_path / "fact"), str(tmp_path / "meta")
    inputs = feeds(tmp_path, FIRST)

    def run():
        return runs.run_daily(spark, *inputs, fact, meta, min_countries=1, multi_line=False)

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "claim", die)
        with pytest.raises(RuntimeError):
            run()
    assert fact_table.stored_mark(spark, fact) is None and get_last_watermark(spark, meta) is None
    assert read_fact(spark, fact).count() == 0
    again = run()
    assert (again.received, again.added, again.changed) == (3, 2, 0)
    assert get_last_watermark(spark, meta) == utc("2011-01-08")


def test_no_crash_parts_the_mark_from_the_rows(spark, tmp_path, monkeypatch):
    fact, meta = str(tmp_path / "fact"), str(tmp_path / "meta")
    inputs = feeds(tmp_path, FIRST)
    with monkeypatch.context() as patch:
        patch.setattr(runs, "update_watermark", die)  # after the commit, before the copy of the mark
        with pytest.raises(RuntimeError):
            runs.run_daily(spark, *inputs, fact, meta, min_countries=1, multi_line=False)
    before = stored(spark, fact)
    assert get_last_watermark(spark, meta) is None and fact_table.stored_mark(spark, fact) is not None
    again = runs.run_daily(spark, *inputs, fact, meta, min_countries=1, multi_line=False)
    assert (again.received, again.added, again.newer_than) == (0, 0, "2011-01-08T00:00:00+00:00")
    assert stored(spark, fact) == before and get_last_watermark(spark, meta) == utc("2011-01-08")


def test_all_lines_dropped_leaves_the_mark(spark, tmp_path):
    fact, meta = str(tmp_path / "fact"), str(tmp_path / "meta")
    inputs = feeds(tmp_path, ("1.csv", ["K2,M5,jar,-4,1.25,2011-01-06,n8,Norway"]))
    result = runs.run_daily(spark, *inputs, fact, meta, min_countries=1, multi_line=False)
    assert (result.received, result.added, result.quality["rows_output"]) == (0, 0, 0)
    assert get_last_watermark(spark, meta) is None


def test_sales_without_rates_fail(spark, tmp_path):
    sales_csv, countries_json, _ = feeds(tmp_path, FIRST)
    (tmp_path / "none.json").write_text("")
    with pytest.raises(ValueError, match="no FX rates"):
        runs.run_daily(spark, sales_csv, countries_json, str(tmp_path / "none.json"),
                       str(tmp_path / "fact"), str(tmp_path / "meta"), min_countries=1, multi_line=False)


def test_any_split_into_two_loads_equals_one(spark, tmp_path):
    start = utc("2011-01-01")
    chance = random.Random(5)
    raw = [
        line(f"A{chance.randint(0, 9)}", Quantity=chance.randint(-1, 3), StockCode=chance.choice("XY"),
             InvoiceDate=start + timedelta(days=chance.randint(0, 40)))
        for _ in range(200)
    ]
    fact = stage(without_key_text(to_fact(sales(spark, raw), countries(spark), rates(spark))), "fact")
    whole = sorted_rows(deduplicate(fact))
    for i, cut in enumerate(["2011-01-09", "2011-02-03"]):
        path = str(tmp_path / f"fact{i}")
        for part in (f"invoice_date <= '{cut}'", f"invoice_date > '{cut}'", "true"):
            upsert_into(spark, path, stage(fact.filter(part), "part"))
        assert stored(spark, path) == whole


def test_stream_loads_each_file_once(spark, tmp_path):
    before = scratch_names(spark)
    fact, checkpoint = str(tmp_path / "fact"), str(tmp_path / "checkpoint")

    def run(folder):
        lines = stream_sales_csv(spark, folder, max_files_per_trigger=1, multi_line=True)
        load_stream(spark, lines, countries(spark), rates(spark), fact, checkpoint).awaitTermination()
        return {r["invoice_no"] for r in read_fact(spark, fact).collect()}

    assert run(feeds(tmp_path, FIRST)[0]) == {"K1", "K3"}
    # A stream takes late lines too: the mark belongs to the batch runs.
    assert run(feeds(tmp_path, FIRST, SECOND)[0]) == {"K0", "K1", "K3", "K5"}
    assert run(feeds(tmp_path, FIRST, SECOND)[0]) == {"K0", "K1", "K3", "K5"}
    assert scratch_names(spark) == before
    check_unique_key(read_fact(spark, fact))


THIRD = ("3.csv", ["K1,M4,bowl,3,2.5,2011-01-01,c1,United Kingdom", "K6,M9,pan,2,4.0,2011-01-01,n3,Italy",
                   "K5,M8,cup,1,8.0,2011-01-11, N5 , United Kingdom ", "K7,M9,pan,0,4.0,2011-01-12,n3,Italy"])


def streamed(spark, folder, tmp_path, on_loaded=None):
    lines = stream_sales_csv(spark, folder, max_files_per_trigger=1, multi_line=True)
    listed, fx, checkpoint = countries(spark), rates(spark), str(tmp_path / "checkpoint")
    query = load_stream(spark, lines, listed, fx, str(tmp_path / "fact"), checkpoint, on_loaded=on_loaded)
    query.awaitTermination()


def test_micro_batches_with_late_and_repeated_lines_equal_one_batch(spark, tmp_path):
    folder = feeds(tmp_path, FIRST, SECOND, THIRD)[0]
    seen = []
    streamed(spark, folder, tmp_path, lambda n, converted, counts: seen.append((n, converted, counts)))
    lines = read_sales_csv(spark, folder, multi_line=True)
    upsert_into(spark, str(tmp_path / "whole"), stage(without_key_text(to_fact(lines, countries(spark), rates(spark))), "w"))
    assert sorted_rows(read_fact(spark, str(tmp_path / "fact"))) == sorted_rows(read_fact(spark, str(tmp_path / "whole")))
    assert [n for n, _, _ in seen] == [0, 1, 2]
    assert sum(converted.quality["rows_input"] for _, converted, _ in seen) == 11
    assert sum(counts["upserted"] for _, _, counts in seen) == read_fact(spark, str(tmp_path / "fact")).count() == 5
    assert sum(counts["modified"] for _, _, counts in seen) == 0
    assert sum(converted.metrics["unmatched_rows"] for _, converted, _ in seen) == 2


def test_a_broken_micro_batch_stops_the_stream(spark, tmp_path, monkeypatch):
    streamed(spark, feeds(tmp_path, FIRST)[0], tmp_path)
    loaded = sorted_rows(read_fact(spark, str(tmp_path / "fact")))
    before = scratch_names(spark)
    # A join that multiplies lines.
    monkeypatch.setattr(runs, "to_fact", lambda *args: to_fact(*args).union(to_fact(*args)))
    with pytest.raises(Exception, match="2 lines kept, but 4 in the fact"):
        streamed(spark, feeds(tmp_path, FIRST, SECOND)[0], tmp_path)
    assert sorted_rows(read_fact(spark, str(tmp_path / "fact"))) == loaded and scratch_names(spark) == before
    monkeypatch.undo()
    # The micro-batch is still to be loaded.
    streamed(spark, feeds(tmp_path, FIRST, SECOND)[0], tmp_path)
    assert {r["invoice_no"] for r in read_fact(spark, str(tmp_path / "fact")).collect()} == {"K0", "K1", "K3", "K5"}


def test_a_stream_needs_clean_reference_data(spark, tmp_path):
    lines = stream_sales_csv(spark, feeds(tmp_path, FIRST)[0], multi_line=True)
    twice = countries(spark, [("Norway", "Europe", 1), (" norway", "Europe", 1)])
    with pytest.raises(ContractViolation, match="collide"):
        load_stream(spark, lines, twice, rates(spark), str(tmp_path / "fact"), str(tmp_path / "checkpoint"))
    with pytest.raises(ValueError, match="no FX rates"):
        load_stream(spark, lines, countries(spark), rates(spark, []), str(tmp_path / "fact"), str(tmp_path / "checkpoint"))


def counting(df, rows):
    """``df``, and how many of its rows were read adds up in ``rows``."""
    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def test_a_run_reads_the_feed_once_and_the_staged_lines_twice(spark, tmp_path, monkeypatch):
    inputs, meta = feeds(tmp_path, FIRST, SECOND), str(tmp_path / "meta")
    fed, held = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    monkeypatch.setattr(runs, "read_sales_csv", lambda *a, **k: counting(read_sales_csv(*a, **k), fed))
    monkeypatch.setattr(runs, "read_sales_parquet", lambda *a: counting(read_sales_parquet(*a), held))
    with run_scratch(spark, "run"):
        staged = runs.run_extract(spark, *inputs, meta, min_countries=1, multi_line=True)
        assert staged.lines == 7 and fed.value == 7 and held.value == 0
        converted = runs.run_transform(spark, staged)
        assert converted.lines == 5 and fed.value == 7 and held.value <= 14
        assert converted.metrics["total_rows"] == 5 and converted.newest == 1_294_704_000_000_000


def test_an_extract_without_lines_counts_none(spark, tmp_path):
    with run_scratch(spark, "run"):
        staged = runs.run_extract(
            spark, *feeds(tmp_path, ("1.csv", [])), str(tmp_path / "meta"), min_countries=1, multi_line=False
        )
        assert staged.counters == {**dict.fromkeys(staged.counters, 0)} and staged.lines == 0
        assert runs.run_transform(spark, staged) == runs.Converted()


def test_lines_without_a_time_fail_the_extract(spark, tmp_path, monkeypatch):
    gap = spark.createDataFrame([line("K9", InvoiceDate=None)], SALES)
    monkeypatch.setattr(runs, "read_sales_csv", lambda *a, **k: gap)
    with run_scratch(spark, "run"), pytest.raises(ContractViolation, match="InvoiceDate has missing values"):
        runs.run_extract(spark, *feeds(tmp_path, FIRST), str(tmp_path / "meta"), min_countries=1, multi_line=True)


def test_scratch_is_the_shared_folder(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
