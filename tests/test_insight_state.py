"""Roll-ups kept beside the stored fact, against insights of all its lines."""

import random
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from samples import fact_row, facts, sorted_rows, utc

import basketry.sources.fact_table as fact_table
from basketry.plans import insight_state
from basketry.plans.insight_state import rollups
from basketry.plans.insights import all_insights
from basketry.session import list_names, stage
from basketry.sources import snapshots
from basketry.sources.fact_table import compact, read_fact, upsert_into


def some_lines(n, days, seed):
    chance = random.Random(seed)
    return [
        fact_row(
            invoice_no=chance.choice(["i1", "i2", "i3", "i4", None]),
            stock_code=chance.choice(["p1", "p2", None]),
            description=chance.choice(["plate", "bowl", None]),
            customer_id=chance.choice(["c1", "c2", "c3", None]),
            country=chance.choice(["united kingdom", "norway", "italy", None]),
            invoice_date=utc(f"2011-{chance.choice(days)} 1{chance.randint(0, 9)}:30"),
            revenue_eur=chance.randint(0, 99999) / 10000,
            row_hash=f"h{seed}-{i}",
        )
        for i in range(n)
    ]


def load(spark, path, rows, grain="month"):
    return upsert_into(spark, path, stage(facts(spark, rows), "batch"), grain)


def tables(found):
    return {name: sorted_rows(table) for name, table in found.items()}


@pytest.mark.parametrize("grain", ["month", "day"])
def test_reports_through_loads_equal_reports_of_all_lines(spark, tmp_path, grain):
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    empty = rollups(spark, fact, state)
    assert empty.renewed == () and empty.insights()["headline_metrics"].first()["customers"] == 0
    for seed, days in enumerate([["01-03", "01-30", "02-01"], ["02-02", "03-05"]]):
        load(spark, fact, some_lines(60, days, seed), grain)
        found = rollups(spark, fact, state)
        assert set(found.renewed) == {f"2011-{d}" if grain == "day" else f"2011-{d[:2]}" for d in days}
    assert tables(found.insights()) == tables(all_insights(read_fact(spark, fact)))
    assert rollups(spark, fact, state).renewed == ()


def test_only_the_loads_period_is_read(spark, tmp_path):
    """The files of the other periods are gone, and the report does not miss them."""
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    load(spark, fact, some_lines(80, ["01-03", "02-04", "03-05"], 1), "day")
    rollups(spark, fact, state)
    load(spark, fact, some_lines(20, ["03-05"], 2), "day")
    wanted = tables(all_insights(read_fact(spark, fact)))
    for period in ("2011-01-03", "2011-02-04"):
        shutil.rmtree(f"{fact}/{fact_table.PERIOD}={period}")
    found = rollups(spark, fact, state)
    assert found.renewed == ("2011-03-05",) and tables(found.insights()) == wanted
    for frame in (found.invoices, found.products, found.days):
        assert all(f"{state}/" in file for file in frame.inputFiles())


def test_changed_rows_and_files_put_together(spark, tmp_path):
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    rows = [fact_row(row_hash=f"h{i}", invoice_date=utc("2011-01-05")) for i in range(3)]
    load(spark, fact, [rows[0], fact_row(row_hash="x", invoice_date=utc("2011-02-05"))])
    load(spark, fact, rows[1:])
    rollups(spark, fact, state)
    load(spark, fact, [fact_row(row_hash="h1", invoice_date=utc("2011-01-05"), revenue_eur=99.5)])
    found = rollups(spark, fact, state)
    assert found.renewed == ("2011-01",)
    assert found.insights()["headline_metrics"].first()["total_revenue"] == 3 * 11.7 + 99.5
    assert compact(spark, fact, small_files=1)
    again = rollups(spark, fact, state)
    assert again.renewed == ("2011-01",) and sorted_rows(again.invoices) == sorted_rows(found.invoices)


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    load(spark, fact, some_lines(20, ["01-03"], 1))
    rollups(spark, fact, state)
    load(spark, fact, some_lines(20, ["02-03"], 2))

    def die(*_):
        raise RuntimeError("driver died")

    with monkeypatch.context() as broken:
        broken.setattr(insight_state.snapshots, "commit", die)
        with pytest.raises(RuntimeError, match="died"):
            rollups(spark, fact, state)
    found = rollups(spark, fact, state)
    assert found.renewed == ("2011-02",) and found.invoices.agg({"lines": "sum"}).first()[0] == 40


def test_reports_beside_each_other_and_a_load_in_between(spark, tmp_path, monkeypatch):
    """A report that was overtaken begins anew: its roll-ups never replace newer ones."""
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    load(spark, fact, some_lines(20, ["01-03"], 1))
    write, overtaken = insight_state._write, []

    def overtake(*args):
        done = write(*args)
        if not overtaken:
            overtaken.append(True)
            load(spark, fact, some_lines(20, ["01-03"], 2))
            rollups(spark, fact, state)
        return done

    monkeypatch.setattr(insight_state, "_write", overtake)
    found = rollups(spark, fact, state)
    assert found.invoices.agg({"lines": "sum"}).first()[0] == 40
    assert snapshots.current(spark, state).number == 1
    assert len(list_names(spark, f"{state}/invoices/{fact_table.PERIOD}=2011-01")) == 2


def test_reports_at_the_same_time(spark, tmp_path):
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    load(spark, fact, some_lines(60, ["01-03", "02-03"], 1))
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(lambda _: rollups(spark, fact, state), range(3)))
    assert [f.invoices.agg({"lines": "sum"}).first()[0] for f in found] == [60, 60, 60]
