"""The stored fact: Parquet files by invoice period, under versions, loaded by upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.contracts import ContractViolation
from basketry.operators.upsert import INSERT, UPDATE, classify, deduplicate, upsert
from basketry.schemas import FACT, KEY
from basketry.session import (
    COMPRESSION, delete_path, dropping_shuffles, list_names, move_path, path_exists, run_scratch, stage,
)
from basketry.sources import key_filters, snapshots
from basketry.sources.snapshots import Change, StoredFile, Version

PERIOD = "invoice_period"
# Partition granularities; use days once a month of lines outgrows a comfortable rewrite.
PERIOD_FORMATS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}
# Files of a period that are smaller than half of this are put together once there are so many of them.
FILE_BYTES, SMALL_FILES = 256 * 1024 * 1024, 16
# How often a load begins anew because another one was first in the same periods.
_ATTEMPTS = 20

_STORED = T.StructType(FACT.fields + [T.StructField(PERIOD, T.StringType())])
_FILE = "_file"
_LOAD = "load"


def period_of(grain: str) -> Column:
    return F.date_format("invoice_date", PERIOD_FORMATS[grain])


def _root(path: str) -> str:
    return path.rstrip("/")


def read_files(spark: SparkSession, path: str, listed: list[StoredFile], with_file: bool = False) -> DataFrame:
    """The rows of some files; ``with_file`` adds which one each row is from, as it is listed."""
    names = _STORED.fieldNames()
    if not listed:
        none = spark.createDataFrame([], _STORED)
        return none.withColumn(_FILE, F.lit(None).cast("string")) if with_file else none
    paths = [f"{_root(path)}/{f.file}" for f in listed]
    rows = spark.read.schema(_STORED).option("basePath", _root(path)).parquet(*paths)
    own = F.substring_index("_metadata.file_path", "/", -3)  # period, load and name
    return rows.select(*names, own.alias(_FILE)) if with_file else rows.select(*names)


def stored_files(spark: SparkSession, path: str) -> list[StoredFile]:
    """The data files of the newest version."""
    return snapshots.files(spark, _root(path), _current(spark, path))


def _current(spark: SparkSession, path: str) -> Version:
    version = snapshots.current(spark, _root(path))
    if not version.number and any(n.startswith(f"{PERIOD}=") for n in list_names(spark, path)):
        if not path_exists(spark, f"{_root(path)}/_versions"):
            raise ValueError(f"{path} holds a fact without versions: load it anew into another folder")
    return version


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact as of its newest version, empty before the first load. Filter on ``invoice_period`` to prune partitions.

    Loads that commit later do not change what is read, as long as not more of them follow than versions are kept.
    """
    return read_files(spark, path, stored_files(spark, path))


def stored_mark(spark: SparkSession, path: str) -> int | None:
    """How far the feed was loaded when the newest version was committed, in microseconds."""
    return snapshots.current(spark, _root(path)).mark


def _laid_out(rows: DataFrame) -> DataFrame:
    """Few files for each period, a period that is too large for one task split over many. Ordering by time gives row
    groups narrow ranges of dates, which the next load skips."""
    return rows.select(*_STORED.fieldNames()).hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, "invoice_date")


def _write(spark: SparkSession, path: str, rows: DataFrame) -> list[StoredFile]:
    """Write rows, laid out as they are, by period as new files, which belong to no version yet. A load writes to a folder of its own first, as writers to
    one folder would clear away each other's work; then each period's files are moved as one.
    """
    root, load = _root(path), uuid.uuid4().hex
    incoming = f"{root}/_incoming/{load}"
    with dropping_shuffles(spark):
        rows.select(*_STORED.fieldNames()).write.partitionBy(PERIOD).parquet(incoming, compression=COMPRESSION)
    folders = [n for n in list_names(spark, incoming) if n.startswith(f"{PERIOD}=")]
    for name in folders:
        move_path(spark, f"{incoming}/{name}", f"{root}/{name}/{_LOAD}={load}")
    delete_path(spark, incoming)
    if not folders:
        return []
    new = spark.read.schema(_STORED).option("basePath", root).parquet(*[f"{root}/{n}/{_LOAD}={load}" for n in folders])
    found = new.groupBy(PERIOD, F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size")).agg(
        F.count("*").alias("n"), F.min(F.unix_micros("invoice_date")).alias("first"),
        F.max(F.unix_micros("invoice_date")).alias("last"),
    )
    added = [
        StoredFile(f"{PERIOD}={r[PERIOD]}/{_LOAD}={load}/{r['name']}", r[PERIOD], r["n"], r["size"], r["first"], r["last"])
        for r in found.collect()
    ]
    _write_filters(spark, root, load, added)
    return added


# New rows are laid out some periods at a time, at most so many times, if there are more of them than this for each.
_PASSES, _PASS_ROWS = 6, 4_000_000


def _passes(found: list[Row], passes: int = _PASSES, rows: int = _PASS_ROWS) -> list[tuple[int, int]]:
    """Ranges of time of neighbouring periods, in microseconds, of about as many rows each; no period is in two of them.

    ``found``: number of rows, first and last time of each period of a batch, in order.
    """
    total = sum(r["n"] for r in found)
    wanted = min(passes, -(-total // rows))
    ranges: dict[int, tuple[int, int]] = {}
    before = 0
    for r in found:
        at = (2 * before + r["n"]) * wanted // (2 * total)  # where the middle of the period falls
        ranges[at] = (ranges[at][0] if at in ranges else r["first"], r["last"])
        before += r["n"]
    return list(ranges.values())


def _write_new(spark: SparkSession, path: str, rows: DataFrame, found: list[Row]) -> list[StoredFile]:
    """Lay out and write staged rows with the periods ``found``; the shuffle on disk is that of one pass only."""
    ranges = _passes(found)
    moment = lambda micros: F.timestamp_micros(F.lit(micros))
    added = []
    for first, last in ranges:
        within = F.col("invoice_date").between(moment(first), moment(last))
        added += _write(spark, path, _laid_out(rows.filter(within) if len(ranges) > 1 else rows))
    return added


def _keys_path(root: str, load: str) -> str:
    return f"{root}/_keys/{_LOAD}={load}"


def _load_of(file: str) -> str:
    return file.split(f"/{_LOAD}=")[1].split("/")[0]


def _write_filters(spark: SparkSession, root: str, load: str, added: list[StoredFile]) -> None:
    """A Bloom filter of the keys of each new file."""
    rows = read_files(spark, root, added, with_file=True)
    words = spark.createDataFrame([(f.file, key_filters.words_for(f.rows)) for f in added], "file string, words long")
    filters = key_filters.build(rows, _FILE, key_filters.key_hash(*KEY), words)
    with dropping_shuffles(spark):
        filters.write.parquet(_keys_path(root, load))


def _that_may_hold(spark: SparkSession, path: str, near: list[StoredFile], batch: DataFrame, grain: str) -> list[StoredFile]:
    """Of files whose times overlap those of a batch, the ones that may hold a key of it.

    A line is asked for only where its own time lies in the file's; files are told apart by time, so that is in few
    of them. The list of files is broadcast: as many rows as the driver holds.
    """
    root = _root(path)
    listed = spark.createDataFrame(
        [(f.file, f.period, f.first, f.last, key_filters.words_for(f.rows)) for f in near],
        f"file string, {PERIOD} string, first long, last long, words long",
    )
    at = F.unix_micros("invoice_date")
    lines = batch.select(period_of(grain).alias(PERIOD), at.alias("at"), key_filters.key_hash(*KEY).alias("h"))
    asked = lines.join(F.broadcast(listed), PERIOD).filter(F.col("at").between(F.col("first"), F.col("last")))
    filters = key_filters.read(spark, sorted({_keys_path(root, _load_of(f.file)) for f in near}))
    found = {r["file"] for r in key_filters.may_hold(asked, filters).collect()}
    return [f for f in near if f.file in found]


def _check_grain(listed: list[StoredFile], grain: str) -> None:
    """One table has one granularity: periods of another one would hide its rows from the match."""
    if listed and len(listed[0].period) != len(PERIOD_FORMATS[grain]):
        raise ValueError(f"the stored fact is not partitioned by {grain}, it has the period {listed[0].period}")


# With more periods than this the rows of a batch's files are not narrowed down to its time ranges.
_MAX_RANGES = 100


def _may_match(listed: list[StoredFile], found: list[Row]) -> list[StoredFile]:
    """Files of the batch's own periods whose times overlap those the batch has in the period."""
    ranges = {r[PERIOD]: (r["first"], r["last"]) for r in found}
    return [
        f for f in listed if f.period in ranges and f.first <= ranges[f.period][1] and ranges[f.period][0] <= f.last
    ]


# Repeated keys of a batch whose hashes are broadcast; with more of them all its rows are combined by key.
_MANY_REPEATED = 1_000_000


def one_row_per_key(batch: DataFrame, many: int = _MANY_REPEATED) -> DataFrame:
    """``deduplicate`` of a staged batch, for which only 8-byte hashes of its keys and the rows of repeated ones are shuffled.

    A hash that is there once belongs to a key that is there once, so its row stays as it is. A batch with many
    repeated keys, which would not fit a broadcast, is combined by key as a whole. What was combined is staged: the
    rows are read once for each pass that writes them.
    """
    counted = batch.groupBy(key_filters.key_hash(*KEY).alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counted.filter("n > 1").select("_hash"), "repeated", packed=True)
    found = repeated.count()
    if not found:
        return batch.select(*FACT.fieldNames())
    if found > many:
        return stage(deduplicate(batch), "combined", packed=True)
    hashed = batch.withColumn("_hash", key_filters.key_hash(*KEY))
    alone = hashed.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    together = hashed.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")
    return alone.select(*FACT.fieldNames()).unionByName(stage(deduplicate(together), "combined", packed=True))


def upsert_into(
    spark: SparkSession, path: str, batch: DataFrame, grain: str = "month", mark: int | None = None
) -> dict[str, int]:
    """Upsert ``batch`` (stage it first: it is read several times) into the stored fact, as one version.

    The invoice time is part of the row hash, so equal keys share their time and period (but for
    collisions of the 48-bit hash within one invoice, product and customer). Only files of the batch's
    own periods whose times overlap the batch's can hold a match, for a batch newer than the mark none; of
    these, only files whose key filter knows a key of the batch are read.

    * nothing stored there: the deduplicated batch is added;
    * matches, none changed (a replay): only new keys are added;
    * changed rows: the files that hold them are replaced by new ones.

    All of it, with ``mark`` (how far the feed is loaded, in microseconds), becomes visible at once. A crash before leaves files
    that belong to no version. Two loads may run at a time: the second to commit goes on top of the first, and if both
    touch a period, it is worked out anew. A stored key that occurs twice fails the load.
    """
    period = period_of(grain)
    # At most one row per calendar day, and one for undated rows. Days are cheaper to tell than names of periods.
    days = batch.groupBy(F.to_date("invoice_date")).agg(
        F.count(F.lit(1)).alias("n"), F.min("invoice_date").alias("invoice_date"), F.max("invoice_date").alias("last")
    )
    found = (
        days.groupBy(period.alias(PERIOD))
        .agg(F.sum("n").alias("n"), F.min("invoice_date").alias("first"), F.max("last").alias("last"))
        .select(PERIOD, "n", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"))
        .orderBy(PERIOD)
        .collect()
    )
    records = sum(row["n"] for row in found)
    if not records:
        return {"records": 0, "upserted": 0, "modified": 0}
    if found[0][PERIOD] is None:
        raise ContractViolation(f"invoice_date is missing in {found[0]['n']} rows")

    def change_from(base: Version) -> tuple[Change, dict[str, int]]:
        listed = snapshots.files(spark, _root(path), base)
        _check_grain(listed, grain)
        near = _may_match(listed, found)
        # Rows added as they are may repeat a key, which shows only if all files that may hold it are read.
        if near and not any(f.as_given for f in near):
            near = _that_may_hold(spark, path, near, batch, grain)
        if near:
            with run_scratch(spark, "upsert"):
                change, counts = _merged(spark, path, near, batch, found, grain)
        else:
            with run_scratch(spark, "add"):
                rows = one_row_per_key(batch).withColumn(PERIOD, period)
                change = Change(_write_new(spark, path, rows, found))
            counts = {"upserted": sum(f.rows for f in change.added), "modified": 0}
        change.periods, change.mark = frozenset(r[PERIOD] for r in found), mark
        return change, counts

    counts = _committed(spark, path, change_from)
    compact(spark, path, {r[PERIOD] for r in found})
    return {"records": records, **counts}


def _forgetting(spark: SparkSession, path: str) -> Callable[[set[str]], None]:
    """Drop the filters of loads of which no version has a file any more."""

    def forget(expired: set[str]) -> None:
        kept = {_load_of(f) for f in snapshots.kept_files(spark, _root(path), _current(spark, path))}
        for load in {_load_of(f) for f in expired} - kept:
            delete_path(spark, _keys_path(_root(path), load))

    return forget


def _discard(spark: SparkSession, path: str, change: Change) -> None:
    """Delete what was written for a change that was not committed."""
    snapshots.discard(spark, _root(path), change)
    for load in {_load_of(f.file) for f in change.added}:
        delete_path(spark, _keys_path(_root(path), load))


def _committed(spark: SparkSession, path: str, change_from: Callable[[Version], tuple[Change, dict]]) -> dict[str, int]:
    """Work a change out and commit it, anew as often as another load was first in its periods."""
    for _ in range(_ATTEMPTS):
        base = _current(spark, path)
        change, counts = change_from(base)
        moves = change.mark is not None and (base.mark is None or change.mark > base.mark)
        if change.is_empty() and not moves:
            return counts
        if snapshots.commit(spark, _root(path), base, change, _forgetting(spark, path)):
            return counts
        _discard(spark, path, change)
    raise RuntimeError(f"other loads were first in the same periods of {path} {_ATTEMPTS} times")


def _merged(
    spark: SparkSession, path: str, near: list[StoredFile], batch: DataFrame, found: list[Row], grain: str
) -> tuple[Change, dict[str, int]]:
    """New keys and changed rows as new files, in place of the files that hold what changed; neither for a replay."""
    period = period_of(grain)
    target = read_files(spark, path, near, with_file=True)
    if len(found) <= _MAX_RANGES:
        moment = lambda micros: F.timestamp_micros(F.lit(micros))
        ranges = [F.col("invoice_date").between(moment(r["first"]), moment(r["last"])) for r in found]
        target = target.filter(reduce(or_, ranges))
    changes = classify(target, batch, unique_target=True, carry=(_FILE,)).filter(F.col("_change").isin(INSERT, UPDATE))
    changes = stage(changes.withColumn(PERIOD, period), "changes", packed=True)
    by_file = {(r["_change"], r[_FILE]): r["count"] for r in changes.groupBy("_change", _FILE).count().collect()}
    counts = {kind: sum(n for (k, _), n in by_file.items() if k == kind) for kind in (INSERT, UPDATE)}
    dirty = {file for kind, file in by_file if kind == UPDATE}
    rows = changes.filter(F.col("_change") == INSERT).select(*_STORED.fieldNames())
    if dirty:
        held = read_files(spark, path, [f for f in near if f.file in dirty])
        rows = upsert(held, changes.filter(F.col("_change") == UPDATE)).withColumn(PERIOD, period).unionByName(rows)
    change = Change(_write(spark, path, _laid_out(rows)) if by_file else [], sorted(dirty))
    return change, {"upserted": counts[INSERT], "modified": counts[UPDATE]}


def append_rows(spark: SparkSession, path: str, rows: DataFrame, grain: str = "month") -> None:
    """Add rows as they are, without looking for their keys."""

    def change_from(base: Version) -> tuple[Change, dict]:
        _check_grain(snapshots.files(spark, _root(path), base), grain)
        added = _write(spark, path, _laid_out(rows.withColumn(PERIOD, period_of(grain))))
        return Change([replace(f, as_given=True) for f in added]), {}

    _committed(spark, path, change_from)


def _bins(small: list[StoredFile], file_bytes: int) -> list[list[StoredFile]]:
    """Neighbours in time that together make a file of the wanted size at most."""
    bins: list[list[StoredFile]] = []
    for f in small:
        if bins and bins[-1][0].period == f.period and sum(b.bytes for b in bins[-1]) + f.bytes <= file_bytes:
            bins[-1].append(f)
        else:
            bins.append([f])
    return [b for b in bins if len(b) > 1]


def compact(
    spark: SparkSession,
    path: str,
    periods: set[str] | None = None,
    file_bytes: int = FILE_BYTES,
    small_files: int = SMALL_FILES,
) -> int:
    """Put small files of a period together once it has more than ``small_files`` of them; how many went.

    Rows stay as they are, and so do readers: it is a version like any other. If a load was first in one of these
    periods, nothing happens; the next one finds the files again.
    """
    base = _current(spark, path)
    by_period: dict[str, list[StoredFile]] = {}
    for f in snapshots.files(spark, _root(path), base):
        if f.bytes < file_bytes / 2 and (periods is None or f.period in periods):
            by_period.setdefault(f.period, []).append(f)
    bins = _bins([f for small in by_period.values() if len(small) > small_files for f in small], file_bytes)
    if not bins:
        return 0
    old = [f for b in bins for f in b]
    # One range of numbers for each bin, so no two of them become one file.
    number = {f.file: at for at, b in enumerate(bins) for f in b}
    numbers = spark.createDataFrame(list(number.items()), f"{_FILE} string, _bin int")
    rows = read_files(spark, path, old, with_file=True).join(F.broadcast(numbers), _FILE)
    laid_out = rows.repartitionByRange(len(bins), "_bin").sortWithinPartitions(PERIOD, "invoice_date")
    given = {f.period for f in old if f.as_given}
    added = [replace(f, as_given=f.period in given) for f in _write(spark, path, laid_out)]
    change = Change(added, [f.file for f in old], frozenset(f.period for f in old))
    if sum(f.rows for f in added) != sum(f.rows for f in old):
        _discard(spark, path, change)
        raise RuntimeError(f"putting files of {path} together would have changed the number of rows")
    if snapshots.commit(spark, _root(path), base, change, _forgetting(spark, path)) is None:
        _discard(spark, path, change)
        return 0
    return len(old)
