"""URL filters: host and path rules, and a character model ratio for what no rule fits."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import bounded_slices, quoted, ship_package
from basketry.session import stage

#: Characters of context, at most.
ORDER = 4
#: A gram that stands at one of so many places or more is hot: its value is sent to all tasks, so they are as many at most.
HOT = 1 << 14
#: Values of grams are whole multiples of this, so that sums do not depend on the order of rows.
UNIT = 2.0**-36
#: Weight of the shorter context's estimate, in characters.
SMOOTHING = 3.0
#: Size of the alphabet the shortest estimate falls back on.
ALPHABET = 256
#: Calibration counts scores in steps of this width, from -LIMIT to LIMIT.
STEP, LIMIT = 0.01, 8.0
_START, _END = "\x02", "\x03"

#: (verdict, host, path) of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case; null: empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits; null where none does.

    A rule fits its host and all subdomains, for paths that start with its path. Rules are a short fixed list.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        mark = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, mark).otherwise(found)
    return found


def grams(url: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: contexts, and contexts with the character that follows, at every place."""
    text = _START + url + _END
    out = []
    for order in range(ORDER + 1):
        full = [text[max(0, i - order) : i + 1] for i in range(1, len(text))]
        out.append((np.array([g[:-1] for g in full], object), np.array(full, object)))
    return out


def _longest(url: str) -> list[str]:
    """At every place the longest context with the character that follows; those of shorter orders are its ends."""
    text = _START + url + _END
    return [text[max(0, i - ORDER) : i + 1] for i in range(1, len(text))]


def _of_order(order: int) -> Column:
    return F.right("gram", F.lit(order + 1))


def _context(gram: Column) -> Column:
    return F.left(gram, F.length(gram) - 1)


@dataclass(frozen=True)
class UrlModel:
    """Every ``gram`` of the longest order with its counts in both classes, ``n0`` (accepted) and ``n1`` (rejected).

    A stored table, as large as the corpus makes it. Shorter orders are sums of it. And the threshold.
    """

    counts: DataFrame
    threshold: float = 0.0

    def ratio(self, url: str, own: int | None = None) -> float:
        """Difference of the log-likelihoods, per character. ``own``: the class this URL itself was counted in.

        For one URL, by its own query of the counts; ``judge_urls`` is for tables.
        """
        at = grams(url)
        wanted = sorted({f"{order}{c}" for order, (contexts, _) in enumerate(at) for c in contexts})
        levels = F.array(*[F.struct(F.lit(order).alias("order"), _of_order(order).alias("gram")) for order in range(ORDER + 1)])
        rows = self.counts.select(F.explode(levels).alias("l"), "n0", "n1").select("l.order", "l.gram", "n0", "n1")
        rows = rows.filter(F.concat(F.col("order").cast("string"), _context(F.col("gram"))).isin(wanted))
        both, seen = Counter(), Counter()
        for r in rows.groupBy("order", "gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
            for kind, n in enumerate((r["n0"], r["n1"])):
                both[kind, r["order"], r["gram"]] += n
                seen[kind, r["order"], r["gram"][:-1]] += n
        logs = [0.0, 0.0]
        for kind in (0, 1):
            out = 1 if own == kind else 0  # a counted URL is judged by the others
            for i in range(len(at[0][0])):
                p = 1.0 / ALPHABET
                for order, (context, full) in enumerate(at):
                    total = max(seen[kind, order, context[i]] - out, 0)
                    p = (min(max(both[kind, order, full[i]] - out, 0), total) + SMOOTHING * p) / (total + SMOOTHING)
                logs[kind] += math.log(p)
        return (logs[0] - logs[1]) / len(at[0][0])


def _count(urls: DataFrame) -> DataFrame:
    """``gram``, ``n0``, ``n1``, ``places`` of ``url``, ``kind`` (0, 1 or null) rows; combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, 0):
                found = {}
                for url, kind in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found.setdefault(kind, Counter()).update(_longest(url))
                for kind, counts in found.items():
                    n = pa.array(counts.values(), pa.int64())
                    kinds = pa.array([kind] * len(counts), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), kinds, n], ["gram", "kind", "n"])

    parts = urls.select("url", F.col("kind").cast("int").alias("kind")).mapInArrow(run, "gram string, kind int, n long")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    return parts.groupBy("gram").agg(of(0).alias("n0"), of(1).alias("n1"), F.sum("n").alias("places"))


def _values(counted: DataFrame, own: bool) -> DataFrame:
    """``gram``, ``places``, ``value`` of the grams that have places: the log-ratio at such a place, in units.

    ``value`` is an array: one ratio, or with ``own`` those of a URL counted in class 0 and in class 1. The estimate of
    each order is joined to the grams of the next by their ends, so a key has no more rows than the alphabet.
    """
    values = None
    for order in range(ORDER + 1):
        level = counted.groupBy(_of_order(order).alias("gram")).agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("places").alias("places")
        )
        around = Window.partitionBy(_context(F.col("gram")))  # as many rows as the alphabet, at most
        level = level.withColumns({f"seen{kind}": F.sum(f"n{kind}").over(around) for kind in (0, 1)})
        if values is None:
            level = level.withColumns({c: F.lit(1.0 / ALPHABET) for c in ("p0", "p1", "own0", "own1")})
        else:
            shorter = values.select(F.col("gram").alias("shorter"), "p0", "p1", "own0", "own1")
            level = level.withColumn("shorter", _of_order(order - 1)).join(shorter, "shorter")
        estimates = {}
        for kind in (0, 1):
            for name, out in (("p", 0), ("own", 1)):
                seen = F.greatest(F.col(f"seen{kind}") - out, F.lit(0))
                both = F.least(F.greatest(F.col(f"n{kind}") - out, F.lit(0)), seen)
                estimates[f"{name}{kind}"] = (both + SMOOTHING * F.col(f"{name}{kind}")) / (seen + SMOOTHING)
        values = level.select("gram", "places", *[e.alias(c) for c, e in estimates.items()])
    ratio = lambda a, b: F.round((F.log(a) - F.log(b)) / UNIT).cast("long")
    pairs = [("own0", "p1"), ("p0", "own1")] if own else [("p0", "p1")]
    return values.filter("places > 0").select("gram", "places", F.array(*[ratio(a, b) for a, b in pairs]).alias("value"))


def _ratios(rows: DataFrame, counted: DataFrame, own: bool) -> DataFrame:
    """``rows`` with ``ratio``. ``url``; ``kind``: index of the value to take; ``counted`` has all their grams.

    Hot grams are looked up where the URL lies. The others, no one of which has more than one of ``HOT`` places, are
    joined to the values and summed by URL.
    """
    spark = rows.sparkSession
    values = stage(_values(counted, own), "url_values")
    total = values.agg(F.sum("places")).first()[0] or 0
    is_hot = F.col("places") * HOT >= F.lit(total)
    shared = spark.sparkContext.broadcast({r["gram"]: r["value"] for r in values.filter(is_hot).collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            for part in bounded_slices(batch, 0):
                known, others, sizes = [], [], []
                for url, kind in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own_grams = _longest(url)
                    sizes.append(len(own_grams))
                    known.append(sum(hot[g][kind] for g in own_grams if g in hot))
                    others.append([g for g in own_grams if g not in hot])
                more = [pa.array(known, pa.int64()), pa.array(others, pa.list_(pa.string())), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "known", "others", "size"])

    kept = [c for c in rows.columns if c not in ("url", "kind")]
    rows = rows.select("url", F.col("kind").cast("int").alias("kind"), *kept)
    # Repeated rows are rows of their own, so a number tells them apart; it is written once.
    rows = rows.withColumn("row_number", F.monotonically_increasing_id())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    looked_up = stage(rows.mapInArrow(run, f"{kinds}, known long, others array<string>, size long"), "url_rows")
    open_grams = looked_up.select("row_number", "kind", F.explode("others").alias("gram"))
    found = open_grams.join(values.filter(~is_hot).select("gram", "value"), "gram")
    sums = found.groupBy("row_number").agg(F.sum(F.get("value", F.col("kind"))).alias("joined"))
    ratio = (F.col("known") + F.coalesce("joined", F.lit(0))) * UNIT / F.col("size")
    return looked_up.join(sums, "row_number", "left").select("url", "kind", *kept, ratio.alias("ratio"))


def train(urls: DataFrame, url_column: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> UrlModel:
    """Models of what the rules accept and reject, from every URL that a rule fits, counted gram by gram.

    The threshold is the ratio at which both classes lose the same share, each URL judged without its own counts.
    If a class has no URL, the ratio is 0 and everything without a rule is allowed.
    """
    ship_package(urls.sparkSession)
    url = F.coalesce(quoted(url_column), F.lit(""))
    judged = urls.select(url.alias("url")).withColumn("fit", fitting_rule(host_of(F.col("url")), path_of(F.col("url"))))
    judged = judged.filter("fit is not null").select("url", (F.col("fit.verdict") == "block").cast("int").alias("kind"))
    counted = stage(_count(judged), "url_counts")
    counts = counted.select("gram", "n0", "n1")
    seen = counts.agg(F.sum("n0"), F.sum("n1")).first()
    if not all(seen):
        return UrlModel(counts.filter(F.lit(False)))
    steps = F.round(F.least(F.greatest(F.col("ratio"), F.lit(-LIMIT)), F.lit(LIMIT)) / STEP).cast("int")
    rows = _ratios(judged, counted, True).groupBy("kind", steps.alias("step")).count().collect()  # at most 3,202
    of = {kind: sorted((r["step"], r["count"]) for r in rows if r["kind"] == kind) for kind in (0, 1)}
    total = {kind: sum(n for _, n in of[kind]) for kind in of}
    lost = lambda t: sum(n for s, n in of[0] if s < t) / total[0]
    passed = lambda t: sum(n for s, n in of[1] if s >= t) / total[1]
    edges = sorted({s for kind in of for s, _ in of[kind]})
    # Both shares are steps; among equally balanced thresholds the middle one.
    gaps = [(round(abs(lost(t) - passed(t)), 9), round(lost(t) + passed(t), 9)) for t in edges]
    best = [t for t, gap in zip(edges, gaps) if gap == min(gaps)]
    return UrlModel(counts, (best[0] + best[-1]) / 2 * STEP)


def judge_urls(
    df: DataFrame,
    model: UrlModel,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """Per row: ``page_id``, ``url``, ``host``, ``path``, ``rule``, ``ratio`` and ``verdict`` (allow or block).

    A rule that fits decides; the longest one of several. Else the ratio does: a URL is allowed from the threshold
    on. The grams of the URLs are counted and joined to the model, never gathered. Null url: empty, judged by the
    model. Null ids stay null; repeated rows are judged alike, a row each; an empty table gives no rows; other columns
    are dropped, whatever their names.
    """
    ship_package(df.sparkSession)
    rows = df.select(quoted(id_column).cast("long").alias("page_id"), F.coalesce(quoted(url_column), F.lit("")).alias("url"))
    asked = _count(rows.withColumn("kind", F.lit(None).cast("int"))).select("gram", "n0", "n1", "places")
    known = model.counts.select("gram", "n0", "n1", F.lit(0).cast("long").alias("places"))
    counted = known.union(asked).groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "places")])
    scored = _ratios(rows.withColumn("kind", F.lit(0)), stage(counted, "url_counts"), False)
    own = F.col("url")
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        scored.withColumns({"host": host_of(own), "path": path_of(own)}).withColumn("fit", fit)
        .select(
            "page_id", own.alias("url"), "host", "path", F.col("fit.rule").alias("rule"), "ratio",
            F.coalesce(
                "fit.verdict", F.when(F.col("ratio") >= F.lit(float(model.threshold)), "allow").otherwise("block")
            ).alias("verdict"),
        )
    )
