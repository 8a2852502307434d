"""Order MinHash: fingerprints that follow a text's edit distance, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import texts

#: Words of a k-mer; k-mers of a tuple; tuples of a fingerprint (a power of two).
K, TUPLE, TUPLES = 3, 2, 32
#: Words are cut into pieces of so many characters at most, so text without white space has k-mers too.
PIECE = 16
#: Ranges of ids for each shuffle partition.
RANGES_PER_PARTITION = 4
#: The driver holds no more bounds than this, and a row is placed by two searches over the square root of it.
MAX_RANGES = 20_000


def _kmers(words: Column, k: int) -> Column:
    """Hashes of ``k`` neighbouring words, in text order; of fewer words, of all together."""
    after = lambda i, n: F.get(words, i + n)  # noqa: E731  null past the end, which a hash skips
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[after(i, n) for n in range(1, k)]))
    n = F.size(words)
    return F.slice(hashes, F.lit(1), F.greatest(n - (k - 1), F.least(n, F.lit(1))))


def add_fingerprints(
    df: DataFrame, columns: dict[str, str], k: int = K, size: int = TUPLE, tuples: int = TUPLES
) -> DataFrame:
    """Add a fingerprint (array of long, ``tuples`` of them) for each text column: ``{text column: new column}``.

    The k-mers of a text are numbered by occurrence, and hashed with that number into one order. Each tuple starts
    elsewhere in that order, at equal steps, and takes the ``size`` k-mers that come next, round the end: the minimal
    ones under a hash of its own. It hashes them in the order in which the text has them, so that moved passages,
    and not only missing ones, tell texts apart. Equal texts have equal fingerprints.

    Null or empty text: no k-mers, a fingerprint all such texts share. Fewer k-mers than a tuple takes: all of
    them. Nothing is shuffled; a task holds the k-mers of one text.
    """
    bits = 64 - (tuples.bit_length() - 1)  # what is left of an order value beside its tuple
    name = lambda c, step: f"{columns[c]}__{step}"
    col = lambda c, step: F.col(f"`{name(c, step)}`")
    steps = []

    def add(step, make):
        nonlocal df
        df = df.withColumns({name(c, step): make(c) for c in columns})
        steps.append(step)

    pattern = F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}")
    add("words", lambda c: F.regexp_extract_all(F.coalesce(F.col(f"`{c}`"), F.lit("")), pattern, F.lit(0)))
    add("kmers", lambda c: _kmers(col(c, "words"), k))
    add("sorted", lambda c: F.sort_array(
        F.transform(col(c, "kmers"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ))

    def alone(c):
        own = col(c, "sorted")
        return lambda e, j: ~(
            F.get(own, j - 1)["h"].eqNullSafe(e["h"]) | F.get(own, j + 1)["h"].eqNullSafe(e["h"])
        )

    add("single", lambda c: F.filter(col(c, "sorted"), alone(c)))
    add("repeated", lambda c: F.when(F.size(col(c, "single")) == F.size(col(c, "sorted")), F.slice(
        col(c, "sorted"), 1, 0
    )).otherwise(F.filter(col(c, "sorted"), lambda e, j: ~alone(c)(e, j))))
    # Where each repeated k-mer begins in that list.
    add("begins", lambda c: F.filter(
        F.transform(col(c, "repeated"), lambda e, j: F.when(
            ~F.get(col(c, "repeated"), j - 1)["h"].eqNullSafe(e["h"]), j
        )), lambda j: j.isNotNull(),
    ))

    def numbered(c):
        rows, begins = col(c, "repeated"), col(c, "begins")
        run = lambda b, q: F.slice(rows, b + 1, F.coalesce(F.get(begins, q + 1), F.size(rows)) - b)
        number = lambda e, o: F.struct(
            F.when(o == 0, e["h"]).otherwise(F.xxhash64(e["h"], o)).alias("h"), e["i"].alias("i")
        )
        return F.flatten(F.transform(begins, lambda b, q: F.transform(run(b, q), number)))

    add("order", lambda c: F.when(F.size(col(c, "repeated")) == 0, col(c, "sorted")).otherwise(
        F.sort_array(F.concat(col(c, "single"), numbered(c)))
    ))
    at = lambda e: F.shiftright(e["h"], bits) + tuples // 2  # noqa: E731  the tuple an order value falls to
    # Whatever a tuple takes is among the first of some range of the order.
    add("first", lambda c: F.filter(
        col(c, "order"), lambda e, j: (j < size) | (at(F.get(col(c, "order"), j - size)) < at(e))
    ))
    add("round", lambda c: F.concat(col(c, "first"), col(c, "first")))

    def tuple_hash(c):
        first, ring = col(c, "first"), col(c, "round")
        begin = lambda b: F.when(F.size(first) == size * tuples, b * size).otherwise(
            F.size(F.filter(first, lambda e: at(e) < b))
        )
        taken = lambda b: F.slice(ring, begin(b) + 1, F.least(F.size(first), F.lit(size)))
        in_text = lambda b: F.sort_array(
            F.transform(taken(b), lambda e: F.struct(e["i"].alias("i"), e["h"].alias("h")))
        )
        mix = lambda b: F.aggregate(in_text(b), F.lit(42).cast("long"), lambda acc, e: F.xxhash64(acc, e["h"]))
        return F.transform(F.sequence(F.lit(0), F.lit(tuples - 1)), lambda b: mix(b).bitwiseAND(F.lit(0xFFFFFFFF)))

    df = df.withColumns({columns[c]: tuple_hash(c) for c in columns})
    return df.drop(*[name(c, step) for c in columns for step in steps])


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits for each tuple."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """Share of equal tuples, 0 to 1."""
    return F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda same: same)) / F.size(left)


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``doc_id``, ``text`` and ``fingerprint`` (array of long) of each row.

    Null text: as empty. Null ids stay null; repeated rows: a row each; an empty table gives no rows; other columns
    are dropped, whatever their names.
    """
    return add_fingerprints(texts(df, id_column, text_column), {"text": "fingerprint"}, **options)


def with_next(df: DataFrame, id_column: str, *columns: str) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows in descending order of its id; after the last, the first.

    Ids are cut into ranges at quantiles, a few for each shuffle partition, which the driver gets as that many numbers.
    The first row of each range also goes, as a copy, to the end of the range before it in the order. So no range
    needs another one, and no task sees more than its own. Rows of one id are in order of ``columns``. Null ids come
    last. If no id is known, all rows are one range.
    """
    spark, key = df.sparkSession, F.col(id_column)
    ranges = min(MAX_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = [(i + 1) / ranges for i in range(ranges)]
    quantiles = df.agg(F.percentile_approx(key, wanted, 10 * ranges)).first()[0]
    bounds = sorted(set(quantiles or []))
    order = [F.col("is_copy"), key.desc_nulls_last(), *[F.col(c) for c in columns]]
    if bounds:
        width = max(1, int(len(bounds) ** 0.5))
        rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
        fine = F.array(*[F.array(*map(F.lit, row)) for row in rows]).cast("array<array<bigint>>")
        ends = F.array(*[F.lit(row[-1]) for row in rows]).cast("array<bigint>")
        below = lambda bound: bound < key
        outer = F.size(F.filter(ends, below))
        # Two short searches instead of one long one. A null id is below nothing: the lowest range.
        inner = F.size(F.filter(F.get(fine, F.col("outer")), below))
        placed = df.withColumn("outer", F.coalesce(outer, F.lit(0))).withColumn("inner", F.coalesce(inner, F.lit(0)))
        own = F.col("outer") * width + F.col("inner")
        first = F.get(F.get(fine, F.col("outer")), F.col("inner")).eqNullSafe(key)
        mark = lambda at, copy: F.struct(at.alias("range"), F.lit(copy).alias("is_copy"))
        before = F.pmod(own + 1, F.lit(len(bounds)))
        places = F.when(first, F.array(mark(own, False), mark(before, True))).otherwise(F.array(mark(own, False)))
        placed = placed.withColumn("place", F.explode(places)).select(*df.columns, "place.*")
    else:
        placed = df.withColumns({"range": F.lit(0), "is_copy": F.lit(False)})
    window = Window.partitionBy("range").orderBy(*order)
    following = F.struct(*columns)
    after = placed.withColumn("following", F.coalesce(F.lead(following).over(window), F.first(following).over(window)))
    return after.filter(~F.col("is_copy")).select(
        *df.columns, *[F.col(f"following.{c}").alias(f"next_{c}") for c in columns]
    )
