"""Personal data: what has its form, and the terms beside it that give it away by how they stand in the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import finished, quoted
from basketry.session import stage

#: Words on either side of an entity that are its context, and the letters a term has at least.
NEAR, LETTERS = 8, 3
#: Characters on either side in which those words are looked for.
NEAR_CHARS = 200
#: Different contexts in which a term has to stand beside an entity. Copies of a context are one.
CONTEXTS = 3
#: A term discloses an entity if it leaves at most so many bits of what the entity tells, and tells so many at least.
BITS_LEFT, BITS_TOLD = 1.0, 3.0
#: Letters that stay of a term that is generalised.
FAMILY = 3
#: Rows that are broadcast, at most; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Array elements that are summed in one go.
_BLOCK = 256

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# No match can begin inside a run that the one before it in the text went through, so a run is walked once, however
# long it is. Nothing is given back of a run where that cannot help.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheaper tests that a text with such a match passes.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_WORD = rf"\p{{L}}{{{LETTERS},}}"
_NO_ID = -(1 << 63)
_SPANS = "array<struct<start:int,kind:int,end:int,value:string,near:array<string>>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: a column inside a lambda may be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` makes of each array's first 1, 2, 3, ... numbers, a block at a time: appending copies an array."""
    def along(some: Column, start: Column) -> Column:
        def add(held: Column, x: Column) -> Column:
            last = step(held["last"], x)
            return F.struct(last.alias("last"), F.concat(held["all"], F.array(last)).alias("all"))

        first = F.struct(start.cast("long").alias("last"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(some, first, add, lambda held: held["all"])

    def blocks(v: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int"))
        return F.transform(at, lambda b: F.slice(v, b * _BLOCK + 1, _BLOCK))

    def joined(some: Column) -> Column:
        zero = F.lit(0).cast("long")
        totals = F.transform(some, lambda block: F.aggregate(block, zero, step))
        return _bind(
            F.struct(some.alias("some"), F.concat(F.array(zero), along(totals, zero)).alias("before")),
            lambda r: F.flatten(F.transform(r["some"], lambda block, b: along(block, F.get(r["before"], b)))),
        )

    longs = values.cast("array<bigint>")
    return F.when(F.size(longs) > 0, _bind(longs, lambda v: _bind(blocks(v), joined))).otherwise(
        F.array().cast("array<bigint>")
    )


def _matches(text: Column, pattern: str) -> Column:
    """All matches as structs of ``start``, ``end``, ``value``, ``before`` and ``after``, the texts up to the next ones."""
    row = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")
    )

    def placed(r: Column) -> Column:
        steps = F.zip_with(r["found"], F.slice(r["gaps"], 1, F.size(r["found"])), lambda f, g: F.length(f) + F.length(g))
        return _bind(
            F.struct(r["found"].alias("found"), r["gaps"].alias("gaps"), running(steps, lambda x, y: x + y).alias("ends")),
            lambda q: F.transform(q["found"], lambda f, i: F.struct(
                (F.get(q["ends"], i) - F.length(f)).cast("int").alias("start"),
                F.get(q["ends"], i).cast("int").alias("end"),
                f.alias("value"),
                F.right(F.get(q["gaps"], i), F.lit(NEAR_CHARS)).alias("before"),
                F.left(F.get(q["gaps"], i + 1), F.lit(NEAR_CHARS)).alias("after"),
            )),
        )

    return _bind(row, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass: every second one from the right is doubled, and its digits summed."""
    padded = F.lpad(digits, 19, "0")
    doubled = F.translate(padded, "123456789", "246813579")
    total = F.lit(0)
    for at in range(19):
        total = total + F.substring(padded if at % 2 == 0 else doubled, at + 1, 1).cast("int")
    return total % 10 == 0


_PASSES: dict[str, Callable[[Column], Column]] = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda value: F.when(F.length(_digits(value)).between(14, 19), _luhn(_digits(value))).otherwise(F.lit(False)),
    "phone": lambda value: F.length(_digits(value)).between(10, 15),
}


def _near(before: Column, after: Column) -> Column:
    """The words next to an entity, other addresses left out."""
    words = lambda side: F.regexp_extract_all(
        F.lower(F.regexp_replace(side, PATTERNS["email"], " ")), F.lit(_WORD), F.lit(0)
    )
    return F.array_union(F.slice(F.reverse(words(before)), 1, NEAR), F.slice(words(after), 1, NEAR))


def base_spans(text: Column) -> Column:
    """What has the form of personal data, by start, then kind, as an array of ``start``, ``kind`` (place in ``KINDS``),
    ``end``, ``value`` and ``near``. Leftmost matches of a kind do not overlap; what fails its test is left out."""
    none = F.array().cast(_SPANS)

    def of_kind(at: int, kind: str) -> Column:
        fine = F.filter(_matches(text, PATTERNS[kind]), lambda m: _PASSES[kind](m["value"]))
        spans = F.transform(fine, lambda m: F.struct(
            m["start"].alias("start"), F.lit(at).alias("kind"), m["end"].alias("end"), m["value"].alias("value"),
            _near(m["before"], m["after"]).alias("near"),
        ))
        return F.when(text.rlike(_HINTS[kind]), spans).otherwise(none)

    kinds = [of_kind(at, kind) for at, kind in enumerate(KINDS)]
    found = F.concat(*kinds)
    return F.when(text.rlike("[0-9@]"), F.sort_array(found)).otherwise(none)


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _entities(found: DataFrame) -> DataFrame:
    """A row for each span: ``row``, ``entity`` (what it names, however it is written), ``context`` and ``near``."""
    one = found.select("row", F.explode("spans").alias("s"))
    named = F.when(F.col("s.kind").isin(KINDS.index("card"), KINDS.index("phone")), _digits(F.col("s.value"))).otherwise(
        F.lower("s.value")
    )
    return one.select(
        "row", F.xxhash64("s.kind", named).alias("entity"), F.xxhash64("s.near").alias("context"), F.col("s.near").alias("near")
    )


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return df.hint("broadcast" if small else "shuffle_merge")


def _information(told: Column, left: Column) -> Column:
    return (told >= BITS_TOLD) & (left <= BITS_LEFT)


def _family(term: Column) -> Column:
    return F.concat(F.left(term, F.lit(FAMILY)), F.lit("*"))


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)))


def disclosing_terms(docs: DataFrame, found: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``term``, ``shown`` (what stands in its place), ``bits_told`` and ``bits_left``; ``None`` if nothing is disclosed.

    ``docs`` has the key columns and ``text``, ``found`` the staged ``row`` and ``spans``. With n the documents that hold an entity e, a
    term t, or t in the context of e, t tells PMI = log2(N n(e, t) / (n(e) n(t))) bits of the log2(N / n(e)) bits
    that e has. Where it tells nearly all of them it is generalised to its first letters; if these tell as much, it is removed.
    """
    entities = stage(_entities(found), "entities")
    beside = entities.select("row", "entity", "context", F.explode("near").alias("term"))
    pairs = beside.groupBy("entity", "term").agg(
        F.countDistinct("row").alias("n_both"), F.countDistinct("context").alias("contexts")
    )
    pairs = stage(pairs.filter(F.col("contexts") >= CONTEXTS).drop("contexts"), "pairs")
    terms = pairs.select("term").distinct()
    n_terms = terms.count()
    if not n_terms:
        return None
    words = docs.select(F.explode(_distinct_words(F.col("text"))).alias("term"))
    # Words are counted by task before any are joined: a frequent term would make a row for each text that has it.
    n_term = words.groupBy("term").agg(F.count("*").alias("n_term")).join(_sized(terms, n_terms <= broadcast_rows), "term")
    n_entity = entities.groupBy("entity").agg(F.countDistinct("row").alias("n_entity"))
    total = F.lit(float(docs.count()))
    told = F.log2(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    has = F.log2(total / F.col("n_entity"))
    known = pairs.join(n_term, "term").join(n_entity, "entity").withColumns({"bits_told": told, "bits_left": has - told})
    known = stage(known.filter(_information(F.col("bits_told"), F.col("bits_left"))), "disclosures")
    if known.isEmpty():
        return None

    # The same for the families of these terms.
    families = known.select("entity", _family(F.col("term")).alias("family")).distinct()
    starts = F.array_distinct(F.transform(_distinct_words(F.col("text")), _family))
    # Few letters make few families, so they are counted by task before any are joined.
    n_family = docs.select(F.explode(starts).alias("family")).groupBy("family").agg(F.count("*").alias("n_family"))
    n_both = beside.select("row", "entity", _family(F.col("term")).alias("family")).join(families, ["entity", "family"])
    n_both = n_both.groupBy("entity", "family").agg(F.countDistinct("row").alias("n_near"))
    wide = known.withColumn("family", _family(F.col("term"))).join(n_both, ["entity", "family"])
    wide = wide.join(n_family.hint("shuffle_merge"), "family")
    told = F.log2(total * F.col("n_near") / (F.col("n_entity") * F.col("n_family")))
    still = _information(told, F.log2(total / F.col("n_entity")) - told)
    # A term may disclose several entities: what is needed for one of them is done.
    judged = wide.groupBy("term").agg(
        F.when(F.max(still), F.lit(f"<{TERM}>")).otherwise(F.first("family")).alias("shown"),
        F.max("bits_told").alias("bits_told"), F.min("bits_left").alias("bits_left"),
    )
    return stage(judged, "terms")


def _term_spans(docs: DataFrame, terms: DataFrame, broadcast_rows: int) -> DataFrame:
    """``k1``, ``k2`` and ``terms``: where disclosing terms stand. Only texts that have one are placed word by word."""
    small = terms.count() <= broadcast_rows
    words = docs.select("k1", "k2", F.explode(_distinct_words(F.col("text"))).alias("term"))
    hits = words.join(_sized(terms.select("term", "shown"), small), "term")
    of_doc = stage(hits.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_set(F.struct("term", "shown"))).alias("shown")), "hits")
    some = docs.join(_sized(of_doc, of_doc.count() <= broadcast_rows), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    placed = _bind(
        F.struct(_matches(F.col("text"), _WORD).alias("words"), F.col("shown").alias("shown")),
        lambda r: F.filter(
            F.transform(r["words"], lambda w: F.struct(
                w["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), w["end"].alias("end"),
                F.element_at(r["shown"], F.lower(w["value"])).alias("value"), F.array().cast("array<string>").alias("near"),
            )),
            lambda s: s["value"].isNotNull(),
        ),
    )
    return some.select("k1", "k2", placed.cast(_SPANS).alias("terms"))


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with the shown form in place of each span; of spans that overlap, the later ones follow the first."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])

    def built(r: Column) -> Column:
        ends = running(F.transform(r["spans"], lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        return _bind(F.struct(r["text"].alias("text"), r["spans"].alias("spans"), ends.alias("ends")), pieces)

    def pieces(r: Column) -> Column:
        done = lambda i: F.when(i > 0, F.get(r["ends"], i - 1)).otherwise(F.lit(0)).cast("int")
        one = lambda s, i: F.concat(
            F.substring(r["text"], done(i) + 1, F.greatest(s["start"] - done(i), F.lit(0))),
            F.when(s["end"] > done(i), F.coalesce(F.get(names, s["kind"]), s["value"])).otherwise(F.lit("")),
        )
        rest = F.substring(r["text"], F.element_at(r["ends"], -1).cast("int") + 1, F.length(r["text"]))
        return F.concat(F.array_join(F.transform(r["spans"], one), ""), rest)

    row = F.struct(text.alias("text"), spans.alias("spans"))
    return F.when(F.size(spans) > 0, _bind(row, built)).otherwise(text)


def _docs(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of one id and one text are alike in all that matters here, so ``k1`` and ``k2`` tell rows apart."""
    text = F.coalesce(quoted(text_column), F.lit(""))
    return df.select(
        F.coalesce(quoted(id_column).cast("long"), F.lit(_NO_ID).cast("long")).alias("k1"),
        F.xxhash64(text).alias("k2"),
        text.alias("text"),
    )


def find_private(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``: what has the form of personal data, and the terms that disclose it, by start.

    A span has ``start`` and ``end`` (code points, end exclusive), ``kind`` (place in ``KINDS``; the next number for a term),
    ``value`` (what stands there; for a term what shall stand there) and ``near`` (the words beside it).

    Mail addresses, IP addresses, payment cards and phone numbers are found by form, and checked. A term
    is a word that stands beside the same entity in at least ``CONTEXTS`` different contexts, and of which the corpus says that whoever
    reads it knows the entity but for ``BITS_LEFT`` bits; it is marked wherever it stands. Exact copies of a context
    count once as evidence, so the words of a copied text are not held for terms.

    The texts are read up to five times and shuffled only if more than ``broadcast_rows`` of them hold a term; counts are combined before
    they are shuffled, distinct ones by the document too, so an entity in a third of all texts is spread. Terms are
    joined as a table; up to ``broadcast_rows`` of them are broadcast. Null and empty texts have no spans. Null ids
    stay null. Repeated rows are each a document. An empty table gives no rows; other columns are dropped,
    whatever their names. What is staged goes when the result is written.
    """
    def build() -> DataFrame:
        docs = _docs(df, id_column, text_column)
        found = docs.select("k1", "k2", base_spans(F.col("text")).alias("spans"))
        found = stage(found.withColumn("row", F.monotonically_increasing_id()), "spans")
        doc_id = F.when(F.col("k1") != _NO_ID, F.col("k1")).alias("doc_id")
        terms = disclosing_terms(docs, found.filter(F.size("spans") > 0), broadcast_rows)
        if terms is None:
            return found.select(doc_id, F.col("k2").alias("text_key"), "spans")
        both = found.join(_term_spans(docs, terms, broadcast_rows), ["k1", "k2"], "left")
        every = F.when(F.col("terms").isNull(), F.col("spans")).otherwise(F.sort_array(F.concat("spans", "terms")))
        return both.select(doc_id, F.col("k2").alias("text_key"), every.alias("spans"))

    return finished(df.sparkSession, "private", build)


def sanitise(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """All rows and columns of ``df``, personal data in the text replaced by its kind, disclosing terms by what
    ``disclosing_terms`` shows for them. Cases as in ``find_private``; a null text is empty."""
    spans = find_private(df, id_column, text_column, broadcast_rows)
    some = spans.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"]).select(
        F.coalesce("doc_id", F.lit(_NO_ID).cast("long")).alias("_k1"), F.col("text_key").alias("_k2"), F.col("spans").alias("_spans")
    )
    text = F.coalesce(quoted(text_column), F.lit(""))
    whole = df.select(
        F.struct(*[quoted(c) for c in df.columns]).alias("row"), text.alias("_text"),
        F.coalesce(quoted(id_column).cast("long"), F.lit(_NO_ID).cast("long")).alias("_k1"), F.xxhash64(text).alias("_k2"),
    )
    joined = whole.join(some, ["_k1", "_k2"], "left")
    clean = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(_sanitised(F.col("_text"), F.col("_spans")))
    return joined.select(F.col("row").withField("`" + text_column + "`", clean).alias("row")).select("row.*")
