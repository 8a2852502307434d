"""Secret scans: candidates by their shape, and a random forest that removes what only looks like a secret."""

from __future__ import annotations

import re
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, texts
from basketry.session import stage

#: Characters of context on either side.
CONTEXT = 48
#: Characters of a candidate, at least.
SHORTEST = 6
#: Words of the dictionary: the most frequent ones of the whole corpus. Its size is a limit by design.
DICTIONARY = 400
#: Labelled findings of each class that the forest is grown on, at most: those that hash lowest, copies left out.
SAMPLE_PER_CLASS = 4000
TREES, DEPTH, SEED = 15, 6, 7
MASK = "<secret>"

# Words that stand beside secrets, and beside what only looks like one.
SECRET_WORDS = "password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|bearer|auth"
OTHER_WORDS = "commit|checksum|sha1|sha256|md5|digest|uuid|example|sample|placeholder|dummy|isbn|revision"
_NAMED = rf"""(?:{SECRET_WORDS})["']?[ \t]{{0,3}}[:=][ \t]{{0,3}}["']?"""
_ENDS = r"""\s"'`,;&<>()\[\]{}|\\"""
#: After a secret's name and a sign: what stands in quotes; else a run that is more than a word, or any right after ``=``.
ASSIGNED = (
    rf"""(?<=[:=\s"'])(?<=[:=][ \t]{{0,3}}["']?)(?<=(?i:{_NAMED}))(?![:=])"""
    rf"""(?:(?<=["'])[^\s"'`]{{{SHORTEST},}}(?=["'])"""
    rf"""|(?:(?<==)|(?=[^{_ENDS}]*[0-9!@#$%^*_+~]))[^{_ENDS}]{{{SHORTEST - 1},}}[^{_ENDS}.:?])"""
)
#: A run of the characters keys are made of, but no secret's name; equals signs that a value follows are not its padding.
RUN = (
    r"""(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}+"""
    rf"""(?!(?<=(?i:{SECRET_WORDS}))["']?[ \t]{{0,3}}[:=][ \t]{{0,3}}[^\s=])"""
    r"""(?:={1,2}(?!["']?[^\s"',;:)\]}>&|.?#]))?"""
)
CANDIDATE = f"{ASSIGNED}|{RUN}"
#: Formats that are secrets beyond doubt.
KNOWN = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$"

FEATURES = (
    "length", "class_changes", "vowel_changes", "digits", "capitals", "distinct", "dictionary", "in_path",
    "secret_word", "other_word", "assigned",
)


def _share(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]", "")) / F.length(text)


def _changes(text: Column) -> Column:
    """Neighbouring characters that differ, of all neighbours."""
    return (F.length(F.regexp_replace(text, r"(.)\1+", "$1")) - 1) / F.greatest(F.length(text) - 1, F.lit(1))


def features(found: Column, before: Column, after: Column, dictionary: list[str]) -> Column:
    """The values of ``FEATURES``, as an array of double, for a candidate between two pieces of text."""
    kinds = F.translate(
        found, ascii_lowercase + ascii_uppercase + digits + "+/_-=", "a" * 26 + "A" * 26 + "0" * 10 + "-" * 5
    )
    vowels = F.translate(F.lower(found), ascii_lowercase, "".join("a" if c in "aeiou" else "b" for c in ascii_lowercase))
    words = "|".join(re.escape(w) for w in sorted(dictionary, key=lambda w: (-len(w), w)))
    known = F.regexp_replace(F.lower(found), words, "") if words else F.lower(found)
    run = F.concat(F.regexp_extract(before, r"(\S*)$", 1), found, F.regexp_extract(after, r"^(\S*)", 1))
    flag = lambda condition: condition.cast("double")
    values = [
        F.length(found).cast("double"),
        _changes(kinds),
        _changes(vowels),
        _share(found, "0-9"),
        _share(found, "A-Z"),
        F.size(F.array_distinct(F.split(found, ""))) / F.length(found),
        1 - F.length(known) / F.length(found),
        flag(run.rlike(r"://|\\|@|(/[^/]+){2,}|\.[a-z]{2,4}\b")),
        flag(F.lower(before).rlike(f"({SECRET_WORDS})\\W{{0,6}}(\\w+\\W{{0,4}})?$")),
        flag(F.lower(before).rlike(f"({OTHER_WORDS})\\W{{0,6}}(\\w+\\W{{0,4}})?$")),
        flag(before.rlike(r"""[:=]\s*["']?$""")),
    ]
    return F.array(*[v.cast("double") for v in values])


def label(found: Column, before: Column) -> Column:
    """1 for findings of a known format or assigned to a secret's name, 0 for words and numbers, else null."""
    mixed = found.rlike("[0-9]") & found.rlike("[A-Za-z]")
    assigned = F.lower(before).rlike(rf"""({SECRET_WORDS})["']?\s*[:=]\s*["']?$""")
    plain = found.rlike(r"^[A-Za-z]?[a-z_/-]+$|^[A-Z_/-]+$|^[0-9+/_-]+=*$|^[a-z]+([A-Z][a-z]+)+$")
    other = F.lower(before).rlike(f"({OTHER_WORDS})\\W{{0,6}}$")
    return F.when(found.rlike(KNOWN) | (assigned & mixed), 1.0).when((plain | other) & ~assigned, 0.0)


def common_words(rows: DataFrame, text_column: str = "text", n: int = DICTIONARY) -> list[str]:
    """The ``n`` most frequent words of 3 to 12 letters of all texts; of equally frequent ones the first by name."""
    words = rows.select(F.explode(F.split(F.lower(quoted(text_column)), r"[^\p{L}]+")).alias("word"))
    counted = words.filter(F.length("word").between(3, 12)).groupBy("word").count()
    return [r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(n).collect()]


def _with_pieces(df: DataFrame, text_column: str) -> DataFrame:
    """``_found``: all candidates of a text; ``_pieces``: what stands before, between and after them."""
    text = F.coalesce(quoted(text_column), F.lit(""))
    return df.withColumns({
        "_found": F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), "_pieces": F.split(text, CANDIDATE, -1),
    })


def _with_contexts(df: DataFrame, text_column: str) -> DataFrame:
    """``_found`` and ``_pieces``, and ``_contexts``: candidates with the text on either side, other candidates included.

    As many neighbours as could fit are put together, each cut to size, never the whole text.
    """
    near = F.lit(-(-CONTEXT // SHORTEST))
    size = F.lit(CONTEXT)
    # Arrays are handed on as arguments: a column inside a lambda may be worked out again for every element.
    bind = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def interleaved(row: Column, cut) -> Column:
        found = F.concat(row["found"], F.array(F.lit("")))
        return F.flatten(F.zip_with(row["pieces"], found, lambda p, c: F.array(cut(p, size), cut(c, size))))

    def contexts(row: Column) -> Column:
        # Piece i stands at 2 i, candidate i at 2 i + 1; slices count from 1.
        before = lambda i: F.slice(row["ends"], F.greatest(2 * i + 2 - 2 * near, F.lit(1)), F.least(2 * i + 1, 2 * near))
        after = lambda i: F.slice(row["starts"], 2 * i + 3, 2 * near)
        return F.transform(row["found"], lambda c, i: F.struct(
            c.alias("found"),
            F.right(F.array_join(before(i), ""), size).alias("before"),
            F.left(F.array_join(after(i), ""), size).alias("after"),
        ))

    row = F.struct(F.col("_found").alias("found"), F.col("_pieces").alias("pieces"))
    both = lambda r: F.struct(
        r["found"].alias("found"), interleaved(r, F.right).alias("ends"), interleaved(r, F.left).alias("starts")
    )
    found = F.when(F.size("_found") > 0, bind(row, lambda r: bind(both(r), contexts)))
    return _with_pieces(df, text_column).withColumn(
        "_contexts", F.coalesce(found, F.array().cast("array<struct<found:string,before:string,after:string>>"))
    )


@dataclass(frozen=True)
class Forest:
    """Trees as nested ``(feature, threshold, left, right)``, leaves 0 or 1, with the dictionary they were grown on."""

    trees: tuple
    dictionary: tuple[str, ...]

    def votes(self, values: Column) -> Column:
        """Share of the trees that hold a candidate with these features for a secret."""
        def ask(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(F.get(values, F.lit(feature)) <= F.lit(threshold), ask(left)).otherwise(ask(right))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + ask(tree)
        return total / F.lit(float(max(1, len(self.trees))))


def _read_tree(lines: list[str]) -> tuple | float:
    """A tree from its printed form, which the lines are taken off."""
    line = lines.pop(0)
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    left = _read_tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(threshold), left, _read_tree(lines)


def as_forest(model: RandomForestClassificationModel, dictionary: list[str]) -> Forest:
    printed = [[line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()] for tree in model.trees]
    return Forest(tuple(_read_tree(lines) for lines in printed), tuple(dictionary))


def train(
    df: DataFrame, text_column: str = "text", findings: DataFrame | None = None, per_class: int = SAMPLE_PER_CLASS
) -> Forest:
    """Grow the forest on labelled findings: ``found``, ``before``, ``after``, ``label`` (0 or 1).

    Without ``findings``, those of ``df`` that ``label`` is sure of are taken. The dictionary is counted over all
    texts. Of each class at most ``per_class`` different findings are used, those that hash lowest; a finding with many
    copies counts once. If a class is missing, there are no trees, and only known formats pass for secrets.
    """
    rows = df.select(F.coalesce(quoted(text_column), F.lit("")).alias("text"))
    dictionary = common_words(rows)
    if findings is None:
        # Looked for once, used several times.
        contexts = stage(_with_contexts(rows, "text").select(F.explode("_contexts").alias("c")).select("c.*"), "candidates")
        findings = contexts.withColumn("label", label(F.col("found"), F.col("before")))
    known = findings.filter(F.col("label").isin(0, 1)).select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("found", "before", "after")],
        F.col("label").cast("double").alias("label"),
    ).filter("found <> ''").distinct()
    low = F.xxhash64("found", "before", "after")
    chosen = [known.filter(F.col("label") == y).orderBy(low, "found", "before").limit(per_class) for y in (0, 1)]
    values = features(F.col("found"), F.col("before"), F.col("after"), dictionary)
    sample = stage(chosen[0].union(chosen[1]), "findings").select("label", array_to_vector(values).alias("features"))
    if sample.select("label").distinct().count() < 2:
        return Forest((), tuple(dictionary))
    grower = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return as_forest(grower.fit(sample), dictionary)


def _with_secrets(df: DataFrame, forest: Forest, text_column: str) -> DataFrame:
    """``_judged``: candidates with ``votes``, and ``_found`` and ``_pieces``."""
    pieces = _with_contexts(df, text_column)
    # Features first, votes after: every tree then reads values instead of working them out again.
    valued = pieces.withColumn("_valued", F.transform("_contexts", lambda c: F.struct(
        c["found"].alias("found"),
        features(c["found"], c["before"], c["after"], list(forest.dictionary)).alias("values"),
    )))
    return valued.withColumn("_judged", F.transform("_valued", lambda c: F.struct(
        c["found"].alias("found"), forest.votes(c["values"]).alias("votes")
    ))).drop("_contexts", "_valued")


def _is_secret(found: Column, votes: Column) -> Column:
    return (votes >= 0.5) | found.rlike(KNOWN)


def _redacted() -> Column:
    kept = F.transform("_judged", lambda j, i: F.concat(
        F.get("_pieces", i), F.when(_is_secret(j["found"], j["votes"]), F.lit(MASK)).otherwise(j["found"])
    ))
    return F.concat(F.array_join(kept, ""), F.element_at("_pieces", -1))


def scan(df: DataFrame, forest: Forest, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_candidates``, ``secrets`` (``secret``, ``at``, ``votes``) and ``redacted``, the text.

    A candidate is a secret if at least half of the trees say so, or if it has a known format, whatever they say. ``at`` counts characters from 0. The trees are a
    column expression, so every text is judged where it lies; nothing is shuffled.

    Null or empty text: no candidates, an empty text. Null ids stay null; repeated rows: a row each; an empty table
    gives no rows; other columns are dropped, whatever their names.
    """
    judged = _with_secrets(texts(df, id_column, text_column), forest, "text")
    lengths = F.transform("_pieces", lambda p, i: F.length(p) + F.coalesce(F.length(F.get("_found", i)), F.lit(0)))
    placed = judged.withColumn("_lengths", lengths).withColumn("_placed", F.transform("_judged", lambda j, i: F.struct(
        j["found"].alias("secret"), i.alias("i"), j["votes"].alias("votes")
    )))
    start = lambda s: F.aggregate(
        F.slice("_lengths", F.lit(1), s["i"]), F.lit(0), lambda total, n: total + n
    ) + F.length(F.get("_pieces", s["i"]))
    secrets = F.transform(F.filter("_placed", lambda s: _is_secret(s["secret"], s["votes"])), lambda s: F.struct(
        s["secret"].alias("secret"), start(s).alias("at"), s["votes"].alias("votes")
    ))
    return placed.select(
        "doc_id", F.size("_found").cast("long").alias("n_candidates"), secrets.alias("secrets"),
        _redacted().alias("redacted"),
    )


def redact(df: DataFrame, forest: Forest, text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """All rows and columns of ``df``; secrets in the text are masked, and its length is counted anew."""
    row = F.struct(*[quoted(c) for c in df.columns]).alias("row")
    judged = _with_secrets(df.select(row, quoted(text_column).alias("text")), forest, "text")
    masked = judged.select("row", _redacted().alias("masked"))
    values = {c: F.col("row")[c] for c in df.columns} | {text_column: F.col("masked")}
    if size_column in df.columns:
        values[size_column] = F.length("masked").cast(df.schema[size_column].dataType)
    return masked.select(*[value.alias(c) for c, value in values.items()])
