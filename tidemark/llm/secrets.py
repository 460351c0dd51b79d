"""Secret scans: a random forest that removes false findings.

Findings are stretches of 16 or more letters, digits and ``+/_-``, and what stands after the name of
a password, token or key and a colon or equals sign, of any length and characters. Each gets figures: its length,
how often its characters change class or case, how many differ, how much of it is covered by words
of a dictionary, what the path of its document says, and what the words next to it say. A random
forest trained on labelled findings gives the probability that it is a secret.

Everything is a column expression or a JVM-side estimator. The dictionary (a public vocabulary, a
fixed size) is broadcast. Coverage is worked out once per distinct finding, so a value that a third
of all rows repeat is one row. Training takes at most ``most_labelled`` labelled findings, the
first by a hash of their value, as one bounded set; every finding is scored.

Defined cases: null and empty texts have no findings; a null path counts as an empty one; a text of
any length is scanned whole; equal findings of one text are numbered and score by their own
neighbours; rows of equal id are scanned each. Without labelled findings of both kinds nothing can
be learned: ``fit`` raises ValueError, and ``scan``, if it had to label by shape, keeps every
finding with a null score. An empty table has no findings. Other columns are not
looked at."""

from __future__ import annotations

import base64
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.cluster import folder, written

# What stands after the name of a password, token or key and ":" or "=": all between quotes, or else
# all up to a space, without closing punctuation.
_named = (
    r"(?<=[:=]\s{0,3}[\"']?)(?<=(?i:pass(?:word|wd|phrase)?|pwd|secret|token|key|auth|credential)"
    r"(?:s|[0-9]{1,3}|[_\-A-Z][A-Za-z0-9_\-]{0,20})?[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
)
PLACED = _named + r"(?:(?<=\")[^\"\r\n]+(?=\")|(?<=')[^'\r\n]+(?=')|(?![\s\"':=])\S*[^\s\"',;.)\]}>])"
# Latin letters beside a stretch make it part of a word; other scripts are written without spaces.
CANDIDATE = PLACED + r"|(?<![A-Za-z0-9+/_\-\p{IsLatin}])[A-Za-z0-9+/_\-]{16,}+={0,2}(?!\p{IsLatin})"
CONTEXT = 64
SECRET_WORDS = r"(?i)(pass(?:word|wd|phrase)?|pwd|secret|token|api|key|auth|credential|bearer|private)"
HARMLESS_WORDS = r"(?i)(example|sample|dummy|placeholder|test|sha\d*|md5|commit|checksum|hash|uuid|version)"
HARMLESS_PATHS = r"(?i)(test|example|sample|doc|vendor|fixture|mock|node_modules)"
CODE_PATHS = r"(?i)\.(py|js|ts|java|go|rb|php|env|ya?ml|json|cfg|ini|toml|properties|sh|tf)$"
# Shapes that providers give their keys, for labelling (fixed values).
PROVIDER = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^glpat-[0-9A-Za-z_-]{20}$|^AIza[0-9A-Za-z_-]{35}$|^sk_live_[0-9A-Za-z]{24,}$"
ASSIGNED = r"(?i)(pass(?:word|wd|phrase)?|pwd|secret|token|(?:api|access|secret|private)_?key|auth|credential)[\"']?\s*[:=]\s*[\"']?$"

FEATURES = (
    "length", "digit_share", "upper_share", "class_changes", "case_changes", "distinct_share",
    "longest_letters", "vowel_share", "is_hex", "coverage", "path_harmless", "path_code",
    "path_depth", "word_secret", "word_harmless", "assigned", "quoted",
)


@dataclass(frozen=True)
class Forest:
    trees: int = 30
    depth: int = 7
    seed: int = 11
    most_labelled: int = 20_000
    threshold: float = 0.5


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Words of three to twelve letters in a vocabulary file of tokens in base64; fixed by the file."""
    with open(path, "rb") as file:
        tokens = {base64.b64decode(line.split()[0]).decode("utf-8", "replace").strip().lower() for line in file if line.strip()}
    words = sorted(w for w in tokens if w.isascii() and w.isalpha() and 3 <= len(w) <= 12)
    return spark.createDataFrame([(w,) for w in words], "word string")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per finding: id, ``number`` in its text, ``value``, path, and ``before`` and ``after``, the text on
    either side, with other findings in it."""
    text = F.col("t")
    rows = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[path_col].cast("string"), F.lit("")).alias("path"),
        docs[text_col].alias("t"),
    ).withColumn("found", F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    gaps = rows.where(F.size("found") > 0).select(
        "id", "path", "found", F.split(text, CANDIDATE, -1).alias("gaps")
    )
    # The text as gap, finding, gap and so on. A gap and a finding have a character at least, so so
    # many pieces hold the context, and no more than its length is needed of each.
    both = F.flatten(
        F.transform(F.arrays_zip("gaps", "found"), lambda z: F.array(z.gaps, F.coalesce(z.found, F.lit(""))))
    )
    gaps = gaps.select(
        "*", F.transform(both, lambda x: F.right(x, F.lit(CONTEXT))).alias("ends"),
        F.transform(both, lambda x: F.left(x, F.lit(CONTEXT))).alias("begins"),
    )
    most = 2 * CONTEXT
    joined = lambda pieces, start, n: F.array_join(F.slice(pieces, start, n), "")
    each = F.transform(
        "found",
        lambda v, i: F.struct(
            (i + 1).cast("bigint").alias("number"), v.alias("value"),
            F.right(
                joined("ends", F.greatest(2 * i + 2 - most, F.lit(1)), F.least(2 * i + 1, F.lit(most))), F.lit(CONTEXT)
            ).alias("before"),
            F.left(joined("begins", 2 * i + 3, F.lit(most)), F.lit(CONTEXT)).alias("after"),
        ),
    )
    return gaps.select("id", "path", F.inline(each))


def coverage(values: DataFrame, words: DataFrame) -> DataFrame:
    """``value`` and ``coverage``, the share of its characters in dictionary words, per distinct value."""
    distinct = values.select("value").distinct()
    key = F.sha2("value", 256).alias("key")
    # What begins at each place, twelve characters at most; the value itself is not repeated.
    begins = F.regexp_extract_all("value", F.lit("(?=(.{1,12}))"), F.lit(1))
    placed = distinct.select(key, F.posexplode(begins).alias("s", "begin"))
    pieces = placed.select("key", "s", "begin", F.explode(F.sequence(F.lit(3), F.lit(12))).alias("n"))
    pieces = pieces.where(F.length("begin") >= F.col("n")).select(
        "key", "s", "n", F.lower(F.left("begin", F.col("n"))).alias("piece")
    )
    hits = pieces.join(F.broadcast(words), F.col("piece") == F.col("word"))
    spans = F.collect_list(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1))
    covered = hits.groupBy("key").agg(F.size(F.array_distinct(F.flatten(spans))).alias("c"))
    return distinct.select("value", key).join(covered, "key", "left").select(
        "value", (F.coalesce("c", F.lit(0)) / F.length("value")).alias("coverage")
    )


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with all figures. Coverage joins by value: it has one row per value, and the side
    that repeats values can be split."""
    known = written(coverage(found, words), "coverage").withColumnRenamed("value", "v")
    v, runs = F.col("value"), F.split("value", "[^A-Za-z]+")
    near = F.concat_ws(" ", F.right("before", F.lit(40)), F.left("after", F.lit(24)))
    flag = lambda c: c.cast("double")
    return found.join(known, F.col("value") == F.col("v"), "left").select(
        *found.columns,
        F.length("value").cast("double").alias("length"),
        _share(v, "[0-9]").alias("digit_share"),
        _share(v, "[A-Z]").alias("upper_share"),
        _share(v, r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])").alias("class_changes"),
        _share(v, r"(?<=[a-z])(?=[A-Z])").alias("case_changes"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("distinct_share"),
        F.array_max(F.transform(runs, lambda r: F.length(r))).cast("double").alias("longest_letters"),
        _share(v, "[aeiouAEIOU]").alias("vowel_share"),
        flag(v.rlike("^[0-9a-f]+$") | v.rlike("^[0-9A-F]+$")).alias("is_hex"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        flag(F.col("path").rlike(HARMLESS_PATHS)).alias("path_harmless"),
        flag(F.col("path").rlike(CODE_PATHS)).alias("path_code"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        flag(near.rlike(SECRET_WORDS)).alias("word_secret"),
        flag(near.rlike(HARMLESS_WORDS)).alias("word_harmless"),
        flag(F.col("before").rlike(r"[:=]\s*[\"']?$")).alias("assigned"),
        flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")).alias("quoted"),
    )


def labelled_by_shape(found: DataFrame) -> DataFrame:
    """Findings whose nature their shape or place makes certain, with ``label``: keys of providers
    and assigned passwords are secrets; plain words and plain numbers elsewhere are not."""
    value, before = F.col("value"), F.col("before")
    secret = value.rlike(PROVIDER) | (
        before.rlike(ASSIGNED) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 8)
    )
    harmless = (value.rlike(r"^[A-Z]?[a-z]+$|^[A-Z]+$|^[0-9]+$|^[a-z_\-/]+$") | before.rlike(r"(?i)(commit|sha\d*|md5|uuid)\W*$")) & ~before.rlike(ASSIGNED)
    return found.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label is not null")


class MissingKind(ValueError):
    """Labelled findings are all of one kind, or there are none."""


def fit(labelled: DataFrame, forest: Forest | None = None) -> PipelineModel:
    """A forest of labelled findings with figures (``label`` 1 or 0). Of more than
    ``most_labelled``, half the places go to each kind, by hash of value and place."""
    forest = forest or Forest()
    half = forest.most_labelled // 2
    order = (F.xxhash64("value", "before"), F.col("value"), F.col("before"))
    chosen = [labelled.where(F.col("label") == k).orderBy(*order).limit(half) for k in (0.0, 1.0)]
    sample = written(chosen[0].unionByName(chosen[1]).select("label", *FEATURES), "labelled")
    if sample.select("label").distinct().count() < 2:
        raise MissingKind("labelled findings of both kinds are needed")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = RandomForestClassifier(
        numTrees=forest.trees, maxDepth=forest.depth, seed=forest.seed, labelCol="label", featuresCol="features"
    )
    # Read back, the forest is without its training summary, which holds the session and with it
    # things that cannot be sent to tasks once a job of the session was observed.
    path = folder(sample.sparkSession, "forest")
    trees.fit(assembler.transform(sample)).write().save(path)
    return PipelineModel([assembler, RandomForestClassificationModel.load(path)])


def scored(found: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """id, number, value, ``score`` (probability of a secret) and ``kept`` for findings with figures."""
    out = model.transform(found.select("id", "number", "value", *FEATURES))
    score = vector_to_array("probability")[1]
    return out.select("id", "number", "value", score.alias("score"), (score >= threshold).alias("kept"))


def scan(
    docs: DataFrame, words: DataFrame, labelled: DataFrame | None = None, forest: Forest | None = None,
    id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
) -> DataFrame:
    """Every finding of ``docs`` with its score. ``labelled`` are findings with ``label``; without
    them, those whose shape makes them certain are taken from ``docs``; if these are not of both kinds,
    nothing can be judged, and every finding is kept, with a null score."""
    forest = forest or Forest()
    found = written(findings(docs, id_col, text_col, path_col), "findings")
    figures = written(featured(found, words), "figures")
    known = labelled_by_shape(figures) if labelled is None else featured(labelled, words)
    try:
        out = scored(figures, fit(known, forest), forest.threshold)
    except MissingKind:
        if labelled is not None:
            raise
        unjudged = (F.lit(None).cast("double").alias("score"), F.lit(True).alias("kept"))
        out = figures.select("id", "number", "value", *unjudged)
    return out.withColumnRenamed("id", id_col)
