"""Secret scan: native candidate search and features, and a random forest that removes false positives."""

from __future__ import annotations

import functools
import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmart.llm.common import shared_dir, stored

#: Characters of context on either side that hold the neighbouring words.
CONTEXT = 80
#: Labelled rows, by label, that the forest is fitted on: those with the least hash.
SAMPLE = 10_000
TREES, DEPTH, SEED = 30, 6, 17
#: Probability from which a finding counts as a secret.
THRESHOLD = 0.5

# Words that name a credential, words that name other long values, and formats that providers publish.
CREDENTIAL = "password passwd pwd pass secret token apikey api_key key auth authorization bearer credential credentials access_key private signature"
ASSIGNABLE = "password passwd pwd passphrase pass secret token apikey api_key api-key key auth authorization bearer credential credentials access_key access-key private_key private-key"
HARMLESS = "commit sha sha1 sha256 md5 hash checksum digest uuid guid id version build revision rev etag isbn phone tel call card order invoice"
PROVIDERS = (
    r"^AKIA[0-9A-Z]{16}$", r"^ASIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$", r"^AIza[0-9A-Za-z_-]{35}$",
    r"^sk_live_[0-9A-Za-z]{16,}$", r"^glpat-[0-9A-Za-z_-]{20}$", r"^eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}$",
)
EMAIL = r"^[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\.?$"
ADDRESS = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}[.,:]?[0-9]*$"
DIGITS = r"^[0-9 .:/_+-]+$"

#: A candidate is a run of at least so many of these signs with a digit in it,
LEAST = 12
RUN = r"[A-Za-z0-9_+/=.@:~-]"
LONG_RUN = rf"(?<!{RUN})(?={RUN[:-1]}]*+)(?=[A-Za-z_+/=.@:~-]*+[0-9]){RUN}{{{LEAST},}}+"
#: or whatever stands after the name of a credential and a sign of assignment, of any length and with any signs.
NAMED = rf"(?<![A-Za-z0-9])(?i:{'|'.join(ASSIGNABLE.split())})[\"'`]?[ \t]*+[=:]++>?[ \t]*+[\"'`]?"
CANDIDATE = rf"{NAMED}[^\s\"'`]++|{LONG_RUN}"

FEATURES = [
    "length", "upper", "lower", "digits", "signs", "changes", "rare_changes", "kinds", "distinct", "coverage", "in_path", "dots", "credential", "harmless",
    "assigned", "quoted",
]


def _words(text: str) -> str:
    return "|".join(text.split())


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, value, before, after): every candidate of every whole text, ``start`` in code points from 0.

    A name and a sign of assignment in front of a value, as in ``password=``, belong to ``before``. Such a value is a candidate whatever
    it looks like; elsewhere a candidate is a long run with a digit. Points, commas and brackets after a value are not its own. Texts
    without candidates leave after one pass of the expression. Null texts give nothing.
    """
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), body.alias("text")).where(body.rlike(CANDIDATE))
    split = rows.select("doc_id", F.split("text", CANDIDATE, -1).alias("between"), F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("found"))
    sizes = split.withColumn("lead", F.transform("between", lambda x: F.char_length(x))).withColumn("sizes", F.transform("found", lambda x: F.char_length(x)))
    each = sizes.select("doc_id", F.posexplode(F.arrays_zip(
        F.col("found").alias("run"), F.slice("between", 1, F.size("found")).alias("before"), F.slice("between", 2, F.size("found")).alias("after"),
        _running("lead", "sizes").alias("start"),
    )).alias("at", "c")).select("doc_id", "c.*")
    named = F.regexp_extract("run", f"^({NAMED})", 1)
    name = F.when(named != "", named).otherwise(F.regexp_extract("run", r"^([A-Za-z_][A-Za-z0-9_.-]*[=:]+)(?=.{6,})", 1))
    value = F.regexp_replace(F.substr("run", F.char_length(name) + 1), r"[.:=,;)\]}]+$", "")
    return each.select(
        "doc_id", (F.col("start") + F.char_length(name)).alias("start"), value.alias("value"),
        F.concat(F.right("before", F.lit(CONTEXT)), name).alias("before"), F.left("after", F.lit(CONTEXT)).alias("after"),
        (named != "").alias("named"),
    ).where((F.char_length("value") > 0) & (F.col("named") | (F.char_length("value") >= 8) & F.col("value").rlike("[0-9]"))).drop("named")


def _running(lead: str, sizes: str) -> Column:
    """The start of each candidate: the lengths of all text before it, summed along the array."""
    step = F.zip_with(F.slice(F.col(lead), 1, F.size(sizes)), F.col(sizes), lambda a, b: F.struct(a.alias("gap"), b.alias("own")))
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        step, empty,
        lambda s, x: F.struct((s["end"] + x["gap"] + x["own"]).alias("end"), F.array_append(s["starts"], s["end"] + x["gap"]).alias("starts")),
        lambda s: s["starts"],
    )


def dictionary(spark: SparkSession, vocabulary: str, least: int = 3) -> DataFrame:
    """(word): the whole words of ``least`` letters or more in a public tokenizer's vocabulary file; about 30,000, so bounded."""
    with open(vocabulary, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    words = sorted({n.removesuffix("</w>") for n in names if n.endswith("</w>") and n.removesuffix("</w>").isalpha() and len(n) >= least + 4})
    return spark.createDataFrame([(w,) for w in words], "word string")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the forest's features: length, character classes and their changes, dictionary coverage, path, neighbours.

    Coverage is the part of a value's signs in letter runs that are dictionary words. ``rare_changes`` counts changes between
    letters and digits or of case within a run, which words and names hardly have.
    """
    value = F.col("value")
    n = F.char_length(value)
    left = lambda pattern: F.char_length(F.regexp_replace(value, pattern, ""))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    runs = F.regexp_replace(classes, r"(.)\1+", "$1")
    near = F.lower(F.concat(F.regexp_extract("before", r"(\S*\s*\S*\s*\S*)$", 1), F.lit(" "), F.regexp_extract("after", r"^(\S*\s*\S*)", 1)))
    both = lambda text: near.rlike(rf"(?<![a-z0-9])(?:{_words(text)})(?![a-z0-9])").cast("double")
    rows = found.select(
        "*",
        n.cast("double").alias("length"), ((n - left("[A-Z]")) / n).alias("upper"), ((n - left("[a-z]")) / n).alias("lower"),
        ((n - left("[0-9]")) / n).alias("digits"), (left("[A-Za-z0-9]") / n).alias("signs"),
        ((F.char_length(runs) - 1) / n).alias("changes"),
        (F.size(F.regexp_extract_all(runs, F.lit("(?=a0|0a|B0|0B|aB)"), 0)) / n).alias("rare_changes"),
        F.size(F.array_distinct(F.split(runs, ""))).cast("double").alias("kinds"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct"),
        (F.col("before").rlike(r"[/\\]\S*$") | value.rlike(r"^[~.]*/|/[^/]*/|://|\.[a-z]{2,4}$")).cast("double").alias("in_path"),
        ((n - left("[.@]")) / n).alias("dots"), both(CREDENTIAL).alias("credential"), both(HARMLESS).alias("harmless"),
        F.col("before").rlike(r"[=:]\s*[\"'`]?$").cast("double").alias("assigned"), F.col("before").rlike("[\"'`]$").cast("double").alias("quoted"),
        F.xxhash64("value").alias("value_hash"),
    )
    pieces = found.select("value").distinct().select(F.xxhash64("value").alias("value_hash"), F.explode(F.regexp_extract_all("value", F.lit("[A-Za-z]{3,}"), 0)).alias("piece"))
    known = pieces.join(F.broadcast(words), F.lower("piece") == F.col("word")).groupBy("value_hash").agg(F.sum(F.char_length("piece")).alias("covered"))
    return rows.join(known, "value_hash", "left").withColumn("coverage", F.coalesce(F.col("covered") / F.col("length"), F.lit(0.0))).drop("covered", "value_hash")


def with_rule_label(found: DataFrame) -> DataFrame:
    """``found`` (with features) with ``label``: 1 for a provider's format, or a value assigned to a credential that has a digit, or eight
    signs that are not words; 0 for addresses, numbers, values that a harmless word introduces, and assigned words of a dictionary; null where no
    rule speaks. The labels stand for findings that people have judged."""
    value, before = F.col("value"), F.lower("before")
    provider = functools.reduce(lambda a, b: a | b, [value.rlike(p) for p in PROVIDERS])
    assigned = before.rlike(rf"(?<![a-z0-9])(?:{_words(ASSIGNABLE)})[\"'`]?\s*[=:]+>?\s*[\"'`]?$")
    plain = value.rlike(EMAIL) | value.rlike(ADDRESS) | value.rlike(DIGITS) | before.rlike(rf"(?<![a-z0-9])(?:{_words(HARMLESS)})[\s:=#]+$")
    odd = value.rlike("[0-9]") & (F.char_length(value) >= 6) | (F.char_length(value) >= 8) & (F.col("coverage") < 0.5)
    word = value.rlike("^[A-Za-z]+$") & (F.col("coverage") > 0.99) | (F.char_length(value) < 4)
    return found.withColumn("label", F.when(provider | (assigned & odd & ~value.rlike(EMAIL)), 1.0).when(plain | (assigned & word), 0.0))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """A forest fitted on at most ``sample`` distinct labelled findings of either label; None unless both labels occur.

    The sample is the findings whose feature values hash least, so it does not depend on order or partitions.
    """
    rows = labelled.where("label is not null").select("label", *FEATURES, F.xxhash64(F.lit(SEED), *FEATURES).alias("draw")).distinct()
    parts = [rows.where(F.col("label") == x).orderBy("draw", *FEATURES).limit(sample) for x in (0.0, 1.0)]
    taken = stored(parts[0].unionByName(parts[1]))
    if taken.select("label").distinct().count() < 2:
        return None
    one = taken.repartition(1).sortWithinPartitions("draw", *FEATURES)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(one)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features").fit(data)
    # Written and loaded: the fitted object also holds its training data, which tasks cannot take.
    path = shared_dir(labelled.sparkSession, "forest")
    forest.save(path)
    return RandomForestClassificationModel.load(path)


def score(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` (with features) and the forest's ``score``; without a model the rule's label, or 0.5 where it is silent."""
    if model is None:
        return found.withColumn("score", F.coalesce("label", F.lit(0.5)))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    return model.transform(data).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, vocabulary: str, labelled: DataFrame | None = None, threshold: float = THRESHOLD, sample: int = SAMPLE,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per finding: doc_id, start, length, value, score, secret.

    Candidates of whole texts get features; a random forest trained from ``labelled`` findings (columns value, before, after,
    label) scores them, and those under ``threshold`` are false positives (``secret`` false). Without ``labelled`` the
    findings of ``docs`` that :func:`with_rule_label` can judge are the labelled ones. Null and empty texts have no findings;
    a null key stays; repeated rows give repeated findings; an empty table gives none; other columns are not read.
    """
    words = dictionary(docs.sparkSession, vocabulary)
    found = stored(features(stored(candidates(docs, key, text)), words).transform(with_rule_label))
    train = found if labelled is None else features(labelled.select("value", "before", "after", "label"), words)
    return score(found, fit(train, sample)).select(
        "doc_id", F.col("start").cast("long").alias("start"), F.char_length("value").cast("long").alias("length"), "value", "score",
        (F.col("score") >= threshold).alias("secret"),
    )
