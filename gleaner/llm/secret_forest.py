"""Secret scans: candidate strings, and a random forest that removes false positives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass(frozen=True)
class SecretParams:
    """``min_length``: characters of a candidate. ``dictionary``: most frequent words that count as known;
    ``sample`` bounds the labelled findings the forest is fitted on (smallest hashes of the finding)."""

    min_length: int = 12
    dictionary: int = 20_000
    word_sizes: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    sample: int = 50_000
    trees: int = 24
    depth: int = 6
    threshold: float = 0.5
    seed: int = 23


RUN = r"[A-Za-z0-9+/_\-]"
FEATURES = (
    "length digits uppers lowers signs distinct changes transition coverage in_path has_key "
    "key_odds before_odds before2_odds after_odds"
).split()


def _candidate(params: SecretParams) -> str:
    """A long enough run that holds a digit and a letter; only the start of a run is tried."""
    return rf"(?<!{RUN})(?=[A-Za-z+/_\-]*[0-9])(?=[0-9+/_\-]*[A-Za-z]){RUN}{{{params.min_length},}}"


def findings(docs: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """``doc_id, at, candidate, key, before, before2, after, in_path``: candidate strings of whole texts.

    ``at`` is the number of the word (by white space) that holds it, ``key`` the name it is assigned to in that word,
    ``before`` and ``after`` the words around it without signs (an assignment sign alone is no word).
    """
    hit = _candidate(params)
    some = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").rlike(hit))
    words = some.select("doc_id", F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0)).alias("words"))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.col("words")[i].rlike(hit))
    rows = words.select("doc_id", "words", F.explode(places).alias("at"))
    w = F.col("words")

    def word(shift: int) -> Column:
        return F.coalesce(F.get(w, F.col("at") + shift), F.lit(""))

    def bare(c: Column) -> Column:
        return F.lower(F.regexp_replace(c, r"[^\p{L}]+", ""))

    near = rows.select("doc_id", "at", word(0).alias("word"), word(-1).alias("b1"), word(-2).alias("b2"), word(-3).alias("b3"), word(1).alias("a1"))
    sign = F.col("b1").rlike(r"^[^\p{L}\p{N}]+$")
    return near.select(
        "doc_id", "at", F.explode(F.regexp_extract_all("word", F.lit(hit), F.lit(0))).alias("candidate"),
        F.lower(F.regexp_extract("word", r"([A-Za-z_\-]+)[\"']?[=:]", 1)).alias("key"),
        bare(F.when(sign, F.col("b2")).otherwise(F.col("b1"))).alias("before"),
        bare(F.when(sign, F.col("b3")).otherwise(F.col("b2"))).alias("before2"),
        bare(F.col("a1")).alias("after"),
        F.col("word").rlike(r"://|^\.{0,2}/|\\|\.[A-Za-z]{2,4}/").alias("in_path"),
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of letters of all texts, lower-cased."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"\p{L}+"), F.lit(0)))
    return docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _pairs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(?s)(?=(..))"), F.lit(1))


def described(found: DataFrame, words: DataFrame, params: SecretParams) -> DataFrame:
    """The findings with the features that need no labels; every different candidate is described once."""
    texts = found.select("candidate").distinct().withColumn("low", F.lower("candidate"))
    # transitions: how likely the corpus's words are to go from one character to the next
    pairs = words.select("n", F.explode(_pairs(F.concat(F.lit("^"), "word", F.lit("$")))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    firsts = pairs.groupBy(F.expr("left(pair, 1)").alias("first")).agg(F.sum("n").alias("all"))
    chances = pairs.withColumn("first", F.expr("left(pair, 1)")).join(firsts, "first").select("pair", F.log((F.col("n") + 0.5) / (F.col("all") + 64)).alias("chance"))
    steps = texts.select("candidate", F.explode(_pairs(F.concat(F.lit("^"), "low", F.lit("$")))).alias("pair"))
    likely = steps.join(chances, "pair", "left").groupBy("candidate").agg(F.avg(F.coalesce("chance", F.lit(-12.0))).alias("transition"))
    # coverage: the share of characters inside a frequent word
    known = words.filter(F.length("word").isin(*params.word_sizes)).orderBy(F.desc("n"), "word").limit(params.dictionary).select("word")
    def placed(n: int) -> Column:
        parts = F.regexp_extract_all("low", F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))
        return F.transform(parts, lambda g, i: F.struct(g.alias("word"), (i + 1).alias("from"), F.lit(n).alias("size")))

    grams = texts.select("candidate", F.explode(F.concat(*map(placed, params.word_sizes))).alias("g")).select("candidate", "g.*")
    covered = grams.join(known, "word").select("candidate", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("size") - 1)).alias("place"))
    coverage = covered.groupBy("candidate").agg(F.count_distinct("place").alias("covered"))

    def share(pattern: str) -> Column:
        return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")

    described = (
        texts.join(likely, "candidate", "left").join(coverage, "candidate", "left")
        .select(
            "candidate", F.length("candidate").cast("double").alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
            share("[a-z]").alias("lowers"), share(r"[+/_\-]").alias("signs"),
            (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("distinct"),
            share(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]").alias("changes"),
            F.coalesce("transition", F.lit(-12.0)).alias("transition"),
            (F.coalesce("covered", F.lit(0)) / F.length("candidate")).alias("coverage"),
        )
    )
    return found.join(described, "candidate").withColumns({
        "in_path": F.col("in_path").cast("double"), "has_key": (F.col("key") != "").cast("double"),
    })


def with_odds(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Smoothed log-odds of the key and the neighbouring words among the labelled findings."""
    for name in ("key", "before", "before2", "after"):
        odds = labelled.groupBy(name).agg(
            F.log((F.count_if(F.col("secret")) + 0.5) / (F.count_if(~F.col("secret")) + 0.5)).alias(f"{name}_odds")
        )
        rows = rows.join(odds, name, "left").withColumn(f"{name}_odds", F.coalesce(f"{name}_odds", F.lit(0.0)))
    return rows


def scan(docs: DataFrame, labels: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """The findings of all texts with ``score`` (0 to 1) and ``is_secret``.

    ``labels`` holds judged findings: ``doc_id, at, candidate, secret``. The forest sees length, character
    kinds and transitions, dictionary coverage, path, key and neighbouring words; what words are frequent and which
    characters follow each other is counted over all texts. Null and empty texts have no findings; a finding of a null
    doc_id is scored but not learned from; null labels are ignored, repeated ones count once (true if one is).
    Without labels of both kinds every finding is kept, with score 1. Other columns are ignored.
    """
    found = cut_lineage(findings(docs, params))
    words = cut_lineage(vocabulary(docs).filter("n > 1"))
    rows = cut_lineage(described(found, words, params))
    truth = labels.filter("secret is not null and doc_id is not null").groupBy("doc_id", "at", "candidate").agg(F.max("secret").alias("secret"))
    judged = rows.join(truth, ["doc_id", "at", "candidate"])
    # learning on the odds of the very rows they come from would trust them too much: two halves take each other's
    half = F.pmod(F.xxhash64("candidate"), F.lit(2))
    first, second = judged.filter(half == 0), judged.filter(half == 1)
    training = with_odds(first, second).unionByName(with_odds(second, first), allowMissingColumns=True)
    sample = cut_lineage(
        training.orderBy(F.xxhash64("doc_id", "at", "candidate"), "doc_id", "at").limit(params.sample)
        .select(*FEATURES, F.col("secret").cast("double").alias("secret"))
    )
    kinds = sample.agg(F.min("secret").alias("least"), F.max("secret").alias("most")).first()
    plain = ["doc_id", "at", "candidate", "key", "before", "after"]
    if kinds["least"] is None or kinds["least"] == kinds["most"]:
        return rows.select(*plain, F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(
        labelCol="secret", numTrees=params.trees, maxDepth=params.depth, seed=params.seed, maxBins=32, subsamplingRate=0.8
    ).fit(assembler.transform(sample))
    scored = forest.transform(assembler.transform(with_odds(rows, judged)))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(
        *plain, "score", (F.col("score") >= params.threshold).alias("is_secret")
    )
