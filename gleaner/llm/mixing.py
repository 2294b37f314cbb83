"""Mixing sources to target weights: temperature, limits, budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class MixingParams:
    """Exactly one of ``most_repeats`` and ``entropy`` steers the exponent.

    ``most_repeats``: no source is passed more often than this. ``entropy``: target entropy of the weights in
    nats. ``budget``: tokens to give out; None takes as many as pass the source with the fewest repeats
    exactly once, so that every document is used. ``block``: tokens of one block, in which every
    source has its weight. ``group``: about as many rows are ordered at a time.
    """

    most_repeats: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None
    block: int = 1 << 20
    group: int = 2000
    seed: int = 13


def bisect(f: Callable[[float], float], target: float, low: float, high: float) -> float:
    """The point where the monotone ``f`` meets ``target``, or the nearer end."""
    rising = f(high) >= f(low)
    for _ in range(100):
        mid = (low + high) / 2
        if (f(mid) < target) == rising:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def _weights(tokens: Mapping[str, int], exponent: float) -> dict[str, float]:
    total = math.fsum(tokens.values())
    powers = {s: (n / total) ** exponent for s, n in tokens.items()}
    norm = math.fsum(powers.values())
    return {s: p / norm for s, p in powers.items()}


def _budget(tokens: Mapping[str, int], weights: Mapping[str, float], params: MixingParams) -> float:
    return params.budget if params.budget is not None else max(n / weights[s] for s, n in tokens.items())


def mixture(tokens: Mapping[str, int], params: MixingParams) -> tuple[float, dict[str, float], dict[str, float]]:
    """Exponent, weight of each source, and how often each is passed. ``tokens`` are positive counts.

    Exponent 1 keeps the shares, 0 makes them equal; a target entropy that no exponent meets (above the logarithm of the number of
    sources, or below that of equally large ones) gets the nearest there is. The smallest exponent within the repetition limit
    is taken, so that small sources gain as much as the limit allows.
    """

    def passes(exponent: float) -> dict[str, float]:
        w = _weights(tokens, exponent)
        b = _budget(tokens, w, params)
        return {s: b * w[s] / n for s, n in tokens.items()}

    if params.entropy is not None:
        def entropy(exponent: float) -> float:
            return -math.fsum(w * math.log(w) for w in _weights(tokens, exponent).values() if w > 0)

        highest = 1.0  # beyond 1 large sources gain: entropies below the natural one
        while entropy(highest) > params.entropy and highest < 1024:
            highest *= 2
        exponent = bisect(entropy, params.entropy, 0.0, highest)
    else:
        most = lambda exponent: max(passes(exponent).values())
        exponent = 0.0 if most(0.0) <= params.most_repeats else bisect(most, params.most_repeats, 0.0, 1.0)
    return exponent, _weights(tokens, exponent), passes(exponent)


SOURCE_LIMIT = 1_000_000  # sources are names of collections; more is an error, not a silent cut


def mix(docs: DataFrame, params: MixingParams = MixingParams()) -> DataFrame:
    """The rows of the mixture: the columns of ``docs`` and ``mix_epoch, mix_tokens, mix_weight, mix_block, mix_order``.

    Token counts are words between ASCII white space, one at least, so that empty and null texts
    count too. A null source is a source of its own. A source with p passes gives all its rows in epochs
    0 to floor(p) - 1 and, of the last epoch, the rows of its permutation up to the remaining token budget;
    the row on the border belongs to it. Each epoch is another permutation, by md5 of seed, epoch,
    doc_id and text, ties in either order; ``mix_block`` is the block in which a row's tokens start when
    the source gives out its weight of every block, and ``mix_order`` (md5) permutes within a block.

    Only one row per source reaches the driver. Running totals are taken per hash bucket of about
    ``group`` rows and bucket totals are added up before, so that a source with a third of all
    rows is ordered by many tasks. An empty table gives an empty result. Existing columns of
    the new names are replaced.
    """
    kept = docs.drop("mix_epoch", "mix_tokens", "mix_weight", "mix_block", "mix_order")
    source = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    shares = (
        kept.select(source.alias("s"), F.greatest(words, F.lit(1)).cast("long").alias("t"))
        .groupBy("s").agg(F.sum("t").alias("tokens"), F.count("*").alias("rows"))
    )
    rows = shares.limit(SOURCE_LIMIT + 1).collect()
    if len(rows) > SOURCE_LIMIT:
        raise ValueError(f"more than {SOURCE_LIMIT} sources")
    tokens = {r["s"]: r["tokens"] for r in rows}
    spark = docs.sparkSession
    plan_type = "__s string, mix_weight double, __total double, __budget double, __epochs int, __buckets long, __part double"
    plan = []
    if tokens:
        _, weights, passes = mixture(tokens, params)
        for r in rows:
            p, w = passes[r["s"]], weights[r["s"]]
            whole = round(p) if abs(p - round(p)) < 1e-9 else p
            given = float(whole * tokens[r["s"]])
            plan.append((r["s"], w, float(r["tokens"]), given, math.ceil(whole), max(1, r["rows"] // params.group), w * params.block))
    per_source = spark.createDataFrame(plan, plan_type)  # one row per source

    text_key = F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))
    key = F.concat_ws("|", F.lit(str(params.seed)), F.col("mix_epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key)
    dealt = (
        kept.withColumns({"__s": source, "mix_tokens": F.greatest(words, F.lit(1)).cast("long")})
        .join(F.broadcast(per_source), "__s")
        .withColumn("mix_epoch", F.explode(F.when(F.col("__epochs") > 0, F.sequence(F.lit(0), F.col("__epochs") - 1))))
        .withColumn("__h", F.md5(key))
        .withColumn("__at", F.conv(F.substring("__h", 1, 12), 16, 10).cast("long"))
        .withColumn("__bucket", F.floor(F.col("__at") * F.col("__buckets") / F.lit(float(1 << 48))))
    )
    narrow = dealt.select("__s", "mix_epoch", "__bucket", "mix_tokens")
    bucket = ["__s", "mix_epoch", "__bucket"]
    sums = narrow.groupBy(*bucket).agg(F.sum("mix_tokens").alias("__sum"))
    earlier = Window.partitionBy("__s", "mix_epoch").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    within = Window.partitionBy(*bucket).orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("__before", F.coalesce(F.sum("mix_tokens").over(within), F.lit(0)))
        .join(offsets, bucket)
    )
    start = F.col("mix_epoch") * F.col("__total") + F.col("__offset") + F.col("__before")
    return (
        placed.withColumn("__start", start).filter(F.col("__start") < F.col("__budget"))
        .select(
            *kept.columns, "mix_epoch", "mix_tokens", "mix_weight",
            F.floor(F.col("__start") / F.col("__part")).cast("long").alias("mix_block"),
            F.md5(F.concat_ws("|", F.lit("order"), "__h")).alias("mix_order"),
        )
    )
