"""URL filters: rules first, then the ratio of two character language models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlModelParams:
    """``order``: the longest context. ``strength``: how many observations a shorter context's estimate
    counts for. One url in ``folds`` (by hash) is kept from the counts to calibrate the threshold on;
    ``bins`` bounds the table of scores it is chosen from."""

    order: int = 4
    strength: float = 4.0
    folds: int = 5
    bins: int = 400
    span: float = 4.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path; both empty without ``://`` or for null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, parts, 2)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that fits and its verdict, null without one. ``rules`` are (verdict, ``host/path``).

    A rule fits its host and all subdomains if the path starts with its path; the longest wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for to, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer rule goes before the ones so far
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(to)).otherwise(verdict)
    return rule, verdict


def _grams(url: Column, order: int) -> Column:
    """Every character with the ``order`` before it; the borders are control characters."""
    padded = F.concat(F.lit("\x02" * order), F.lower(url), F.lit("\x03"))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))


def url_scores(urls: DataFrame, params: UrlModelParams = UrlModelParams()) -> DataFrame:
    """``a, b, score, accepted, trained`` by url: the mean log-likelihood ratio per character.

    ``urls`` has one row per distinct url: two hash columns ``a, b``, ``url``, and ``accepted`` (null: not labelled).
    Both models count every training url. Counts are combined before the shuffle, and every different
    gram is evaluated once: an estimate of order k counts the gram of k + 1 characters and adds the estimate
    of order k - 1 with ``strength`` observations, down to even odds over 256 characters.
    """
    k = params.order
    labelled = urls.withColumn(
        "trained", F.col("accepted").isNotNull() & (F.pmod("b", F.lit(params.folds)) != 0)
    )
    spread = labelled.select("a", "b", F.when(F.col("trained"), F.col("accepted")).alias("accepted"), F.explode(_grams(F.col("url"), k)).alias("gram"))
    full = cut_lineage(
        spread.groupBy("gram").agg(F.count_if(F.col("accepted")).alias("good"), F.count_if(~F.col("accepted")).alias("bad"))
    )
    suffixes = full.select("gram", "good", "bad", F.explode(F.sequence(F.lit(1), F.lit(k + 1))).alias("width")).withColumn(
        "part", F.expr("right(gram, width)")
    )
    counts = suffixes.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    context = F.expr("left(part, length(part) - 1)")
    totals = counts.groupBy(context.alias("context"), F.length("part").alias("width")).agg(
        F.sum("good").alias("good_all"), F.sum("bad").alias("bad_all")
    )
    found = (
        suffixes.select("gram", "width", "part", context.alias("context"))
        .join(counts, "part").join(totals, ["context", "width"])
    )
    at = {
        f"{name}_{w}": F.max(F.when(F.col("width") == w, F.col(name)))
        for w in range(1, k + 2) for name in ("good", "bad", "good_all", "bad_all")
    }
    wide = found.groupBy("gram").agg(*[c.alias(name) for name, c in at.items()])

    def likelihood(kind: str) -> Column:
        p = F.lit(1 / 256)
        for w in range(1, k + 2):
            p = (F.col(f"{kind}_{w}") + params.strength * p) / (F.col(f"{kind}_all_{w}") + params.strength)
        return F.log(p)

    ratios = cut_lineage(wide.select("gram", (likelihood("good") - likelihood("bad")).alias("ratio")))
    scores = spread.select("a", "b", "gram").join(ratios, "gram").groupBy("a", "b").agg(F.avg("ratio").alias("score"))
    return scores.join(labelled.select("a", "b", "accepted", "trained"), ["a", "b"])


def threshold(scores: DataFrame, params: UrlModelParams) -> float:
    """The score that best separates the labelled urls kept from training: equal weight for
    both kinds, the middle of the best stretch. 0 without urls of both kinds."""
    half = params.bins // 2
    cell = F.greatest(F.lit(-half), F.least(F.lit(half), F.round(F.col("score") * half / params.span))).cast("int")
    held = scores.filter("accepted is not null and not trained").groupBy(cell.alias("cell"))
    rows = sorted((r["cell"], r["good"], r["bad"]) for r in held.agg(
        F.count_if(F.col("accepted")).alias("good"), F.count_if(~F.col("accepted")).alias("bad")).collect())  # one row per bin
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    counts = {r[0]: r[1:] for r in rows}
    best, at, below_good, below_bad = -1.0, [], 0, 0
    for c in range(-half, half + 2):  # cells below c are rejected
        value = (good - below_good) / good + below_bad / bad
        if value > best + 1e-12:
            best, at = value, [c]
        elif value > best - 1e-12 and at and at[-1] == c - 1:
            at.append(c)
        g, b = counts.get(c, (0, 0))
        below_good, below_bad = below_good + g, below_bad + b
    return (at[len(at) // 2] - 0.5) * params.span / half


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], params: UrlModelParams = UrlModelParams()) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``url_score``.

    ``rules`` decide first; the urls they decide train one model of accepted and one of rejected urls,
    over whole urls, lower-cased. A url without a rule is allowed if its mean log-likelihood ratio per character
    reaches the calibrated threshold. Without urls of both kinds to learn from, it is allowed.

    Different urls are learned from and scored once, however often they occur. A null url counts as empty and is
    scored like one. Columns of the new names are replaced, others pass through; an empty table gives an
    empty result.
    """
    new = ["host", "path", "rule", "verdict", "url_score"]
    kept = pages.drop(*new)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = (
        kept.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "__ruled": verdict})
        .withColumns({"__a": F.xxhash64(url), "__b": F.xxhash64(F.lit(1), url, F.length(url))})
    )
    urls = ruled.groupBy(F.col("__a").alias("a"), F.col("__b").alias("b")).agg(
        F.first(url).alias("url"), F.first(F.col("__ruled") == ALLOW).alias("accepted")
    )
    scores = cut_lineage(url_scores(cut_lineage(urls), params))
    kinds = scores.agg(F.max(F.when(F.col("trained"), F.col("accepted").cast("int"))).alias("most"),
                       F.min(F.when(F.col("trained"), F.col("accepted").cast("int"))).alias("least")).first()
    both = kinds["most"] == 1 and kinds["least"] == 0
    least = threshold(scores, params) if both else float("-inf")
    rows = ruled.join(scores.select(F.col("a").alias("__a"), F.col("b").alias("__b"), F.col("score").alias("url_score")), ["__a", "__b"], "left")
    by_model = F.when(F.col("url_score") >= F.lit(least), F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return rows.withColumn("verdict", F.coalesce("__ruled", by_model)).select(*kept.columns, *new)
