"""The registered queries of this subpackage, next to their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import contaminated
from .embedding_duplicates import embedding_duplicates
from .fuzzy_lines import dedup_lines
from .hard_negatives import hard_negatives
from .mixing import mix
from .near_duplicates import near_duplicates
from .neighbours import search
from .prefix_trie import conversation_trie
from .quotations import quote, reply_conversations
from .secret_forest import findings, scan
from .sharding import shard
from .toxicity import held_out, judge
from .url_models import judge_urls
from .vectors import finite

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op5_near_duplicates",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON r.m = e2.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.m) AS component_id, d.doc_id = min(r.m) AS kept
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
""",
)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        F.col("rejected").cast("int").alias("predicted"),
    )


@query(
    "op6_decontamination",
    r"""
WITH t AS (
  SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (SELECT k, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x20\x09-\x0D]+') AS ws FROM t WHERE text IS NOT NULL AND id IS NOT NULL),
s AS (SELECT DISTINCT k, id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT id, count(*) AS n FROM s WHERE k = 'b' GROUP BY 1)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, n.n AS item_shingles
FROM s d JOIN s b ON d.k = 'd' AND b.k = 'b' AND d.sh = b.sh JOIN n ON n.id = b.id
GROUP BY 1, 2, 4 HAVING 100 * count(*) >= 80 * n.n
""",
)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op2_mixing",
    r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS s, coalesce(md5(text), '') AS m,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) AS t FROM documents),
n AS (SELECT s, sum(t)::DOUBLE AS tokens FROM d GROUP BY 1),
e AS (SELECT CASE WHEN max(tokens) / min(tokens) <= 2 THEN 0.0
                  ELSE 1 - ln(2.0) / ln(max(tokens) / min(tokens)) END AS alpha, sum(tokens) AS total FROM n),
q AS (SELECT s, tokens, pow(tokens / total, alpha) / sum(pow(tokens / total, alpha)) OVER () AS w FROM n, e),
b AS (SELECT max(tokens / w) AS budget FROM q),
p0 AS (SELECT s, tokens, w, budget * w / tokens AS p FROM q, b),
p AS (SELECT s, tokens, w, CASE WHEN abs(p - round(p)) < 1e-9 THEN round(p) ELSE p END AS p FROM p0),
x AS (SELECT d.*, p.tokens, p.w, p.p, unnest(range(0, CAST(ceil(p.p) AS BIGINT))) AS epoch FROM d JOIN p USING (s)),
h AS (SELECT *, md5(concat_ws('|', '13', epoch, coalesce(CAST(doc_id AS VARCHAR), ''), m)) AS h FROM x),
c AS (SELECT *, epoch * tokens + coalesce(sum(t) OVER (PARTITION BY s, epoch ORDER BY h
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM h)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS mix_epoch, CAST(t AS BIGINT) AS mix_tokens, w AS mix_weight,
       CAST(floor(start / (w * 1048576)) AS BIGINT) AS mix_block, md5('order|' || h) AS mix_order
FROM c WHERE start < p * tokens
""",
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).drop("text")


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).cast("long").alias("text_crc32"),
    )
    return shard(docs, ties=["text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))


@query("op4_fuzzy_lines")
def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def quoted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as mail: two turns of three quote the one before, and every third of these also
    what that one quoted, one level deeper."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("t1"))
    earlier = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("t2"))
    rows = turns.join(before, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
    hashed = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(9))
    quoted = F.when((hashed < 6) & F.col("t1").isNotNull(), F.concat_ws(
        "\n", F.when(hashed < 2, quote(F.col("t2"), 2)), quote(F.col("t1")), "text"))
    return rows.select("conv_id", "turn", "role", F.coalesce(quoted, "text").alias("text"))


@query("op7_quotations")
def op7_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_conversations(quoted_messages(spark, sf_dir))


URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


@query("op9_url_models")
def op9_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "url_score")


# Names that secrets are assigned to, and how one provider's keys begin.
SECRET_NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey", "access_key"]
PROVIDER_KEY = "^AKIA[A-Z0-9]{16}$"


def judged_findings(docs: DataFrame) -> DataFrame:
    """Labelled findings of two thirds of the documents: assigned to a secret's name or a provider's key."""
    found = findings(docs).filter(~held_out(F.col("doc_id")))
    secret = F.col("key").isin(SECRET_NAMES) | F.col("before").isin(SECRET_NAMES) | F.col("candidate").rlike(PROVIDER_KEY)
    return found.select("doc_id", "at", "candidate", secret.alias("secret"))


@query("op10_secret_forest")
def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan(docs, judged_findings(docs))
    return scanned.select("doc_id", "at", F.md5("candidate").alias("candidate_md5"), "key", "before", "score", "is_secret", held_out(F.col("doc_id")).alias("held_out"))


@query(
    "op11_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
""",
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings").filter(finite("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    vectors = given.select("vec_id", moved.alias("label"), whole.alias("values"))
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


@query(
    "op12_embedding_duplicates",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS m FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.m = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = r.vec_id) AS n_links, min(m) AS component_id, vec_id = min(m) AS kept
FROM r GROUP BY vec_id
""",
)
def op12_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    "op13_prefix_trie",
    r"""
WITH o AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(x ORDER BY i) AS xs FROM o GROUP BY 1),
h AS (SELECT conv_id, xs, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(conv_id::VARCHAR) + 1),
          lambda k: ascii(substr(conv_id::VARCHAR, k, 1))::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END))) % 4 AS h FROM l),
r AS (SELECT a.conv_id, list_concat(coalesce(b.xs, [])[1:a.h], a.xs[a.h + 1:]) AS xs
      FROM h a LEFT JOIN l b ON b.conv_id = a.conv_id - a.conv_id % 20),
e AS (SELECT conv_id, len(xs) AS n, unnest(range(0, len(xs) + 1)) AS depth, xs FROM r),
p AS (SELECT depth, xs[1:depth] AS k, conv_id, n FROM e),
g AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
        CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(k[depth].t, '[^\x20\x09-\x0D]+')) END AS w FROM p GROUP BY 1, 2),
c AS (SELECT g.*, (SELECT count(*) FROM g y WHERE y.depth = g.depth + 1 AND y.k[1:g.depth] = g.k) AS n_children FROM g)
SELECT a.conv_id, a.depth, u.conv_id AS parent_conv_id, a.n_convs, a.n_children,
       count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum((b.n_convs - 1) * b.w) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM c a LEFT JOIN c u ON u.depth = a.depth - 1 AND a.k[1:a.depth - 1] = u.k
JOIN c b ON b.depth >= a.depth AND b.k[1:a.depth] = a.k
GROUP BY a.conv_id, a.depth, u.conv_id, a.n_convs, a.n_children, a.ends_sha256, a.k
""",
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
