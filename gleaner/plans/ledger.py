"""Run ledger (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger
from .base import RESPONSES_SQL, event_responses, query, table


@query(
    "build_manifest",
    f"""WITH {RESPONSES_SQL}, g AS (SELECT *, count(*) OVER (PARTITION BY input) AS responses,
        row_number() OVER (PARTITION BY input ORDER BY index DESC) AS rn FROM r WHERE error IS NULL AND NOT skipped)
    SELECT input, (index + 1) || '.json' AS file, fetched_at, status_code AS http_status, CAST(index % 30 AS INTEGER) AS credits_used, latency_ms,
           sha256(body) AS content_sha256, responses FROM g WHERE rn = 1""",
)
def build_manifest(spark, sf):
    return ledger.build_manifest(event_responses(spark, sf)).withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


@query("content_hash", "SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def content_hash(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_sha256"))


@query(
    "carry_forward_manifest",
    """SELECT 'https://a.com/' || c_custkey AS input, CASE WHEN c_custkey % 2 = 0 THEN 'new/' ELSE 'old/' END || c_custkey || '.json' AS file
       FROM customer WHERE c_custkey % 2 = 0 OR (c_custkey % 3 = 0 AND c_custkey % 5 <> 0)""",
)
def carry_forward_manifest(spark, sf):
    customers = table(spark, sf, "customer")
    entries = lambda folder: customers.selectExpr(
        "c_custkey", "concat('https://a.com/', c_custkey) as input", f"concat('{folder}/', c_custkey, '.json') as file"
    )
    new = entries("new").filter("c_custkey % 2 = 0").drop("c_custkey")
    old = entries("old").filter("c_custkey % 3 = 0").drop("c_custkey")
    skipped = entries("x").filter("c_custkey % 5 != 0").select("input")
    return ledger.carry_forward_manifest(new, old, skipped)


@query(
    "failures",
    f"WITH {RESPONSES_SQL} SELECT index + 1 AS index, input, error, status_code, body FROM r WHERE error IS NOT NULL AND NOT skipped",
)
def failures(spark, sf):
    return ledger.failures(event_responses(spark, sf))


@query(
    "classify_status",
    """SELECT event_id AS index, CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 404 ELSE 200 END AS status_code,
       CASE event_type WHEN 'error' THEN 'HTTP 500' WHEN 'view' THEN 'HTTP 404' END AS error FROM events""",
)
def classify_status(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id as index", "case event_type when 'error' then 500 when 'view' then 404 else 200 end as status_code",
        "cast(null as string) as error",
    )
    return ledger.classify_status(rows)


def _runs(spark, sf):
    rows = event_responses(spark, sf).selectExpr(
        "*", "date_format(fetched_at, 'yyyy-MM-dd HH') as run", "concat('scrape --part ', index) as command"
    )
    return ledger.run_summary(rows, "run", "command", "fetched_at")


_RUNS_SQL = f"""{RESPONSES_SQL}, s AS (SELECT strftime(fetched_at, '%Y-%m-%d %H') AS run, count(*) AS total, count(*) FILTER (error IS NULL) AS succeeded,
    count(*) FILTER (error IS NOT NULL) AS failed, arg_min('scrape --part ' || index, fetched_at) AS command, min(fetched_at) AS created_at FROM r GROUP BY 1)"""


@query("run_summary", f"WITH {_RUNS_SQL} SELECT * FROM s")
def run_summary(spark, sf):
    return _runs(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("incomplete_runs", f"WITH {_RUNS_SQL} SELECT run, total, succeeded, failed, command FROM s WHERE succeeded < total ORDER BY created_at DESC, run LIMIT 10")
def incomplete_runs(spark, sf):
    return ledger.incomplete_runs(_runs(spark, sf)).drop("created_at")


@query(
    "resume_pending",
    f"WITH {RESPONSES_SQL} SELECT index, input FROM r WHERE error IS NOT NULL OR skipped",
)
def resume_pending(spark, sf):
    responses = event_responses(spark, sf)
    done = responses.filter("error is null and not skipped").selectExpr("index + 1 as n")
    return ledger.resume_pending(responses.select("index", "input"), done)


def _refresh(spark, sf):
    """Orders as a text table; fresh results for some customers, one of them the last."""
    orders = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as o_orderkey", "concat(' ', o_custkey, ' ') as customer", "o_orderstatus as status"
    )
    customers = table(spark, sf, "customer").filter("c_custkey % 2 = 0")
    fresh = customers.selectExpr(
        "explode(array(0, 1)) as late", "cast(c_custkey as string) as input", "c_custkey", "c_mktsegment", "c_nationkey"
    ).selectExpr(
        "c_custkey * 2 + late as index", "input", "false as skipped",
        "if(c_custkey % 10 = 4, 'HTTP 500', null) as error",
        """if(c_custkey % 10 = 6, '["no object"]', concat('{"segment": "', if(late = 1, c_mktsegment, 'stale'), '", "geo": {"nation": ', c_nationkey, '}',
              if(c_custkey % 10 = 2, ', "status": "updated"', ''), '}')) as body""",
    )
    return orders, fresh


@query(
    "refresh_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, ' ' || o_custkey || ' ' AS customer,
        CASE WHEN o_custkey % 10 = 2 AND c_custkey IS NOT NULL THEN 'updated' ELSE o_orderstatus END AS status,
        CASE WHEN o_custkey % 10 IN (0, 2, 8) AND c_custkey IS NOT NULL THEN c_mktsegment ELSE '' END AS segment,
        CASE WHEN o_custkey % 10 IN (0, 2, 8) AND c_custkey IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS "geo.nation"
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def refresh_table(spark, sf):
    orders, fresh = _refresh(spark, sf)
    return ledger.refresh_table(orders, "customer", fresh, ["o_orderkey"])


@query(
    "refresh_counts",
    """SELECT (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 2 = 0 AND c_custkey % 10 <> 4) AS succeeded,
              (SELECT 2 * count(*) FROM customer WHERE c_custkey % 10 = 4) AS failed""",
)
def refresh_counts(spark, sf):
    orders, fresh = _refresh(spark, sf)
    return ledger.refresh_counts(orders, "customer", fresh)


@query(
    "credits_from_headers",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 30 AS INTEGER) WHEN event_id % 4 = 1 THEN 12 END AS credits FROM events""",
)
def credits_from_headers(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        """case event_id % 4 when 0 then map('SPB-COST', cast(event_id % 30 as string)) when 1 then map('x', 'y', 'spb-cost', ' 12 ')
             when 2 then map('Spb-Cost', 'many') else map('x', '5') end as headers""",
    )
    return rows.select("event_id", ledger.credits_from_headers(F.col("headers")).alias("credits"))


_COMMANDS = "element_at(array('google', 'amazon-search', 'youtube-search', 'fast-search', 'walmart-product', 'none'), cast(event_id % 6 + 1 as int)) as command"


@query(
    "estimate_cost",
    """WITH c AS (SELECT ['google', 'amazon-search', 'youtube-search', 'fast-search', 'walmart-product', 'none'][event_id % 6 + 1] AS command,
        CASE WHEN event_type = 'view' THEN [15, 15, 5, 10, 15, NULL][event_id % 6 + 1] ELSE [10, 5, 5, 10, 10, NULL][event_id % 6 + 1] END AS credits FROM events)
    SELECT command, count(*) AS requests, CAST(sum(credits) AS BIGINT) AS credits FROM c GROUP BY command""",
)
def estimate_cost(spark, sf):
    rows = table(spark, sf, "events").selectExpr(_COMMANDS, "if(event_type = 'view', false, if(event_type = 'error', true, null)) as light")
    return ledger.estimate_cost(rows, ledger.command_credits(F.col("command"), F.col("light")), "command")


@query(
    "estimate_web_cost",
    """WITH c AS (SELECT ['default', 'premium', 'stealth'][event_id % 3 + 1] AS tier, event_type = 'view' AS js,
        CASE WHEN event_type = 'view' THEN [5, 25, 75][event_id % 3 + 1] ELSE [1, 10, 75][event_id % 3 + 1] END AS credits FROM events)
    SELECT tier, js, count(*) AS requests, CAST(sum(credits) AS BIGINT) AS credits FROM c GROUP BY tier, js""",
)
def estimate_web_cost(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "element_at(array('default', 'premium', 'stealth'), cast(event_id % 3 + 1 as int)) as tier", "event_type = 'view' as js"
    )
    return ledger.estimate_cost(rows, ledger.web_credits(F.col("tier"), F.col("js")), "tier", "js")


@query(
    "budget_check",
    """SELECT CAST(sum(event_id % 3) AS BIGINT) AS need, (SELECT CAST(count(*) AS BIGINT) * 10 FROM customer) AS balance,
       CASE WHEN (SELECT count(*) * 10 FROM customer) < 100 THEN 'low_balance'
            WHEN sum(event_id % 3) > (SELECT count(*) * 10 FROM customer) THEN 'over_budget' ELSE 'ok' END AS verdict FROM events""",
)
def budget_check(spark, sf):
    costs = table(spark, sf, "events").selectExpr("event_id % 3 as credits")
    quota = table(spark, sf, "customer").agg((F.count("*") * 10).alias("credits"))
    return ledger.budget_check(costs, quota)


@query(
    "progress_stats",
    f"""WITH {RESPONSES_SQL}, p AS (SELECT index, fetched_at, count(*) OVER w AS completed, sum(CASE WHEN error IS NOT NULL AND NOT skipped THEN 1 ELSE 0 END) OVER w AS failed,
        (epoch_us(fetched_at) - epoch_us(min(fetched_at) OVER ())) / 1000000.0 AS elapsed, count(*) OVER () AS n
        FROM r WINDOW w AS (ORDER BY fetched_at, index ROWS UNBOUNDED PRECEDING))
    SELECT index, completed, CAST(failed AS BIGINT) AS failed, elapsed, CASE WHEN elapsed > 0 THEN completed / elapsed END AS per_second,
           CASE WHEN elapsed > 0 AND n > completed THEN (n - completed) / (completed / elapsed) END AS eta_seconds,
           CASE WHEN failed > 0 THEN failed / completed * 100 END AS failure_pct FROM p""",
)
def progress_stats(spark, sf):
    responses = event_responses(spark, sf).select("index", "fetched_at", "error", "skipped")
    stats = ledger.progress_stats(responses, "fetched_at", ["fetched_at", "index"])
    return stats.drop("fetched_at", "error", "skipped")


_ATTEMPTS = [
    "concat('u', user_id) as input",
    "event_id as attempt",
    "element_at(array('default', 'premium', 'stealth'), cast(event_id % 3 + 1 as int)) as tier",
    "case event_type when 'error' then 500 when 'click' then 503 else 200 end as status_code",
    "case event_type when 'error' then 403 when 'click' then 429 when 'view' then 404 else null end as target_status",
]
_ATTEMPTS_SQL = """
t AS (SELECT 'u' || user_id AS input, event_id AS attempt, ['default', 'premium', 'stealth'][event_id % 3 + 1] AS tier, event_id % 3 AS rank,
        CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 503 ELSE 200 END AS status_code,
        CASE event_type WHEN 'error' THEN 403 WHEN 'click' THEN 429 WHEN 'view' THEN 404 END AS target_status FROM events)
"""


@query(
    "final_attempt",
    f"""WITH {_ATTEMPTS_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY input ORDER BY status_code >= 500,
        CASE WHEN status_code < 500 THEN attempt ELSE -attempt END) AS rn FROM t)
    SELECT input, attempt, status_code FROM f WHERE rn = 1""",
)
def final_attempt(spark, sf):
    attempts = table(spark, sf, "events").selectExpr(*_ATTEMPTS).select("input", "attempt", "status_code")
    return ledger.final_attempt(attempts)


@query(
    "escalation_outcome",
    f"""WITH {_ATTEMPTS_SQL}, l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY input, tier ORDER BY attempt DESC) = 1),
    b AS (SELECT *, coalesce(target_status IN (403, 429), false) AS blocked FROM l)
    SELECT input, tier, attempt, blocked FROM b
    QUALIFY row_number() OVER (PARTITION BY input ORDER BY blocked, CASE WHEN blocked THEN -rank ELSE rank END) = 1""",
)
def escalation_outcome(spark, sf):
    attempts = table(spark, sf, "events").selectExpr(*_ATTEMPTS)
    # one attempt per tier: the last one made with it
    last = attempts.groupBy("input", "tier").agg(F.max_by(F.struct("attempt", "target_status"), "attempt").alias("a")).select("input", "tier", "a.*")
    return ledger.escalation_outcome(last).select("input", "tier", "attempt", "blocked")


@query(
    "content_changes",
    """WITH b AS (SELECT doc_id, text AS body FROM documents WHERE doc_id % 5 <> 0),
    a AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN text || '!' ELSE text END AS body FROM documents WHERE doc_id % 7 <> 0)
    SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'new' WHEN a.doc_id IS NULL THEN 'gone'
        WHEN a.body <> b.body THEN 'changed' ELSE 'unchanged' END AS state FROM a FULL JOIN b ON a.doc_id = b.doc_id""",
)
def content_changes(spark, sf):
    docs = table(spark, sf, "documents")
    before = docs.filter("doc_id % 5 != 0").selectExpr("doc_id", "text as body")
    after = docs.filter("doc_id % 7 != 0").selectExpr("doc_id", "if(doc_id % 4 = 0, concat(text, '!'), text) as body")
    return ledger.content_changes(before, after, "doc_id", "body").select("doc_id", "state")


@query(
    "value_changes",
    """SELECT event_id, user_id, value, lag(value) OVER w AS previous, coalesce(lag(value) OVER w <> value, false) AS changed
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def value_changes(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return ledger.value_changes(events, "user_id", ["ts", "event_id"], "value").drop("ts")


@query(
    "duplicate_content",
    """SELECT sha256(text) AS content_sha256, count(*) AS copies, min(doc_id) AS first, max(doc_id) AS last
       FROM documents GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_content(spark, sf):
    return ledger.duplicate_content(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "latency_report",
    f"""WITH {RESPONSES_SQL} SELECT status_code, count(*) AS items, count(*) FILTER (error IS NOT NULL) AS failed, min(latency_ms) AS min_ms,
       quantile_disc(latency_ms, 0.5) AS p50_ms, quantile_disc(latency_ms, 0.95) AS p95_ms, max(latency_ms) AS max_ms FROM r GROUP BY status_code""",
)
def latency_report(spark, sf):
    return ledger.latency_report(event_responses(spark, sf), "status_code")


@query(
    "header_summary",
    """SELECT event_id AS index, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 30 AS VARCHAR) END AS credit_cost,
        CASE WHEN event_id % 2 = 1 THEN ['10-15', '5-15', '5', '10', '10-15', NULL][event_id % 6 + 1] END AS estimated_cost,
        'https://final.example.com/' || user_id AS resolved_url, CASE WHEN event_id % 5 = 0 THEN '429' END AS target_status, event_type AS tag FROM events""",
)
def header_summary(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id as index", _COMMANDS,
        """map('SPB-Cost', if(event_id % 2 = 0, cast(event_id % 30 as string), ''), 'spb-resolved-url', concat('https://final.example.com/', user_id),
               'Spb-Initial-Status-Code', if(event_id % 5 = 0, '429', ''), 'TAG', event_type) as headers""",
    )
    return ledger.header_summary(rows, "headers", "command", "index")
