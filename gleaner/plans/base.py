"""Registration of queries next to their oracle SQL, and the inputs they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.rows import spread_costly
from ..session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows are checked."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's file, or its folder of files, as a stream."""
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    # a pattern: a stream's plain path must be a folder
    return reader.parquet(f"{sf_dir}/{name}[.]parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query's own files, inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, body``: one nested JSON document per order, built inside the row.

    The lists vary in length with the row's values. Building them from the order itself, not by
    grouping its line items, keeps a very large order from becoming one task's work.
    """
    orders = spread_costly(table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey as id",
        "o_custkey as ck",
        "o_orderstatus as st",
        "cast(round(o_totalprice * 100) as bigint) as cents",
        "cast(substring(o_orderpriority, 1, 1) as int) as code",
        "substring(o_orderpriority, 3) as label",
    )
    return orders.selectExpr(
        "id",
        """to_json(named_struct(
             'id', id,
             'customer', named_struct('key', ck, 'full.name', concat('Customer ', ck), 'rank', code),
             'status', st,
             'amounts', filter(array(
                named_struct('name', 'total', 'cents', cents, 'paid', st = 'F'),
                named_struct('name', 'rest', 'cents', cents % 1000, 'paid', cast(null as boolean)),
                named_struct('name', 'units', 'cents', id % 7, 'paid', false)),
                a -> a.name != 'rest' or cents % 2 = 0),
             'tags', filter(array(if(code <= 2, 'urgent', null), if(cents > 20000000, 'big', null), label),
                t -> t is not null),
             'groups', array(array(code, code + 1), array(code + 2)),
             'note', cast(null as string),
             'raw', concat('{"code": ', code, ', "flags": ["', st, '", "x"], "inner": "[', id % 10, ', 7]"}')
           ), map('ignoreNullFields', 'false')) as body""",
    )


# The same documents for the oracle: scalars per order (o), amounts (a) and tags (t) by position.
ORDER_DOCS_SQL = """
o AS (SELECT o_orderkey AS id, o_custkey AS ck, o_orderstatus AS st,
             CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             CAST(left(o_orderpriority, 1) AS INTEGER) AS code, substr(o_orderpriority, 3) AS label
      FROM orders),
a0 AS (SELECT id, 0 AS p, 'total' AS name, cents AS c, CASE WHEN st = 'F' THEN 'True' ELSE 'False' END AS paid FROM o
       UNION ALL SELECT id, 1, 'rest', cents % 1000, NULL FROM o WHERE cents % 2 = 0
       UNION ALL SELECT id, 2, 'units', id % 7, 'False' FROM o),
a AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p) - 1 AS pos FROM a0),
t0 AS (SELECT id, 0 AS p, 'urgent' AS tag FROM o WHERE code <= 2
       UNION ALL SELECT id, 1, 'big' FROM o WHERE cents > 20000000
       UNION ALL SELECT id, 2, label FROM o),
t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p) - 1 AS pos FROM t0)
"""


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as responses of a run: one per event, inputs repeat per user."""
    return as_responses(table(spark, sf_dir, "events"))


def as_responses(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id as index",
        "concat('https://shop.example.com/u/', user_id) as input",
        "if(event_type = 'click', concat('clicked ', event_id), props) as body",
        """map('Content-Type', 'application/json; charset=utf-8', 'Spb-Cost', cast(event_id % 30 as string),
               'SPB-Initial-Status-Code', if(event_id % 5 = 0, '429', '200'), 'Tag', event_type) as headers""",
        "if(event_type = 'error', 500, 200) as status_code",
        "if(event_type = 'error', 'HTTP 500', null) as error",
        "cast(null as string) as expected_ext",
        "event_id % 17 = 0 as skipped",
        "cast(ts as timestamp) as fetched_at",
        "cast(round(value * 10) as int) as latency_ms",
    )


RESPONSES_SQL = """
r AS (SELECT event_id AS index, 'https://shop.example.com/u/' || user_id AS input, user_id, event_type,
             CASE WHEN event_type = 'click' THEN 'clicked ' || event_id ELSE props END AS body,
             CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
             CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error,
             event_id % 17 = 0 AS skipped, ts AS fetched_at, CAST(round(value * 10) AS INTEGER) AS latency_ms
      FROM events)
"""
