"""Formats told by expressions against the parsers, and JSON with something behind it."""

from pyspark.sql import functions as F

from gleaner.functions.formats import format_of
from gleaner.functions.jsontext import strict_json, strict_json_sql
from gleaner.operators.parsers import parse_payload
from test_shred import FORMATS

MORE = [
    b"", b"  \n ", b"{bad", b"[1]\n[2]", b'{"a":1}\nx', b'{"a":1}],[2', b"<3 you", b'<?xml version="1.0"?><a><b></a>', b'<?xml version="1.0"?><a><b/></a>',
    b"<rss><x>1</x></rss>", b"<p>hi", b"a,b\n1,2", b"a,b\n", b"a,b\n\n1,2\n", b"a,a\n1,2", b"a,b\n1,2,3", b'"a,x",b\n"1\n2",3', b"a" * 61 + b",b\n1,2",
    b"# T\nx", b"T\n===\nx", b"T\n---\nx", b"x,\ny", b"\n" * 120 + b"# late", b"\xff\xfe,\nab,c", "é,b\n1,2".encode(), b' <?XML version="1.0"?><a/>',
    b'<feed xmlns="http://x"><e/></feed>', b'["a"', b"plain", b"a,b\r\n1,2\r\n", b"####### no", b"#no\n# yes", b'{"t": "' + b"a,:" * 100_000 + b'"}',
]


def test_formats(spark):
    bodies = [b if isinstance(b, bytes) else b.encode() for b, *_ in FORMATS] + MORE
    rows = [(i, bytearray(b), parse_payload(b)[0]) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "id int, body binary, want string").withColumn("got", format_of(F.col("body")))
    assert df.filter("not (got <=> want)").collect() == []
    assert spark.createDataFrame([(None,)], "body binary").select(format_of(F.col("body")).alias("f")).first().f is None


def test_strict_json(spark):
    texts = {'{"a": 1}': True, ' [1, 2] \n': True, '"x"': True, "5": True, "null": True, '{"a": 1} x': False, "1, 2": False, "[1] [2]": False, '{"a": 1}], [': False, "": False, "{": False, '1,"end of payload"': False}
    df = spark.createDataFrame([(t, ok) for t, ok in texts.items()], "t string, ok boolean")
    df = df.withColumns({"x": strict_json(F.col("t")).isNotNull(), "y": F.expr(f"{strict_json_sql('t')} is not null")})
    assert df.filter("x != ok or y != ok").collect() == []


def test_ndjson_list(spark):
    from gleaner.functions.formats import ndjson_list

    texts = {'{"a": 1}\n\n  [2, 3]\r\n"x"\n': '[{"a": 1},[2, 3],"x"]', '{"a": 1}': None, '{"a": 1}\n{bad': None, "": None, '{"a": 1} 2\n3': None}
    df = spark.createDataFrame([(t, w) for t, w in texts.items()], "t string, want string")
    assert df.filter(~ndjson_list(F.col("t")).eqNullSafe(F.col("want"))).collect() == []
    assert spark.createDataFrame([(None,)], "t string").select(ndjson_list(F.col("t")).alias("l")).first().l is None
