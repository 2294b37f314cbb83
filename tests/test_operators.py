"""Operators on small inputs with known answers; order-dependent ones against brute force."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import kinds, text, urls
from gleaner.operators import crawl, inputs, ledger, links, ordered, shape
from gleaner.operators.payload import map_payload
from gleaner.operators.search import normalize_video_results
from gleaner.operators.shred import shred
from gleaner.sources import files, sitemaps


def apply(spark, column, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {type_}")
    return [r[1] for r in sorted(df.select("i", column(F.col("v"))).collect())]


def test_url_normalisation(spark):
    """Every combination of host spelling, path, query and fragment, against the rule written out."""
    hosts, paths = ["farm.test", "FARM.test:81"], ["", "/", "/barn", "/barn/", "/barn/index.html", "/INDEX.HTM", "/reindex.html", "/barn//"]
    cases = [("https", h, p, q, f) for h in hosts for p in paths for q in ("", "?row=3", "?row=3/") for f in ("", "#top")]

    def crawled(scheme, host, path, query, _):
        for name in ("/index.html", "/index.htm"):
            if path.lower().endswith(name):
                path = path[: -len(name)] + "/"
        return f"{scheme}://{host}{path.rstrip('/') or '/'}{query}"

    given = ["".join((s, "://", h, p, q, f)) for s, h, p, q, f in cases]
    assert apply(spark, urls.normalize_crawl_url, given) == [crawled(*c) for c in cases]
    batch = [f"{s}://{h.lower()}{p}{q}".rstrip("/") for s, h, p, q, _ in cases]
    assert apply(spark, urls.normalize_batch_url, [g.replace("https", "HttpS") for g in given]) == batch
    assert apply(spark, urls.normalize_batch_url, ["two words", "X-77/"]) == ["two words", "X-77/"]
    ids = ["Ab3_-" + "x" * 6, "0" * 11]
    shapes = ["https://www.youtube.com/watch?v={}&n=2", "https://youtu.be/{}", "http://youtube.com/embed/{}?a", "youtube.com/shorts/{}", "{}"]
    assert apply(spark, urls.video_id, [s.format(i) for i in ids for s in shapes]) == [i for i in ids for _ in shapes]
    plain = [f"https://farm.test/{chr(c)}" for c in range(33, 400)] + [f"https://farm.test/%{c:02X}" for c in range(256)]
    want = [c < 127 for c in range(33, 400)] + [32 <= c < 127 for c in range(256)]
    # a "#" starts the fragment, which is not looked at; "%" alone is printable
    assert apply(spark, urls.is_plain_ascii_url, plain) == want


def test_join_url_like_the_standard_library(spark):
    from urllib.parse import urljoin

    bases = ["https://h.com", "https://h.com/a/b?q=1", "http://h.com:80/x/"]
    hrefs = ["c", "/c", "../c", "../../../c", "./c/./d", "?z=1", "#f", "//o.com/p/../q", "https://o.com/z", "c?x#y", "/a/b/..", "mailto:x@y.z", ""]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "b string, h string")
    for row in df.select("b", "h", urls.join_url(F.col("b"), F.col("h")).alias("j")).collect():
        assert row.j.rstrip("/") == urljoin(row.b, row.h).rstrip("/"), row


def test_kinds(spark):
    signs = {b"\x89PNG\r\n\x1a\n": "png", b"\xff\xd8\xff": "jpg", b"GIF87a": "gif", b"RIFF\x01\x02\x03\x04WEBP": "webp",
             b' \n{"barn": [1]}': "json", b"[3, 4]": "json", b"<html lang=x>": "html", b"\t<!doctype HTML>": "html", b"\x7f\x00\x01": None}
    tails = [b"", b"\x00\x05", b" and more text"]
    bodies = [(sign + tail, kind) for sign, kind in signs.items() for tail in tails]
    got = apply(spark, kinds.sniff_kind, [b for b, _ in bodies], "binary")
    assert [g for g, (b, k) in zip(got, bodies, strict=True) if k] == [k for _, k in bodies if k]
    assert got[-3:-1] == [None, None]
    types = {"application/json": "json", "text/html": "html", "nothing/known": "bin"}
    headers = [({name: value + more}, kind) for value, kind in types.items() for name in ("content-type", "CONTENT-TYPE") for more in ("", ";charset=x")]
    assert apply(spark, kinds.kind_from_content_type, [h for h, _ in headers], "map<string,string>") == [k for _, k in headers]
    texts = [(b"oats and barley " * n, True) for n in range(4)] + [(b"oats\0barley", False), (b"%PDF-1.7 x", False), (bytes(range(1, 9)) * 50, False)]
    assert apply(spark, kinds.is_text_payload, [t for t, _ in texts], "binary") == [w for _, w in texts]


def test_chunks_and_patterns(spark):
    cut = lambda value, size, overlap: apply(spark, lambda c: text.chunk_array(c, size, overlap), [value])[0]
    assert cut("abcdefghij", 4, 0) == ["abcd", "efgh", "ij"]
    assert cut("abcdefghij", 5, 2) == ["abcde", "defgh", "ghij", "j"]
    assert cut("abcdefghij", 0, 0) == ["abcdefghij"] and cut("", 5, 1) == [] and cut("", 0, 0) == [""]
    assert cut("abc", 2, 9) == ["ab", "bc", "c"]
    assert "".join(cut("żółw🐢" * 9, 7, 0)) == "żółw🐢" * 9
    assert apply(spark, text.split_lines, ["a\r\nb\rc\x0bd", "x\n", "", "\n\n"]) == [["a", "b", "c", "d"], ["x"], [], ["", ""]]
    test = lambda pattern, values: apply(spark, lambda c: text.matches(c, pattern), values)
    assert test("hello", ["say hello", "bye"]) == [True, False]
    assert test("*pat?ern[!x]*", ["a pattern_", "a patternx", "nope"]) == [True, False, False]
    assert test(r"/^https?:\/\/.*\.com$/", ["https://e.com", "ftp://e.com"]) == [True, False]
    assert test("/[invalid/", ["anything"]) == [False]


def test_wrapped_links(spark):
    bodies = [b"<a href='/x'>1</a><A class=k HREF=\"/y?a=1&amp;b=2\">", b"see [one](/a) [two]( /b ) [m](mailto:x) [t](#t)",
              json.dumps({"body": '<a href="/in">'}).encode(), b'{"body": "", "content": "[q](/q)"}', b'{"body": 5, "content": "<a href=\'/n\'>"}']
    assert apply(spark, links.page_links, bodies, "binary") == [["/x", "/y?a=1&b=2"], ["/a", "/b"], ["/in"], ["/q"], ["/n"]]


def test_order_helpers_against_brute_force(spark):
    rng = random.Random(1)
    # one key holds most rows, one instant many of them
    rows = [(i, "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 9)}", rng.choice([5, rng.randint(0, 99)]), rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, key string, at int, v long")
    total, want = 0, {}
    for n, (i, _, _, v) in enumerate(sorted(rows, key=lambda r: (r[2], r[0]))):
        total += v
        want[i] = (n, total)
    got = ordered.running_totals(ordered.numbered(df, ["at", "id"], "n"), ["at", "id"], {"sum": F.col("v")})
    assert {r.id: (r.n, r["sum"]) for r in got.collect()} == want
    last, want = {}, {}
    for i, key, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i], last[key] = last.get(key), v
    got = ordered.with_previous(df, "key", ["at", "id"], {"prev": "v"})
    assert {r.id: r.prev for r in got.collect()} == want
    newest = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]), reverse=True)[:50]]
    assert {r.id for r in ordered.first_n(df, ["at", "id"], 50, descending=True).collect()} == set(newest)
    many = ordered.numbered(df, ["at", "id"], "n", descending=True).filter("n < 50")
    assert {r.id for r in many.collect()} == set(newest)


def test_crawl_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(f"https://h.com/{rng.randint(0, 80)}/", i, f"https://h.com/{min(rng.randint(0, 80), rng.randint(0, 80))}#f") for i in range(160)]
    adjacency = {}
    for src, at, dst in edges:
        adjacency.setdefault(src.rstrip("/"), []).append((at, dst.split("#")[0]))
    for limit in (0, 1, 2):
        depth, order, level = {"https://h.com/0": 0}, ["https://h.com/0"], ["https://h.com/0"]
        while level and (limit == 0 or depth[level[0]] < limit):
            found = {}
            for rank, page in enumerate(level):
                for at, dst in adjacency.get(page, []):
                    if dst not in depth:
                        found[dst] = min(found.get(dst, (rank, at)), (rank, at))
            fresh = sorted(found, key=lambda d: (found[d], d))
            for page in fresh:
                depth[page] = depth[level[0]] + 1
            level = fresh
            order += fresh
        links_df = spark.createDataFrame(edges, "src_url string, ord long, dst_url string")
        seeds = spark.createDataFrame([("https://h.com/0/index.html",)], "url string")
        for small in (100_000, 0):  # broadcast frontiers, then shuffled ones
            monkeypatch.setattr(crawl, "BROADCAST_URLS", small)
            walked = crawl.crawl_frontier(links_df, seeds, limit, ranked=True)
            assert [r.key for r in walked.orderBy("depth", "rank").collect()] == order
        assert [r.key for r in crawl.cap_pages(walked, 5).orderBy("depth", "rank").collect()] == order[:5]


def test_urls_seen_before_stay_in_place(spark, monkeypatch, capsys):
    seen = spark.createDataFrame([(f"u{i}",) for i in range(50)] + [(None,)], "key string")
    found = spark.createDataFrame([(f"u{i}", i) for i in range(40, 60)] + [(None, -1)], "key string, n long")
    for small, shuffled in ((100, False), (30, False), (0, True)):
        monkeypatch.setattr(crawl, "BROADCAST_URLS", small)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            left = crawl._unseen(found, seen, 51)
            left.explain()
            assert sorted(r.n for r in left.collect()) == list(range(50, 60))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert ("Exchange hashpartitioning" in capsys.readouterr().out) == shuffled


def test_file_sources(spark, tmp_path):
    (tmp_path / "in.txt").write_text("  a \n\n\tb\n   \nc")
    assert [tuple(r) for r in files.read_input_lines(spark, str(tmp_path / "in.txt")).orderBy("index").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    (tmp_path / "many").mkdir()
    for name, lines in {"a": 30, "b": 2000, "c": 3}.items():
        (tmp_path / "many" / name).write_text("".join(f"{name}{i}\n" for i in range(lines)))
    many = files.read_input_lines(spark, str(tmp_path / "many")).orderBy("index").collect()
    assert [r.input for r in many] == [f"{n}{i}" for n, k in (("a", 30), ("b", 2000), ("c", 3)) for i in range(k)]
    (tmp_path / "empty.txt").write_text("\n \n")
    with pytest.raises(ValueError):
        files.read_input_lines(spark, str(tmp_path / "empty.txt"))
    (tmp_path / "t.csv").write_text('url,name\nhttps://a.com,"A, ""x"""\nhttps://b.com,\n,C\n')
    read = lambda *args: [r.input for r in files.read_input_column(spark, str(tmp_path / "t.csv"), *args).orderBy("index").collect()]
    assert read() == ["https://a.com", "https://b.com"] and read("name") == ['A, "x"', "C"] and read(1) == ['A, "x"', "C"]
    with pytest.raises(ValueError):
        read("nope")
    (tmp_path / "bare.csv").write_text("https://a.com,1\nhttps://b.com,2\n")
    bare = files.read_input_column(spark, str(tmp_path / "bare.csv"))
    assert [r.input for r in bare.orderBy("index").collect()] == ["https://a.com", "https://b.com"]
    batch = tmp_path / "batch"
    (batch / "screenshots").mkdir(parents=True)
    for name, body in {"2.json": "{}", "10.html": "x", "3.err": "e", "note.txt": "n", "screenshots/1.png": "p"}.items():
        (batch / name).write_text(body)
    payloads = files.read_payload_dir(spark, str(batch)).orderBy("n").collect()
    assert [(r.n, r.file, r.ext) for r in payloads] == [(1, "screenshots/1.png", "png"), (2, "2.json", "json"), (10, "10.html", "html")]
    (batch / "manifest.json").write_text(json.dumps({"https://a.com": "1.json", "https://b.com": {"file": "2.json", "http_status": 200}}, indent=2))
    manifest = files.read_manifest(spark, str(batch / "manifest.json")).orderBy("input").collect()
    assert [(r.input, r.file, r.http_status) for r in manifest] == [("https://a.com", "1.json", None), ("https://b.com", "2.json", 200)]
    day = "2024-01-0{}T10:00:00+00:00 | post-process | jq .title |  | "
    (tmp_path / "audit.log").write_text("\n".join([day.format(1), "broken | x", day.format(2), day.format(3)]) + "\n")
    utc = dt.timezone.utc
    window = dict(since=dt.datetime(2024, 1, 1, 10, tzinfo=utc), until=dt.datetime(2024, 1, 2, 10, tzinfo=utc))
    assert files.read_audit_log(spark, str(tmp_path / "audit.log"), **window).count() == 2
    assert files.read_audit_log(spark, str(tmp_path / "audit.log"), n=3).count() == 3


def test_malformed_sitemap_gives_no_rows(spark):
    df = spark.createDataFrame([("u1", "<urlset><url><loc> a </loc></url></urlset>"), ("u2", "<urlset><url>")], "url string, body string")
    assert [(r.url, r.page_url) for r in sitemaps.sitemap_urls(df, "url", "body").collect()] == [("u1", "a")]


def cells(spark, document, **kwargs):
    df = spark.createDataFrame([(1, json.dumps(document))], "id long, body string")
    return [r.cells for r in shape.flatten_records(shred(df, "body", "json", paths=True), "id", **kwargs).orderBy("rec").collect()]


def flat(value, depth, level=0, prefix=""):
    """Dotted cells of a record, by a plain walk; lists of scalars are shown as Python shows them."""
    out = {}
    for key, inner in value.items() if isinstance(value, dict) else enumerate(value):
        name = f"{prefix}{key}"
        if isinstance(inner, dict) and level < depth:
            out |= flat(inner, depth, level + 1, name + ".")
        elif isinstance(inner, list) and any(isinstance(x, (dict, list)) for x in inner) and level < depth:
            out |= flat(inner, depth, level, name + ".")
        elif isinstance(inner, dict) or isinstance(inner, list) and any(isinstance(x, (dict, list)) for x in inner):
            out[name] = json.dumps(inner)
        else:
            out[name] = "" if inner is None or inner == [] else str(inner)
    return out


def test_flattening(spark):
    rng = random.Random(17)

    def record(level):
        names = rng.sample(["oat", "barley", "well", "gate", "shed"], rng.randint(1, 4))
        made = {}
        for n in names:
            kind = rng.random()
            if level < 4 and kind < 0.35:
                made[n] = record(level + 1)
            elif level < 4 and kind < 0.55:
                made[n] = [record(level + 1) for _ in range(2)]
            else:
                made[n] = rng.choice([4, 2.5, "rye", "", None, True, [], [1, "x"]])
        return made

    for at in range(12):
        document = {"id": at, "part": record(1)}  # an id beside it, so that no inner list is taken for the records
        for depth in (1, 2, 5):
            assert cells(spark, document, max_depth=depth) == [flat(document, depth)], (document, depth)
    deep = {"v": 1}
    for _ in range(120):
        deep = {"k": deep}
    with pytest.raises(Exception, match="exceeds the default"):
        cells(spark, deep)
    assert cells(spark, deep, max_depth=200) == [{".".join(["k"] * 120) + ".v": "1"}]
    assert cells(spark, [{"oat": 1}, 5, {"oat": 2}]) == [{"oat": "1"}, {"oat": "2"}]


def test_records_and_columns(spark):
    harvests = {1: {"rows": [{"crop": "oat"}, {"crop": "rye"}], "count": 2}, 2: {"barn": "north", "tons": 7.5}, 3: 5, 4: "torn"}
    docs = [(i, json.dumps(d) if i < 4 else "{torn") for i, d in harvests.items()]
    trees = shred(spark.createDataFrame(docs, "id long, body string"), "body", "json", paths=True)
    want = [(1, json.dumps(r)) for r in harvests[1]["rows"]] + [(2, json.dumps(harvests[2]))]
    assert sorted((r.id, r.record) for r in shape.explode_records(trees, "id").collect()) == want
    rows = shape.flatten_records(trees, "id").cache()
    assert shape.column_names(rows, ["id", "rec"]) == ["crop", "barn", "tons"]
    wide = shape.union_columns(rows, ["id", "rec"]).collect()
    assert sorted(tuple(r) for r in wide) == [("", "north", "7.5"), ("oat", "", ""), ("rye", "", "")]
    with pytest.raises(ValueError, match="crop, barn, tons"):
        shape.select_columns(rows, ["silo"], "id", "rec")
    bare = shred(spark.createDataFrame([('{"oat": 1, "rye": "", "all": []}',)], "body string"), "body", "json", paths=True)
    with pytest.raises(ValueError, match="no row"):
        shape.select_columns(shape.flatten_records(bare), ["rye"])


def test_small_ledger_pieces(spark):
    seconds = [5.9, 60.0, 190.0, 3600.0, 7500.0, -1.0]
    assert apply(spark, ledger.eta_text, seconds, "double") == ["5s", "1m", "3m 10s", "1h", "2h 5m", "—"]
    headers = [{"Spb-Cost": "5"}, {"SPB-COST": "x"}, {"a": "1"}, {"spb-cost": ""}]
    assert apply(spark, ledger.credits_from_headers, headers, "map<string,string>") == [5, None, None, None]
    df = spark.createDataFrame([(1, b"ab"), (2, b"x")], "id long, body binary")

    def shout(body):
        if body == b"x":
            raise ValueError
        return body.upper()

    assert dict(map_payload(df, "body", shout).collect()) == {1: b"AB", 2: b"x"}


def test_video_results_leave_others_alone(spark):
    item = {"videoId": "v1", "title": {"runs": [{"text": "T"}]}, "longBylineText": {}, "ownerText": {"runs": [{"text": "O"}]}}
    bodies = [json.dumps({"results": json.dumps([item, {"x": 1}, 7]), "search": "q"}), '{"results": [1]}', '{"results": "oops"}', "no json"]
    got = apply(spark, lambda c: c, bodies)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i long, body string")
    out = [r.body for r in normalize_video_results(df, "body").orderBy("i").collect()]
    first = json.loads(out[0])
    assert first["search"] == "q" and first["results"] == [
        {"link": "https://www.youtube.com/watch?v=v1", "video_id": "v1", "title": "T", "channel": "O", "views": "", "published": "", "duration": ""}]
    assert out[1:] == got[1:]


def test_dedupe_report(spark):
    df = spark.createDataFrame([("https://A.com/",), ("https://a.com",), ("x",)], "u string")
    assert tuple(inputs.dedupe_report(df, "u").first()) == (3, 2, 1)


def test_crawl_edges_are_read_from_columns(spark):
    """Links that occur twice, in other spellings and with null places: the smallest place and its URL as first found."""
    from gleaner.operators import crawl

    edges = [("https://h.com/a/", 3, "https://h.com/b#x"), ("https://h.com/a", None, "https://h.com/b/"), ("https://h.com/a", 1, "https://h.com/b"), ("https://h.com/a", 2, "https://h.com/c/index.html")] * 2
    links_df = spark.createDataFrame(edges, "src_url string, ord long, dst_url string")
    seeds = spark.createDataFrame([("https://h.com/a",)], "url string")
    plans, write = [], crawl.cut_to_files
    crawl.cut_to_files = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)
    try:
        walked = crawl.crawl_frontier(links_df, seeds, ranked=True)
    finally:
        crawl.cut_to_files = write
    assert sorted(tuple(r) for r in walked.collect()) == [
        ("https://h.com/a", "https://h.com/a", 0, 0), ("https://h.com/b", "https://h.com/b/", 1, 0), ("https://h.com/c", "https://h.com/c/index.html", 1, 1)
    ]
    assert len(plans) == 1 and "Aggregate" not in plans[0]  # no pass that sorts all links twice
