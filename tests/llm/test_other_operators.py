"""Pages, archives, chats, nearest neighbours, the pipeline and the registered queries."""

from __future__ import annotations

import hashlib
import json
import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tasteframe.llm import chat, html_text, neighbours, queries, warc
from tasteframe.shipping import ship
from tests.llm.conftest import DOCS, rows_of

DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, record string, digest string"


@pytest.fixture(scope="module")
def pages(spark):
    ship(spark)
    big = "".join(f"<p>line {i} of a long page</p>" for i in range(20_000))
    rows = [(1, "u1", "<p>twin page</p>" * 20), (2, "u2", "<p>twin page</p>" * 20), (3, "u3", None), (4, None, ""), (5, "u5", "x" * 99), (6, "u6", "x" * 99), (7, "u7", "é" * 50), (8, "u8", "é" * 50),
            (9, "u9", big), (10, "u10", big), (11, "u11\nwith: breaks", "<article><p>Short.</p></article>"), (None, "u12", big), (None, None, "no id"), (11, "u11\nwith: breaks", "<article><p>Short.</p></article>")]
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], PAGES)


# archives


def test_archives_round_trip(pages):
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.record) for r in warc.round_trip(pages, 1000).collect()]
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").toArrow())
    assert sorted(map(repr, got)) == sorted(map(repr, con.execute(warc.ORACLE).fetchall()))
    by = {(r[0], r[5]): r for r in got}
    assert {r[0]: r[4] for r in got if r[3] == "revisit"} == {2: 1, 8: 7, 10: 9, None: 9}
    assert len(by) == 13 and len(got) == 14


def test_archive_is_a_warc_stream_and_damage_is_seen(pages, spark):
    path = spark.conf.get("spark.checkpoint.dir") + f"/archive-{os.urandom(4).hex()}"
    warc.write_archives(pages.filter("page_id in (9, 10, 11)").dropDuplicates(["page_id"]), path, 1000)
    table = spark.read.parquet(path)
    rows = {}
    for r in table.orderBy("record", "chunk").collect():
        rows.setdefault(r.record, []).append((r.header, r.data, r.last))
        assert r.data is None or len(r.data) <= 1000
    big = next(v for k, v in rows.items() if k.startswith("9-"))
    stream = warc.record_bytes([(bytes(h) if h else None, bytes(d) if d else None, last) for h, d, last in big])
    head, _, rest = stream.partition(b"\r\n\r\n")
    fields = warc.parse_header(head + b"\r\n\r\n")
    payload = rest[: int(fields["content-length"])]
    assert rest[len(payload) :] == b"\r\n\r\n" and fields["warc-payload-digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
    of_9 = next(k for k in rows if k.startswith("9-"))
    assert [warc.parse_header(bytes(r.header))["warc-refers-to"] for r in table.filter("data is null").collect()] == [f"<urn:page:{of_9}>"]
    for damaged in (table.filter("chunk <> 3"), table.withColumn("data", F.when(F.col("chunk") == 2, F.lit(b"zz")).otherwise(F.col("data")))):
        with pytest.raises(Exception, match="chunk|digest"):
            warc.read_archives(damaged).collect()


def test_every_repeated_row_of_many_chunks_comes_back(spark, pages):
    big = "a long page " * 500
    rows = [(1, "u", big)] * 3 + [(2, "v", big)] * 2 + [(None, "w", big + "!")] * 2 + [(3, None, big + "?"), (3, "None", big + "?")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.record) for r in warc.round_trip(table, 1000).collect()]
    con = duckdb.connect()
    con.register("pages", table.toArrow())
    assert len(got) == 9 and sorted(map(repr, got)) == sorted(map(repr, con.execute(warc.ORACLE).fetchall()))
    path = spark.conf.get("spark.checkpoint.dir") + f"/archive-{os.urandom(4).hex()}"
    warc.write_archives(table, path, 1000)
    archive = spark.read.parquet(path)
    assert archive.select("record").distinct().count() == 9
    names = {r.record for r in archive.filter("last").collect()}
    refers = [warc.parse_header(bytes(r.header))["warc-refers-to"] for r in archive.filter("data is null").collect()]
    assert len(refers) == 2 and {x[len("<urn:page:") : -1] for x in refers} <= names
    with pytest.raises(Exception, match="no payload"):
        warc.resolve(warc.read_archives(archive.filter(~F.col("record").startswith("1-")))).collect()
    with pytest.raises(Exception, match="chunk"):
        warc.read_archives(archive.union(archive.filter("chunk = 2"))).collect()


def test_archives_of_nothing(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


# main text


def test_main_text_of_layouts(pages):
    model = html_text.train(pages)
    for layout in html_text.LAYOUTS:
        nodes, labels = html_text.labelled_layout(layout)
        want = [t for n, t in html_text.parse(layout)[1] if labels[n]]
        got = model.text(layout).split("\n")
        assert not set(got) - set(want) and len(got) >= 0.7 * len(want)
    page = ('<html><head><title>t</title><style>p{}</style></head><body><nav class="menu"><a href="/">Home</a></nav><script>var x = "<p>no</p>";</script><article><h1>A &amp; B</h1>'
            '<p>One\n\t two&nbsp;three<br>four. <b>bold</b>!<p>Next &lt;one&gt; &eacute;.<div class="ad">Buy now.</div></article><!-- <p>gone</p> --><footer>&copy; me</footer>')  # fmt: skip
    assert model.text(page) == "A & B\nOne two three four. bold!\nNext <one> é."
    assert [model.text(x) for x in (None, "", "   ", "<script>x</script>", "<nav><a href='/'>a</a></nav>")] == [""] * 5
    assert model.text("Only plain words. They stand alone.") == "Only plain words. They stand alone."
    deep = "<div>" * 3000 + "deep words." + "</div>" * 3000
    assert len(html_text.parse(deep)[0]) == 3001 and len(model.marginals(html_text.parse(deep)[0])) == 3001


def texts_of(page: str) -> list[str]:
    return [t for _, t in html_text.parse(page)[1]]


def test_unclosed_and_odd_elements_lose_no_text():
    assert texts_of("<article><p>Before it.</p><button>Go<p>Middle text of article.</p><p>More.</p><button>x</button><p>After.</p></article>") == ["Before it.", "Middle text of article.", "More.", "After."]
    assert texts_of("<p>Press <button>OK</button> and <select><option>a<option>b</select> go.</p>") == ["Press and go."]
    assert texts_of("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, <object>an object</object>, <audio>a song</audio>.</p>") == ["If x=2 holds, an object, a song."]
    assert texts_of("<p>a<noscript>b<p>c<svg><text>d</text></svg>e") == ["a b", "c e"]


def test_time_is_proportional_to_the_page():
    import time

    for piece in ("<button>x", "<noscript>x", "<select><option>x", "<svg>x", "<p><b>x", "<div>x", "<li>x", "<!x", "<a 'x", "<td>x<tr>", "</button x"):
        began = time.time()
        nodes, blocks = html_text.parse(piece * (2_000_000 // len(piece)))
        assert time.time() - began < 30, piece


def test_marginals_match_enumeration():
    nodes, _ = html_text.parse("<div>a b. <p>c</p><ul><li>d</li><li>e.</li></ul></div><p>f</p>")
    model = html_text.Model({"tag:p": 0.8, "tag:li": -0.6, "tag:ul": 0.3, "ends:1": 0.9}, ((0.7, 0.3), (0.2, 0.8)), 0.4)
    n = len(nodes)
    own = [1 / (1 + math.exp(-model.unary(f))) for f in html_text.features(html_text.parse("<div>a b. <p>c</p><ul><li>d</li><li>e.</li></ul></div><p>f</p>")[0])]
    own[0] = 0.4
    total, mass = 0.0, [0.0] * n
    for states in range(1 << n):
        y = [states >> i & 1 for i in range(n)]
        p = math.prod(own[i] if y[i] else 1 - own[i] for i in range(n)) * math.prod(model.pair[y[nodes[i].parent]][y[i]] for i in range(1, n))
        total += p
        mass = [m + p * s for m, s in zip(mass, y, strict=True)]
    assert model.marginals(nodes) == pytest.approx([m / total for m in mass])


def test_extract_keeps_every_row(pages):
    rows = html_text.extract(pages).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id == 11} == {"Short."} and [r.text for r in rows if r.page_id == 3] == [""]
    assert html_text.extract(pages.limit(0)).collect() == []


# chats


def chats(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 1, True) for r in rows], "conv_id long, turn long, role string, text string, status string, level long, valid boolean")


def call(i, arguments, after=(), name="add"):
    return {"id": i, "type": "function", "function": {"name": name, "arguments": arguments}, "after": list(after)}


SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": "string", "maxLength": 2}}}}}


def test_calls_are_linked_ordered_and_validated(spark):
    rows = [
        (1, 0, "user", "hello"),
        (1, 1, "assistant", json.dumps({"tool_calls": [call("x", '{"b":["q"],"a":1}', ["y"]), call("y", '{"a":-1}'), call("x", "{}")], "content": "wait"})),
        (1, 2, "tool", json.dumps({"tool_call_id": "y", "content": "é"})), (1, 3, "tool", json.dumps({"tool_call_id": "x", "content": {"k": [1]}})),
        (1, 4, "tool", json.dumps({"tool_call_id": "x", "content": "again"})), (1, 5, "tool", json.dumps({"tool_call_id": "none", "content": None})),
        (2, 0, "assistant", json.dumps({"tool_calls": [call("x", "not json"), call("z", '{"a":1}', name="other"), call("p", '{"a":1}', ["q"]), call("q", '{"a":2}', ["p"]), call("s", '{"a":3}', ["s"])]})),
        (2, 1, "assistant", '{"tool_calls": broken'), (None, 0, "assistant", json.dumps({"tool_calls": [call("x", '{"a":1}')]})), (2, None, None, None), (2, 7, "assistant", json.dumps({"tool_calls": [call(None, '{"a":1}')]})),
    ]
    got = chat.format_chats(chats(spark, rows), SCHEMAS, chained=False).collect()
    calls = {(r.conv_id, r.call_id, r.idx): r for r in got if r.kind == "call"}
    assert [(calls[k].status, calls[k].level, calls[k].valid) for k in ((1, "x", 0), (1, "y", 1), (1, "x", 2))] == [("linked", 1, True), ("linked", 0, False), ("repeated", 1, False)]
    assert calls[1, "y", 1].fault == "$.a: below minimum" and calls[2, "x", 0].fault == "$: not JSON" and calls[2, "z", 1].fault == "no schema of other"
    assert {k[1]: r.status for k, r in calls.items() if k[0] == 2} == {"x": "open", "z": "open", "p": "cyclic", "q": "cyclic", "s": "cyclic", None: "unnamed"}
    assert calls[None, "x", 0].status == "unnamed"
    assert sorted((r.turn, r.status) for r in got if r.kind == "result") == [(2, "linked"), (3, "linked"), (4, "repeated"), (5, "orphan")]
    assert calls[1, "x", 0].json == '{"role":"assistant","tool_calls":[{"function":{"arguments":{"a":1,"b":["q"]},"name":"add"},"id":"x","type":"function"}]}'
    assert '{"content":"é","role":"tool","tool_call_id":"y"}' in {r.json for r in got}
    assert len(got) == 18 and {r.json for r in got if r.turn is None} == {'{"content":null,"role":null}'}


def test_levels_are_topological(spark):
    rng = np.random.default_rng(5)
    place = rng.permutation(30)  # call i waits for some smaller ones, wherever they stand
    deps = {i: sorted({int(x) for x in rng.integers(0, i, 3)}) if i else [] for i in range(30)}
    rows = [(1, int(place[i]), "assistant", json.dumps({"tool_calls": [call(f"c{i}", '{"a":1}', [f"c{d}" for d in deps[i]])]})) for i in range(30)]
    got = chat.format_chats(chats(spark, rows), SCHEMAS, chained=False).orderBy("level", "turn", "idx").collect()
    at = {r.call_id: n for n, r in enumerate(got)}
    assert all(at[f"c{d}"] < at[f"c{i}"] for i in deps for d in deps[i]) and {r.status for r in got} == {"open"}


def test_dialogue_becomes_calls_and_empty_tables_work(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", ""), (1, 5, "assistant", "late"), (1, 1, "user", "q")]
    got = chat.format_chats(chats(spark, rows)).collect()
    assert sorted((r.turn, r.kind, r.status or "", r.valid) for r in got) == sorted(
        [(0, "message", "", None), (1, "call", "linked", True), (1, "call", "linked", True), (2, "result", "linked", None), (3, "call", "open", False), (5, "result", "orphan", None)]
    )
    assert chat.format_chats(chats(spark, rows).limit(0)).collect() == []


def test_hostile_json(spark):
    """Deep nesting, lone surrogates, long integers, numbers beyond JSON, types as lists: no row ends the query."""
    long = "9" * 400
    texts = ['{"tool_calls":' + "[" * 200_000, '{"tool_calls":[{"id":"\\ud800","function":{"name":"f","arguments":{"n":' + long + ',"\\udc00":1}}}]}', '{"tool_calls":[{"id":"b","function":{"name":"f","arguments":"{\\"n\\":NaN}"}}]}',
             '{"tool_calls":[{"id":"c","function":{"name":"f","arguments":"{\\"n\\":1e999}"}}]}', '{"tool_calls":[{"id":"d","function":{"name":"f","arguments":{"n":null}}}],"turn":Infinity}',
             '{"tool_calls":[{"id":"e","function":{"name":"f","arguments":{"n":null}}}]}', '{"tool_calls":[{"id":"g","function":{"name":"f","arguments":' + "[" * 900 + "]" * 900 + "}}]}"]
    rows = [(1, i, "assistant", x) for i, x in enumerate(texts)] + [(1, 9, "tool", '{"tool_call_id":"\\ud800","content":"\\udfff"}')]
    schema = {"f": {"type": "object", "properties": {"n": {"type": ["integer", "null"], "minimum": 3}}}}
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), schema, chained=False).collect()
    for r in got:
        json.loads(r.json, parse_constant=lambda x: 1 / 0)
    by = {r.turn: r for r in got}
    assert len(got) == 8 and [by[i].kind for i in range(7)] == ["message", "call", "call", "call", "message", "call", "call"]
    assert by[1].call_id == "\ufffd" and by[1].valid and by[1].status == "linked" and long in by[1].json and by[9].status == "linked"
    assert [by[i].valid for i in (2, 3, 5, 6)] == [False, False, True, False] and by[2].fault == by[3].fault == "$: not JSON"


# nearest neighbours


def vectors(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, rank int, vec string")


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES", 200)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    x = np.random.default_rng(6).normal(size=(900, 24)).astype(np.float32)
    x[40] = x[41] = x[42]
    bad = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan"), *[1.0] * 23]), (2060, [None, *[1.0] * 23]), (2080, [1.0] * 5), (None, [1.0] * 24), (2100, []), (2120, [float("inf")] * 24), (20, [9.0] * 24)]
    rows = [(i, v.tolist(), 0, 0.0, 0, "") for i, v in enumerate(x)] + [(i, v, None, None, None, None) for i, v in bad]
    got = {}
    for r in neighbours.nearest(vectors(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    full, hits = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, 900, 20))
    for q, found in got.items():
        nine = np.full(24, 9.0)  # another vector of id 20
        both = [full[q], nine] if q == 20 else [full[q]]
        s = np.max([full @ v for v in both], axis=0)
        s[20] = max(s[20], *(nine @ v for v in both))
        s[q] = -np.inf
        want = np.lexsort((np.arange(900), -s))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(abs(s[i] - v) < 1e-12 for _, i, v in found)
        assert [(-v, i) for _, i, v in found] == sorted((-v, i) for _, i, v in found)
        hits += len({i for _, i, _ in found} & set(want.tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_probing_is_complete_within_the_radius():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 16))
    codes = neighbours.Codes(neighbours.rotations(x), 40)
    ask = np.arange(400) % 20 == 0
    group = {"ask": np.concatenate([np.zeros(400, bool), ask[ask]]), "vec_id": np.concatenate([np.arange(400), np.flatnonzero(ask)]), "vec": np.array([*x, *x[ask]], dtype=object)}
    group["vec"] = np.fromiter((v for v in [*x, *x[ask]]), dtype=object, count=len(group["ask"]))
    found = neighbours._search(codes, 10_000)(group)
    own = codes.of(x)
    for q in np.flatnonzero(ask):
        d = np.bitwise_count(own ^ own[q]).sum(1)
        assert set(found[found.query_id == q].vec_id) == set(np.flatnonzero(d <= 40)) - {q}


def test_lengths_and_repeated_ids(spark):
    """Every usable vector asks and is found: two lengths, an id with vectors of both, better and worse ones of one id."""
    rows = [(20, [1.0, 0.0]), (20, [500.0, 500.0]), (1, [1.0, 1.0]), (2, [2.0, -1.0]), (40, [0.5, 0.5]), (100, [1.0, 0.0, 0.0]), (120, [0.0, 1.0, 1.0]), (40, [3.0, 0.0, 1.0]), (40, [0.5, 0.5])]
    got = {}
    for r in neighbours.nearest(vectors(spark, [(i, v, 0, 0.0, 0, "") for i, v in rows])).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = {}
    for q in (20, 40, 100, 120):
        best = {}
        for i, a in rows:
            for j, b in rows:
                if i == q != j and len(a) == len(b):
                    best[j] = max(best.get(j, -1e9), sum(x * y for x, y in zip(a, b, strict=True)))
        want[q] = [(n + 1, j, s) for n, (s, j) in enumerate(sorted((-s, j) for j, s in best.items()))]
        want[q] = [(n, j, -s) for n, j, s in want[q]]
    assert {q: sorted(v) for q, v in got.items()} == want


def test_few_and_no_vectors(spark):
    few = vectors(spark, [(i, [1.0 + i, 1.0], 0, 0.0, 0, "") for i in (0, 1, 2)])
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(few).orderBy("rank").collect()] == [(0, 1, 2, 4.0), (0, 2, 1, 3.0)]
    assert neighbours.nearest(few.limit(0)).collect() == []
    assert neighbours.nearest(few.filter("vec_id > 0")).collect() == []
    assert neighbours.nearest(few.filter("vec_id = 0")).collect() == []


# pipeline and queries


def test_pipeline_stages(spark, messy, texts):
    path = spark.conf.get("spark.checkpoint.dir") + f"/pipeline-{os.urandom(4).hex()}"
    passage = " ".join(f"benchword{i}" for i in range(30))
    more = {500: "a clean start " + passage + " and the end of it", 501: " ".join(["buy", "now!!"] * 30)} | {600 + i: " ".join(["buy", "now!!"] * (20 + i)) for i in range(40)}
    messy.union(spark.createDataFrame(rows_of(more), DOCS)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, 0) for i in texts if i < 75] + [(i, 0, 0) for i in more if i > 500]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        assert docs.columns[: len(columns)] == columns
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {i for i in more if i != 500}.isdisjoint(kept["quality classifier"]) and {0, 20, 85, 500} <= kept["quality classifier"]
    assert {3, 500} <= kept["near-dedup"] and {75, 76, 77}.isdisjoint(kept["near-dedup"])
    assert kept["decontamination"] == kept["near-dedup"] - {500}
    assert kept["mixing"] <= kept["decontamination"]
    again = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in again.select("doc_id").collect()} == kept["mixing"]


def test_pipeline_of_nothing(spark, no_docs):
    path = spark.conf.get("spark.checkpoint.dir") + f"/pipeline-{os.urandom(4).hex()}"
    no_docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


@pytest.mark.skipif(not os.path.isdir(DIR), reason="shared tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    df = queries.QUERIES[name](spark, DIR)
    assert set(names) == set(df.columns)

    def key(row):
        return tuple(f"{x:.9g}" if isinstance(x, float) else repr(x) for x in row)

    assert sorted(map(key, df.select(names).collect())) == sorted(map(key, cursor.fetchall()))
