from __future__ import annotations

import functools
import gzip
import hashlib
import http.server
import io
import json
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricequarry.sources import json_items as J

DOC = '{"version": "1", "in_network": [ {"a": 1.50, "s": "br]ace\\"}"}, 1e2, null, "x", [[]] ], "empty": [], "in_network2": {"in_network": [1]}, "provider_references":[{"n":{}}]}'


def items(text, lists=("in_network", "provider_references"), wanted=lambda k, i: True):
    return list(J.top_level(io.StringIO(text), set(lists), wanted))


def test_elements_keep_their_text():
    assert items(DOC) == [
        ("version", None, '"1"'), ("in_network", 0, '{"a": 1.50, "s": "br]ace\\"}"}'), ("in_network", 1, "1e2"), ("in_network", 2, "null"), ("in_network", 3, '"x"'), ("in_network", 4, "[[]]"),
        ("empty", None, "[]"), ("in_network2", None, '{"in_network": [1]}'), ("provider_references", 0, '{"n":{}}'),
    ]
    assert items(DOC, wanted=lambda k, i: i == 3) == [("in_network", 3, '"x"')]
    assert items("{}") == [] and items(' {"in_network": 5} ') == [("in_network", None, "5")]


@pytest.mark.parametrize("bad", ["", "[]", "{", '{"a" 1}', '{"a": 1} x', '{"in_network": [1', '{"a": "x', '{"a": }', '{"a": 1,}'])
def test_broken_documents_raise(bad):
    with pytest.raises(ValueError):
        items(bad)


JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=6), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4), x, max_size=4), max_leaves=15)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.sampled_from(["in_network", "a", "b"]), JSON, max_size=3), st.integers(1, 9), st.booleans())
def test_same_as_json_load_at_any_piece_size(doc, piece, spaced):
    text = json.dumps(doc, indent=1 if spaced else None)
    want = []
    for k, v in doc.items():
        want += [(k, i, x) for i, x in enumerate(v)] if k == "in_network" and isinstance(v, list) else [(k, None, v)]
    before, J.PIECE = J.PIECE, piece
    try:
        got = [(k, i, json.loads(raw)) for k, i, raw in items(text, ["in_network"])]
        some = [(k, i, json.loads(raw)) for k, i, raw in items(text, ["in_network"], lambda k, i: i == 1)]
    finally:
        J.PIECE = before
    assert got == want and some == [x for x in want if x[1] == 1]


def test_source_reads_plain_and_gzip(spark, tmp_path):
    J.register(spark)
    (tmp_path / "plain.gz").write_text(DOC)  # told apart by content, not by name
    (tmp_path / "zipped.json").write_bytes(gzip.compress(DOC.encode()))
    df = spark.read.format("json_items").option("lists", "in_network,provider_references").load(str(tmp_path))
    rows = df.collect()
    assert len(rows) == 2 * 10
    sums = {r.file.rsplit("/", 1)[1]: (r.sha256, r.n_bytes) for r in rows if r.top_key == "_file"}
    for name, (sha, n) in sums.items():
        data = (tmp_path / name).read_bytes()
        assert (sha, n) == (hashlib.sha256(data).hexdigest(), len(data))
    one = df.filter((F.col("top_key") == "in_network") & (F.col("idx") == 1)).select("raw").collect()
    assert [r.raw for r in one] == ["1e2", "1e2"]
    # the same relation twice in a query, with different filters
    twice = df.filter("top_key = 'in_network'").unionByName(df.filter("top_key = '_file'")).groupBy("top_key").count().collect()
    assert {r.top_key: r["count"] for r in twice} == {"in_network": sum(r.top_key == "in_network" for r in rows), "_file": 2}
    load = lambda **o: spark.read.format("json_items").options(lists="in_network,provider_references", **o).load(str(tmp_path))
    for some in (load(keys="in_network", positions="1"), load(pushdown=True).filter((F.col("top_key") == "in_network") & (F.col("idx") == 1))):
        assert [r.raw for r in some.collect()] == ["1e2", "1e2"]
    with pytest.raises(Exception, match="FileNotFound|nothing"):
        spark.read.format("json_items").load(str(tmp_path / "nothing")).collect()


def test_source_reads_what_a_url_serves(spark, tmp_path):
    (tmp_path / "doc.json").write_bytes(gzip.compress(DOC.encode()))
    handler = functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path))
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        J.register(spark)
        rows = spark.read.format("json_items").option("lists", "in_network").load(f"http://127.0.0.1:{server.server_port}/doc.json").collect()
        server.shutdown()
    (whole,) = [r for r in rows if r.top_key == "_file"]
    data = (tmp_path / "doc.json").read_bytes()
    assert (whole.sha256, whole.n_bytes) == (hashlib.sha256(data).hexdigest(), len(data)) and [r.idx for r in rows if r.top_key == "in_network"]
