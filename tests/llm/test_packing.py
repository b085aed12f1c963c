from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.llm.packing import Bins, fill, packing_plan, pieces, tokenizer


def brute(sizes, capacity, most_open):
    """Best fit over a plain list of open containers; the last container put away is taken first among equals."""
    bins, out, made = [], [], 0
    for s in sizes:
        fits = [b for b in bins if b[0] >= s]
        if fits:
            least = min(b[0] for b in fits)
            b = [b for b in bins if b[0] == least][-1]
            bins.remove(b)
        else:
            b = [capacity, made]
            made += 1
        out.append((b[1], capacity - b[0]))
        b = [b[0] - s, b[1]]
        if b[0]:
            bins.append(b)
            if len(bins) > most_open:
                least = min(x[0] for x in bins)
                bins.remove([x for x in bins if x[0] == least][-1])
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=120), st.integers(1, 8))
def test_bins_are_best_fit(sizes, most_open):
    bins = Bins(20, most_open)
    got = [bins.place(s) for s in sizes]
    assert got == brute(sizes, 20, most_open)
    assert bins.n_open <= most_open


def test_wrong_sizes():
    for bad in (0, 21):
        with pytest.raises(ValueError, match="fit"):
            Bins(20).place(bad)
    assert list(pieces(45, 20)) == [(0, 20), (20, 20), (40, 5)] and list(pieces(0, 20)) == []


def test_plan_is_whole(spark, sf):
    texts = ["short text", "", None, "word " * 5000, "<|endoftext|> x", "ü" * 3000, "short text", "a" * 200_000]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    plan = packing_plan(df, capacity=256).collect()
    encode = tokenizer(None).encode_ordinary
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in plan:
        by_doc[r.doc_id].append(r)
        if r.container_id is not None:
            by_bin[r.container_id].append((r.offset, r.offset + r.n_tokens))
    for n, t in enumerate(texts):
        size = len(encode(t)) if t else 0
        rows = sorted(by_doc[n], key=lambda r: r.piece)
        assert sum(r.n_tokens for r in rows) == size and len(rows) == max(1, -(-size // 256))
        assert [r.token_start for r in rows] == [256 * i for i in range(len(rows))]
    for spans in by_bin.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0 and spans[-1][1] <= 256
    assert packing_plan(df.limit(0)).collect() == []
    assert packing_plan(clashing(df), capacity=256).count() == len(plan)


def test_containers_are_full(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    (r,) = fill(packing_plan(docs.coalesce(1))).collect()
    assert r.fill > 0.9
