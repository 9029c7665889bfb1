"""Bit-sliced search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from ledgerfold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text)."""
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    N, L = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 100 - 25 + (25 * bag.total() * N) // max(L, 1)
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in plain_terms(text) if bag[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _got(rows):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def _pairs(df, key):
    return [(r[key], r.text) for r in df.select(key, "text").collect()]


def test_terms():
    for text in (None, "", "a-B c_D\x00e", "Ünï-CÖDE 42x", "漢字 ﬀ ÁB", "x" * 5000):
        assert [t.decode() for t in lexical.terms(text)] == plain_terms(text)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = contract.queries()["op13_bit_sliced_search"](spark, sf_dir).collect()
    assert _got(rows) == plain_search(_pairs(docs, "doc_id"), _pairs(items, "item_id"), 20)


@pytest.mark.parametrize("block_items,broadcast", [(2, 0), (100, 1 << 20)])
def test_odd_rows(odd, empty, spark, block_items, broadcast, monkeypatch):
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", broadcast)
    items = spark.createDataFrame(
        [(1, "Some words, some more text"), (2, None), (3, ""), (3, "a b c a"), (3, "alpha 42 épsilon"), (None, "row 3 of"),
         (4, "unknownterm"), (5, "text " * 300)], "item_id long, text string",
    ).selectExpr("*", "'x' AS score", "'y' AS doc_id")
    rows = lexical.search(odd, items, 4, block_items).collect()
    assert _got(rows) == plain_search(_pairs(odd, "doc_id"), _pairs(items, "item_id"), 4)
    if block_items > 2:
        assert lexical.search(empty, items, 4).collect() == []
        assert lexical.search(odd, items.limit(0), 4).collect() == []


def test_bounds_are_never_below_scores():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(300)], k=rng.randint(1, 400))) for _ in range(300)]
    bags = [Counter(lexical.terms(t)) for t in texts]
    total = sum(b.total() for b in bags)
    wanted = [t.encode() for t in vocabulary]
    items = [(np.array(rng.sample(range(300), 20)), np.array(rng.choices(range(1, 6000), k=20))) for _ in range(5)]
    hashes = np.array([lexical._hash(t) for t in wanted], np.uint64)
    block = lexical._Block(np.arange(5), wanted, hashes, items, np.ones(5, np.int64), 300, total)
    loose = []
    for batch in lexical._build(iter([lexical.pa.RecordBatch.from_pydict({"key": list(range(300)), "text": texts})])):
        for row in batch.to_pylist():
            if row["kind"] == "groups":
                slices = np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1)
                for i, bound in enumerate(block.bounds(row["bits"], np.array(row["sizes"]), slices)):
                    for key, b in zip(row["keys"], bound):
                        score = block.scores(texts[key], [i])[0]
                        assert b >= score
                        loose.append(b / max(score, 1))
    assert len(loose) == 1500 and np.median(loose) < 1.3


def test_copies_beyond_k(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "if(id % 2 = 0, 'same text here', concat('other ', id)) AS text")
    items = spark.createDataFrame([(1, "same text"), (2, "other")], "item_id long, text string")
    rows = lexical.search(docs, items, 20).collect()
    assert _got(rows) == plain_search(_pairs(docs, "doc_id"), _pairs(items, "item_id"), 20)
