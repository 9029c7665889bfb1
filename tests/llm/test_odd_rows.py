"""Every operator on NULLs, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

from collections import Counter

import public_tokenizers

import brute
from ledgerfold.llm import (
    exact_dedup, line_dedup, mixing, packing, pii, quality, sharding, simhash, token_counts, top_k,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_exact_dedup(odd, empty):
    rows = exact_dedup.exact_dedup(odd, carry=odd.columns).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in _texts(odd))
    by_group = {}
    for r in rows:
        by_group.setdefault(r.text_sha256, []).append(r)
    texts = Counter(brute.plain(t) for _, t in _texts(odd))
    assert sorted(len(g) for g in by_group.values()) == sorted(texts.values())
    for group in by_group.values():
        assert sum(r.kept for r in group) == 1
        assert {r.group_size for r in group} == {len(group)}
        stays = next(r for r in group if r.kept)
        longest = max(len(r.row.text or "") for r in group)
        assert len(stays.row.text or "") == longest
        ids = [r.doc_id for r in group if len(r.row.text or "") == longest and r.doc_id is not None]
        assert {r.keep_id for r in group} == {min(ids, default=None)} == {stays.doc_id}
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_line_dedup(odd, empty):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    # Windows of 10 come first; its own second copy goes, as do those of 11 and the one without id.
    assert by_id[10].text == "a\nb\nc" and by_id[10].n_removed == 3
    assert by_id[11].text == "" and by_id[11].n_lines == by_id[11].n_removed == 3
    assert ("d", 3) in {(r.text, r.n_removed) for r in rows if r.doc_id is None}
    assert by_id[1].text == "" and by_id[1].n_removed == 0
    assert line_dedup.dedup_lines(empty).collect() == []


def test_line_dedup_is_native(odd):
    plan = line_dedup.dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_simhash(odd, empty):
    rows = simhash.near_duplicates(odd, carry=odd.columns).collect()
    assert len(rows) == odd.count()
    numbered = [(i, brute.fingerprint(r.row.text)) for i, r in enumerate(rows)]
    assert [f for _, f in numbered] == [r.fingerprint % (1 << 64) for r in rows]
    groups = {}
    for i, root in brute.components(numbered).items():
        groups.setdefault(root, []).append(rows[i])
    for group in groups.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.component_id for r in group} == {min(ids, default=None)}
        assert sum(r.kept for r in group) == 1
    assert simhash.near_duplicates(empty).collect() == []


def test_packing(odd, empty):
    rows = packing.pack_documents(odd, TOKENIZER).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == brute.pieces(_texts(odd))
    assert brute.check_packing(rows) <= sum(r.length for r in rows) // 2048 + 2
    assert packing.pack_documents(empty, TOKENIZER).collect() == []


def test_mixing(odd, empty):
    mixed = mixing.mix(odd, block_size=64, carry=odd.columns)
    rows = mixed.collect()
    assert sorted(str(tuple(r.row)[1:]) for r in rows) == sorted(str(tuple(r)) for r in odd.collect())
    assert all(r.block == r.start // 64 for r in rows)
    assert len({(r.slot, r.source, r.block) for r in rows}) == len({(r.source, r.block) for r in rows})
    pooled = mixing.mix(odd, block_size=64, max_sources=2).collect()
    assert len(pooled) == len(rows)
    weighted = mixing.mix(odd, {"a": 3.0, None: 1.0}, block_size=64).collect()
    assert len(weighted) == len(rows)
    assert mixing.mix(empty).collect() == []


def test_sharding(odd, empty, tmp_path):
    rows = sharding.place(odd, ["a", "b", "c"]).collect()
    assert len(rows) == odd.count() and {r.shard for r in rows} == {"a", "b", "c"}
    assert len({r.slot for r in rows if r.doc_id == 4}) == 1
    assert sharding.place(empty, ["a"]).collect() == []
    sharding.write_shards(odd, ["a", "b"], f"{tmp_path}/shards")
    back = odd.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert back.count() == odd.count() and set(odd.columns) < set(back.columns)


def test_quality(odd, empty, spark):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 3 == 0) for i in range(100, 140)] + [(None, 1, False), (101, None, None)],
        "doc_id long, quality int, toxic boolean",
    ).selectExpr("doc_id", "quality", "int(toxic) AS toxic", "'x' AS row")
    rows = quality.graded(odd, labels, carry=odd.columns).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert len({(r.tail_probability) for r in rows if r.row.text == "some words here"}) == 1
    unlabelled = quality.graded(odd, labels.limit(0)).collect()
    assert all(r.kept and r.tail_probability == 1 for r in unlabelled) and len(unlabelled) == len(rows)
    assert quality.graded(empty, labels).collect() == []


def test_personal_data(odd, empty):
    rows = pii.personal_data(odd).collect()
    base = sorted((str(r.doc_id), str([tuple(s) for s in r.spans if s.kind < 4])) for r in rows)
    assert base == sorted((str(d), str(brute.spans(t))) for d, t in _texts(odd))
    assert pii.personal_data(empty).collect() == []


def test_token_counts(odd, empty):
    counted = token_counts.count_tokens(odd, RANKS, public_tokenizers.PATTERN)
    rows = token_counts.apply_edits(
        counted.selectExpr("*", "CAST(array() AS array<struct<start: long, end: long, new: string>>) AS edits"),
        RANKS, public_tokenizers.PATTERN,
    ).collect()
    assert len(rows) == odd.count() and all(r.tokens == r.tokens_before and not r.encoded for r in rows)
    assert token_counts.count_tokens(empty, RANKS, public_tokenizers.PATTERN).collect() == []


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    table = spark.createDataFrame(
        [(0, [0.5, 0.25], "x"), (50, [0.5, 0.25], "x"), (50, [0.5, 0.25], "x"), (3, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"),
         (4, None, "x"), (5, [nan, 0.0], "x"), (6, [None, 1.0], "x"), (7, [inf, 0.0], "x"), (None, [1.0, 1.0], "x"),
         (8, [], "x"), (100, [-0.001, 0.5], "x"), (9, [3e6, -3e6], "x")],
        "vec_id long, embedding array<float>, score string",
    )
    vectors = table.select("vec_id", top_k.quantised(table.embedding).alias("vector"))
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    rows = top_k.top_k(queries, vectors, 3, group_rows=3, query_rows=2).collect()
    known = [(r.vec_id, list(r.vector)) for r in vectors.collect() if r.vec_id is not None and r.vector is not None]
    for query_id in (0, 50, 100):
        own = next(v for i, v in known if i == query_id)
        expected = sorted(
            (-sum(a * b for a, b in zip(own, v)), i) for i, v in known if i != query_id
        )[:3]
        got = sorted((r["rank"], -r.score, r.vec_id) for r in rows if r.query_id == query_id)
        assert [(s, i) for _, s, i in got] == expected
    assert top_k.top_k(queries.limit(0), vectors, 3).collect() == []
    assert top_k.top_k(queries, vectors.limit(0), 3).collect() == []
