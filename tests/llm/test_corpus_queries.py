"""Registered corpus queries against SQL or plain versions on the smallest tables."""

from __future__ import annotations

import hashlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
import brute
import corpus_pipeline
from ledgerfold.llm import mixing, packing, queries, sharding, token_counts

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in rows]


def _run(spark, name):
    return contract.queries()[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    expected = sorted(str(tuple(r[i] for i in order)) for r in result.fetchall())
    assert sorted(str(tuple(r)) for r in df.collect()) == expected


def test_top_k_sql_on_repeated_ids(spark, tmp_path):
    rows = [(0, [0.125, 0.0]), (0, [1.0, 0.5]), (50, [0.0, 0.125]), (50, [1.0, 0.0]), (50, [0.25, 0.25])]
    rows += [(i, [((i * 7) % 11 - 5) / 8, ((i * 5) % 13 - 6) / 8]) for i in range(1, 49)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = duck.execute(queries.oracle_sql()["op7_va_top_k"])
    columns = [d[0] for d in result.description]
    got = contract.queries()["op7_va_top_k"](spark, str(tmp_path)).select("query_id", "rank", "score").collect()
    at = [columns.index(c) for c in ("query_id", "rank", "score")]
    assert sorted(tuple(r) for r in got) == sorted(tuple(r[i] for i in at) for r in result.fetchall())


def test_every_query_row_has_its_own_answers(spark, tmp_path):
    """Rows that repeat an id, or a whole row, are searched each, also against one another."""
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0])] + [(i, [i / 64, (40 - i) / 64]) for i in range(1, 20)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = contract.queries()["op7_va_top_k"](spark, str(tmp_path)).collect()
    assert len(found) == 15 and sorted(r["rank"] for r in found) == sorted([1, 2, 3, 4, 5] * 3)
    answers = sorted((r["rank"], r.vec_id, r.score) for r in found)
    # Each of the two equal rows finds the other first; the third row finds the largest first components.
    assert answers[:3] == [(1, 19, 256 * 76), (1, 50, 1 << 16), (1, 50, 1 << 16)]


def test_mix_deviates_by_less_than_a_block(spark, texts):
    rows = _run(spark, "op1_pfair_mix")
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in texts)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(dict(texts)[r.doc_id] or "")
    for r in rows:
        assert r.block == r.start // mixing.BLOCK_SIZE and r.start <= sizes[r.source]


def test_shares_follow_weights_at_every_slot():
    shares = mixing.period_shares([5, 3, 1, 0.001, 7], 97)
    order = mixing.schedule(shares)
    done = [0] * len(shares)
    for slot, source in enumerate(order, 1):
        done[source] += 1
        assert all(abs(n * 97 - slot * share) < 97 for n, share in zip(done, shares))
    assert done == shares and sum(shares) == 97


@pytest.mark.parametrize("blocks, targets", [
    ([3000] + [250] * 19, [3000 ** 0.5] + [250 ** 0.5] * 19),
    ([4000, 2000, 2000], [0.9993, 0.0004, 0.0003]),
    ([9000, 1, 30, 400], [5, 0.001, 3, 7]),
    ([7] * 1000 + [600], [1 / 3] * 1000 + [90]),
])
def test_mix_follows_the_targets_themselves(blocks, targets):
    """Against a fluid mix in which sources that end leave their share to the others."""
    at = np.empty(sum(blocks), np.int64)
    for i, own in enumerate(mixing.phases(blocks, targets)):
        for block in range(blocks[i]):
            first, slot, share, length, slots = [p for p in own if p[0] <= block][-1]
            at[slot + (block - first) // share * length + slots[(block - first) % share]] = i
    targets, fluid, done = np.array(targets), np.zeros(len(blocks)), np.zeros(len(blocks))
    for source in at:
        left = 1.0
        while left > 1e-12:
            rate = np.where(fluid < blocks, targets, 0) / targets[fluid < blocks].sum()
            first = min((blocks - fluid)[rate > 0] / rate[rate > 0])
            step = min(left, first)
            ends = (rate > 0) & ((blocks - fluid) <= rate * step * (1 + 1e-12))
            fluid = np.where(ends, blocks, fluid + rate * step)
            left -= step
            if (fluid >= blocks).all():
                break
        done[source] += 1
        assert np.abs(done - fluid).max() < 1 + 1e-6
    assert done.tolist() == blocks


def test_every_source_has_its_own_target(spark):
    """400 equal sources, all past the 256th, and one whose weight is half of all."""
    rows = [(i, "x" * 10, f"s{i % 400:03d}") for i in range(4000)] + [(4000 + i, "x" * 10, "zz") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, {"zz": 400.0}, block_size=10).collect()
    taken = {}
    for slot, source in sorted({(r.slot, r.source) for r in mixed}):
        taken[source] = taken.get(source, 0) + 1
        if slot < 800:
            assert all(abs(n - (slot + 1) / (2 if s == "zz" else 800)) < 1 + 1e-6 for s, n in taken.items())
    assert len({r.slot for r in mixed}) == len({(r.source, r.block) for r in mixed}) == 4400
    assert len({r.source for r in mixed if r.slot < 800}) == 401


def test_phases_place_every_block_once():
    blocks, weights = [70, 3, 11, 1, 40], [5.0, 1.0, 1.0, 0.5, 2.0]
    slots = []
    for own, n in zip(mixing.phases(blocks, weights, 20), blocks):
        for block in range(n):
            first, slot, share, length, at = [p for p in own if p[0] <= block][-1]
            slots.append(slot + (block - first) // share * length + at[(block - first) % share])
    assert sorted(slots) == list(range(sum(blocks)))


def test_token_counts_follow_edits(spark, texts):
    ranks = token_counts.Encoder(public_tokenizers.path(queries.COUNTING_RANKS), public_tokenizers.PATTERN)
    rows = _run(spark, "op2_edit_token_counts")
    assert len(rows) == len(texts)
    encode = ranks.encoding.encode_ordinary
    for r in rows:
        text = dict(texts)[r.doc_id] or ""
        assert r.tokens_before == len(encode(text))
        edits = [{"start": len(text), "end": len(text), "new": "\n"},
                 *token_counts.masking_edits(brute.spans(text), list(brute.PATTERNS))]
        for x in edits:
            text = text[:x["start"]] + x["new"] + text[x["end"]:]
        assert r.tokens == len(encode(text)) and r.edited == len(edits)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_packing(spark, texts):
    rows = _run(spark, "op3_best_fit_packing")
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == brute.pieces(texts)
    assert brute.check_packing(rows) <= sum(r.length for r in rows) // 2048 + 2


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = public_tokenizers.path(queries.PACKING_TOKENIZER)
    packed = packing.pack_documents(docs, path, 256, keep_ids=True)
    rows = packing.sequences(packed).collect()
    assert all(len(r.ids) <= 256 for r in rows)
    assert sum(len(r.ids) for r in rows) == sum(x[3] for x in brute.pieces([(r.doc_id, r.text) for r in docs.collect()]))


def test_personal_data(spark, texts):
    rows = {r.doc_id: r for r in _run(spark, "op5_disclosing_terms")}
    kinds = list(brute.PATTERNS)
    for doc_id, text in texts:
        base, r = brute.spans(text), rows[doc_id]
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert [x for x in r.spans.split(",") if x.split(":")[0] in kinds] == [x for x in joined.split(",") if x] or not base


def test_sharding(spark, texts):
    assert sharding.lookup_table(["a", "b", "c"], 101).tolist() == brute.lookup_table(["a", "b", "c"], 101)
    owner = sharding.lookup_table(queries.SHARDS)
    counts = [int((owner == i).sum()) for i in range(len(queries.SHARDS))]
    assert max(counts) - min(counts) <= 1
    rows = _run(spark, "op9_lookup_sharding")
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in texts)
    assert all(r.shard == queries.SHARDS[owner[r.slot]] for r in rows)


@pytest.mark.parametrize("bucket", [32, 1])
def test_simhash(spark, texts, bucket, monkeypatch):
    monkeypatch.setattr("ledgerfold.llm.simhash.BUCKET", bucket)
    prints = [(d, brute.fingerprint(t)) for d, t in texts]
    roots = brute.components(prints)
    expected = {d: (f"{f:016x}", roots[d]) for d, f in prints}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in _run(spark, "op10_simhash_dedup")} == expected


def test_quality_held_out(spark):
    from ledgerfold.llm import quality

    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    graded = quality.graded(docs, labels.where("doc_id % 4 != 0")).drop("row")
    rows = graded.join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality and not r.toxic]
    junk = [r.kept for r in rows if not r.quality]
    toxic = [r.kept for r in rows if r.quality and r.toxic]
    assert sum(clean) > 0.98 * len(clean)
    assert sum(junk) < 0.05 * len(junk)
    assert sum(toxic) < 0.5 * len(toxic)  # about 250 examples in four languages


def test_pipeline(spark, texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources", "best-fit packing"
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in _run(spark, "op4_ordinal_quality") if r.kept}
    left = [(d, t) for d, t in texts if d in good]
    groups = brute.exact_groups(left)
    left = [(d, t) for d, t in left if groups[d][2]]
    roots = brute.components([(d, brute.fingerprint(t)) for d, t in left])
    left = [(d, t) for d, t in left if roots[d] == d]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == brute.pieces(left)
    brute.check_packing(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF_DIR).columns == docs.columns


def test_sequences_follow_the_mix(spark, tmp_path):
    """After the mixing stage is written to files and these are read in another order."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    corpus_pipeline.mix_sources(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/mixed")
    reread = spark.read.parquet(f"{tmp_path}/mixed").repartition(3, "source")
    rows = corpus_pipeline.pack_sequences(spark, reread, SF_DIR).collect()
    brute.check_packing(rows)
    places = {r.doc_id: (r.slot, r.start) for r in _run(spark, "op1_pfair_mix")}
    first = {}
    for r in rows:
        first[r.sequence_id] = min(first.get(r.sequence_id, places[r.doc_id]), places[r.doc_id])
    assert [s for s, _ in sorted(first.items(), key=lambda x: x[1])] == list(range(len(first)))
    assert len(first) == len({r.sequence_id for r in _run(spark, "op3_best_fit_packing")})
    again = corpus_pipeline.pack_sequences(spark, docs, SF_DIR).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixing_stage_orders_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ordered = [r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()]
    places = {r.doc_id: (r.slot, r.start, r.doc_id) for r in _run(spark, "op1_pfair_mix")}
    assert ordered == sorted(ordered, key=places.get)
