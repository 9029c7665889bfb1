"""The corpus operators as queries, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import (
    exact_dedup, lexical, line_dedup, merkle, mixing, packing, pii, quality, sharding, simhash, token_counts,
    top_k, toxicity,
)
from ledgerfold.sources.workspace import written

SHARDS = [f"shard-{i:03d}" for i in range(128)]
PACKING_TOKENIZER = "word_bpe_49k.json"
COUNTING_RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in a mix of sources by the square roots of their sizes."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("row")


def op2_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts after a revision that masks personal data and ends each text with a new line."""
    path, pattern = public_tokenizers.path(COUNTING_RANKS), public_tokenizers.PATTERN
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), path, pattern)
    edited = token_counts.apply_edits(counted.withColumn("edits", revision(F.col("text"))), path, pattern)
    return edited.select(
        "doc_id", "tokens_before", "tokens", "edited", "encoded", F.sha2("text", 256).alias("text_sha256")
    )


def revision(text):
    """Edits of a text: a new line at its end, then a class in the place of each personal datum."""
    edit = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())])

    def of_batch(texts: pa.Array) -> pa.Array:
        found = (x.as_py() or "" for x in texts)
        return pa.array(
            ([{"start": len(t), "end": len(t), "new": "\n"},
              *token_counts.masking_edits(pii.base_spans(t), pii.KINDS)] for t in found),
            pa.list_(edit),
        )

    return F.arrow_udf(of_batch, "array<struct<start: long, end: long, new: string>>")(text)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of up to 2048 tokens."""
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER)
    )


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document."""
    return quality.graded(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("row")


def op5_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it, in every document."""
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind < len(pii.BASE))

    def many(kind: int):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    return found.select(
        "doc_id",
        *[many(i).alias(f"n_{kind}") for i, kind in enumerate(pii.BASE)],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left of every document once repeated three-line passages are removed."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth embedding against all other rows."""
    # Written, so that a row has one number wherever it is read.
    vectors = written(_table(spark, sf_dir, "embeddings").select(
        "vec_id", top_k.quantised(F.col("embedding")).alias("vector"), F.monotonically_increasing_id().alias("row")
    ))
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return top_k.top_k(queries, vectors, 5)


def op8_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal but for white space."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("row")


def op9_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(_table(spark, sf_dir, "documents"), SHARDS)


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; one in seven is handed in with a longer n_chars."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(altered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(_table(spark, sf_dir, "documents"), {"n_chars": claimed})
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"), "folded_root", "verified",
    )


def op13_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_pfair_mix, op2_edit_token_counts, op3_best_fit_packing, op4_ordinal_quality,
        op5_disclosing_terms, op6_line_windows, op7_va_top_k, op8_radix_dedup,
        op9_lookup_sharding, op10_simhash_dedup, op11_subword_toxicity,
        op12_merkle_manifest, op13_bit_sliced_search,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_windows": r"""
            WITH cut AS (
                SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
            ), windows AS (
                SELECT doc_id, unnest(range(len(lines) - 2)) AS line,
                    unnest(list_transform(range(1, len(lines) - 1), lambda i: lines[i:i + 2])) AS w
                FROM cut WHERE len(lines) >= 3
            ), ordered AS (
                SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS nth FROM windows
            ), gone AS (
                SELECT doc_id, list_distinct(flatten(list([line, line + 1, line + 2]))) AS gone
                FROM ordered WHERE nth > 1 GROUP BY doc_id
            )
            SELECT doc_id, len(lines) AS n_lines, coalesce(len(gone), 0) AS n_removed,
                sha256(array_to_string(
                    list_transform(
                        list_filter(range(len(lines)), lambda i: NOT list_contains(coalesce(gone, []), i)),
                        lambda i: lines[i + 1]), chr(10))) AS kept_sha256
            FROM cut LEFT JOIN gone USING (doc_id)""",
        "op7_va_top_k": r"""
            WITH v AS MATERIALIZED (
                SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
                FROM embeddings
                WHERE embedding IS NOT NULL
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), scored AS (
                SELECT q.vec_id AS query_id, q.row AS asking, c.vec_id,
                    CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
                FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row != c.row
            ), ranked AS (
                SELECT *, row_number() OVER (PARTITION BY asking ORDER BY score DESC, vec_id) AS rank FROM scored
            )
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
        "op8_radix_dedup": r"""
            WITH t AS (
                SELECT doc_id, length(coalesce(text, '')) AS n,
                    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
                FROM documents
            ), g AS (
                SELECT plain, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size
                FROM t GROUP BY plain
            )
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.plain) AS text_sha256
            FROM t JOIN g USING (plain)""",
        "op12_merkle_manifest": r"""
            WITH RECURSIVE claimed AS (
                SELECT *, n_chars + CASE WHEN xor(4294967295, list_reduce(
                    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                    lambda crc, byte: list_reduce(
                        range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, byte)),
                    CAST(4294967295 AS BIGINT))) % 7 = 0 THEN 1 ELSE 0 END AS claim
                FROM documents
            ), fields AS (
                SELECT doc_id, lang,
                    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                        || coalesce(strlen(source) || ':' || source, '-')
                        || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS own,
                    coalesce(strlen(CAST(claim AS VARCHAR)) || ':' || claim, '-') AS given,
                    coalesce(strlen(text) || ':' || text, '-') AS tail
                FROM claimed
            ), leaves AS (
                SELECT doc_id, lang, sha256(head || own || tail) AS leaf, sha256(head || given || tail) AS seen,
                    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
                    count(*) OVER (PARTITION BY lang) AS width
                FROM fields
            ), nodes AS (
                SELECT lang, 0 AS level, pos, leaf AS h, width FROM leaves
                UNION ALL
                SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(width) + 1) // 2
                FROM nodes WHERE width > 1 GROUP BY lang, level, pos // 2
            ), subroots AS (
                SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
                FROM nodes WHERE width = 1
            ), above AS (
                SELECT 0 AS level, pos, subroot AS h, (SELECT count(*) FROM subroots) AS width FROM subroots
                UNION ALL
                SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(width) + 1) // 2
                FROM above WHERE width > 1 GROUP BY level, pos // 2
            ), ways AS (
                SELECT l.doc_id, l.leaf, l.seen, s.subroot, s.height, s.lang, l.pos, s.pos AS root_pos,
                    unnest(range(s.height + (SELECT max(level) FROM above))) AS step
                FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
                UNION ALL
                SELECT l.doc_id, l.leaf, l.seen, s.subroot, s.height, s.lang, l.pos, s.pos, -1
                FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
            ), steps AS (
                SELECT w.*, coalesce(n.h, a.h) AS sibling,
                    CASE WHEN step < height THEN w.pos >> step ELSE root_pos >> (step - height) END & 1 AS side
                FROM ways w
                LEFT JOIN nodes n ON step BETWEEN 0 AND height - 1 AND n.lang IS NOT DISTINCT FROM w.lang
                    AND n.level = step AND n.pos = xor(w.pos >> greatest(step, 0), 1)
                LEFT JOIN above a ON step >= height AND a.level = step - height
                    AND a.pos = xor(w.root_pos >> greatest(step - height, 0), 1)
            )
            SELECT doc_id, any_value(leaf) AS leaf, any_value(subroot) AS subroot,
                any_value(a.h) AS root,
                sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256,
                list_reduce(
                    list(CASE WHEN sibling IS NULL THEN '-' WHEN side = 1 THEN 'L' || sibling ELSE 'R' || sibling END
                        ORDER BY step) FILTER (WHERE step >= 0),
                    lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node WHEN 'R' THEN node || s[2:]
                        ELSE node END), any_value(seen)) AS folded_root,
                folded_root = any_value(a.h) AS verified
            FROM steps, (SELECT h FROM above WHERE width = 1) a GROUP BY doc_id""",
    }
