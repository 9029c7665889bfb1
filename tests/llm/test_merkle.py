"""The Merkle manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, **changed):
    values = [{**r.asDict(), **changed}[f] for f in merkle.FIELDS]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, at):
    return [level[(at >> n) ^ 1] if (at >> n) ^ 1 < len(level) else None for n, level in enumerate(tree[:-1])]


def expected(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row, sorted as text."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append((r.doc_id is None, r.doc_id or 0, leaf(r), r.doc_id))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([t[2] for t in sorted(by_lang[x], key=lambda t: t[:3])]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    return sorted(str((t[3], t[2], trees[x][-1][0], top[-1][0], way(trees[x], i) + way(top, n)))
                  for n, x in enumerate(langs) for i, t in enumerate(sorted(by_lang[x], key=lambda t: t[:3])))


def _got(rows):
    return sorted(str((r.doc_id, r.leaf, r.subroot, r.root, list(r.siblings))) for r in rows)


def test_odd_rows(odd, empty):
    rows = merkle.manifest(odd).collect()
    assert _got(rows) == expected(odd.collect())
    assert all(r.verified and r.folded_root == r.root for r in rows)
    assert merkle.manifest(empty).collect() == []


@pytest.mark.parametrize("count", [1, 2, 3, 5, 256, 257, 600])
def test_trees_of_every_shape(spark, count):
    langs = [None, "", "=", "a", "ä", "zz"]
    docs = spark.range(count).selectExpr(
        "id AS doc_id", "concat('text ', id) AS text",
        f"element_at(array({', '.join('NULL' if x is None else repr(x) for x in langs)}), int(least(id % 11, 5)) + 1) AS lang",
        "CAST(NULL AS string) AS source", "if(id % 5 = 0, NULL, id) AS n_chars",
    )
    changed = F.col("doc_id") % 3 == 0
    claim = {"n_chars": F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    rows = merkle.manifest(docs, claim).collect()
    assert _got(rows) == expected(docs.collect())
    for r in rows:
        # A missing n_chars stays missing, so there is nothing to find.
        assert r.verified == (r.doc_id % 3 != 0 or r.doc_id % 5 == 0)
        node = leaf(docs.where(f"doc_id = {r.doc_id}").first(), n_chars=r.doc_id + 1) if not r.verified and count < 10 else None
        for digest, left in zip(r.siblings, r.left) if node else ():
            node = H(*filter(None, (digest, node) if left else (node, digest)))
        assert node is None or node == r.folded_root


def test_a_changed_text_is_found(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    claim = {"text": F.when(F.col("doc_id") == 7, "T").otherwise(F.col("text"))}
    assert [r.doc_id for r in merkle.manifest(docs, claim).where("not verified").collect()] == [7]
