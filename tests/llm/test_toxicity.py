"""The toxicity classifier: features and scores in plain Python, slopes by differences, held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np

from ledgerfold.llm import toxicity

MASK = (1 << 64) - 1


def plain_row(chars, size):
    h = (sum(ord(c) * pow(0x100000001B3, i, 1 << 64) for i, c in enumerate(chars)) + size) & MASK
    h = h * 0x9E3779B97F4A7C15 & MASK
    return ((h ^ h >> 32) * 0x9E3779B97F4A7C15 & MASK) >> (64 - toxicity.BITS)


def plain_bag(word):
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in toxicity.GRAMS for i in range(len(marked) - n + 1)]
    return [plain_row(marked, 0)] + [plain_row(g, len(g)) for g in grams]


def plain_score(text, model):
    found = toxicity.words(text)
    mean = [sum(model.odds[r] for r in plain_bag(w)) / len(plain_bag(w)) for w in found]
    z = (sum(mean) / len(mean) if mean else 0) + model.bias
    return 1 / (1 + math.exp(-z))


def test_bags():
    for words in (["a", "idiot", "größe", "漢字", "x" * 300, "42"], ["a", "bb"]):
        member, row = toxicity.bags(words)
        assert [sorted(row[member == i]) for i in range(len(words))] == [sorted(plain_bag(w)) for w in words]
    assert len(toxicity.bags([])[0]) == 0


def test_words():
    assert toxicity.words("An ÉTÉ, an id1ot!\x00z") == {"an", "été", "id1ot", "z"}
    assert toxicity.words(None) == toxicity.words(" .\n") == set()


def test_slopes_are_differences():
    rng = np.random.default_rng(5)
    network = toxicity.Network(7, 10.0)
    network.table = rng.normal(size=network.table.shape)
    batch = (np.array([0, 1, 1, 2, 0]), np.array([2, 3, 0]), np.array([0, 0, 1, 2, 2, 2]), np.array([3, 1, 1, 6, 0, 3]),
             np.array([2, 2, 4]), np.array([1, 0, 1]))
    _, by_row, by_softmax, by_bias = network.gradients(*batch)
    for value, slope in ((network.table, by_row), (network.softmax, by_softmax), (network.bias, by_bias)):
        for at in np.ndindex(value.shape):
            value[at] += 1e-6
            up = network.gradients(*batch)[0]
            value[at] -= 2e-6
            down = network.gradients(*batch)[0]
            value[at] += 1e-6
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-6


def _texts(rng, plain, count):
    for i in range(count):
        own = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            own[rng.randrange(len(own))] = rng.choice(["wortless", "worthlesss", "worthless", "wworthless"])
        yield own, int(toxic)


def test_unseen_misspellings_are_found():
    rng = random.Random(7)
    plain = ["".join(rng.choice("abdefghklnoprst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts, labels = zip(*_texts(rng, plain, 800))
    model = toxicity.fit([sorted(set(t)) for t in texts], labels)
    held, wanted = zip(*_texts(rng, plain, 400))
    scores = model.scores([set(" ".join(t).replace("wortless", "worthles").split()) for t in held])
    found = (scores >= 0.5).astype(int)
    assert (found == np.array(wanted)).mean() > 0.97
    clean = held[1]
    assert model.scores([{*clean, "worthlezs"}])[0] > 10 * model.scores([set(clean)])[0]


def test_one_label_or_none():
    assert toxicity.fit([], []).scores([{"a"}])[0] == 0
    assert toxicity.fit([["a"]], [1]).scores([{"b"}, set()]).tolist() == [1, 1]


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(100, 140)] + [(None, 1), (101, None), (102, 1), (102, 0)],
        "doc_id long, toxic int",
    ).selectExpr("*", "'x' AS text", "0 AS quality")
    rows = toxicity.toxicity(odd, labels).collect()
    model = toxicity.fit_on(odd, labels)
    texts = odd.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in rows) == sorted(
        (str(t.doc_id), round(plain_score(t.text, model), 9)) for t in texts
    )
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.5)
    assert toxicity.toxicity(empty, labels).collect() == []
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('word', id % 7, ' and w', id) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic")
    other = labels.withColumn("toxic", (labels.toxic + toxicity.held_out(labels.doc_id).cast("int")) % 2)
    first, second = (toxicity.toxicity(docs, x).orderBy("doc_id").collect() for x in (labels, other))
    assert first == second
