"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of itself and its character n-grams, each hashed to a row of an
embedding table; its vector is the mean of these rows, a text's vector the mean of
its distinct words, and a linear softmax on top gives the probability of label 1.
Embeddings and softmax are trained together. A misspelling that was never seen
shares most of its n-grams with the word that was.

The model is fitted in numpy on a bounded sample of labelled rows, those with the
smallest hash of their id; every whole text is scored, in its task. As the softmax
is linear, a table row matters to a score only by one number, its product with the
softmax weights, so what tasks receive is one number per row, 2 MB in all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.packing import slices

BITS, WIDTH, GRAMS = 18, 2, (3, 4, 5, 6)
FIT_ROWS = 12_000
STEPS, MOST_EPOCHS, BATCH, SOFTMAX_RATE = 1500, 40, 64, 0.05
# In units of what one row adds to a mean: the mean number of members of a text's bags.
RATE, SHRINK = 0.02, 0.2
MIN_COUNT = 8
# Toxic texts are the fewer; each counts for as many.
TOXIC_WEIGHT = 3.0
SLICE_BYTES, WORDS_AT_ONCE = 1 << 21, 1 << 15

# Letters and digits; all beyond ASCII belongs to a word.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BASE, _MIX = 0x100000001B3, np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> set[str]:
    """The distinct words of a text, in lower case; none for NULL."""
    return set(WORD.findall((text or "").lower()))


def bags(found: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, table row) of every member of the words' bags, ordered by word.

    A bag holds the n-grams of the word between a begin and an end mark, repeats
    included, and the whole. The hash is a polynomial of the code points modulo 2**64.
    """
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer("".join(f"<{w}>" for w in found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in found])
    owner = np.repeat(np.arange(len(found)), sizes)
    starts = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.concatenate([[1], np.full(max(int(sizes.max()), *GRAMS) - 1, _BASE)]).astype(np.uint64))
    whole = np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[owner]], starts)
    members, rows = [np.arange(len(found))], [_row(whole, 0)]
    for n in GRAMS:
        count = len(codes) - n + 1
        if count > 0:
            inside = owner[:count] == owner[n - 1:]
            gram = sum(codes[j:j + count] * powers[j] for j in range(n))
            members.append(owner[:count][inside])
            rows.append(_row(gram[inside], n))
    member, row = np.concatenate(members), np.concatenate(rows)
    order = np.argsort(member, kind="stable")
    return member[order], row[order]


def _row(hashes: np.ndarray, size: int) -> np.ndarray:
    mixed = (hashes + np.uint64(size)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """What each table row adds to the log odds of label 1, and the log odds of a text without words."""

    odds: np.ndarray
    bias: float

    def scores(self, texts: Iterable[Iterable[str]]) -> np.ndarray:
        """The probability of label 1 for texts given by their distinct words."""
        place: dict[str, int] = {}
        own = [[place.setdefault(w, len(place)) for w in text] for text in texts]
        known, by_word = list(place), np.zeros(len(place))
        for at in range(0, len(known), WORDS_AT_ONCE):
            member, row = bags(known[at:at + WORDS_AT_ONCE])
            by_word[at:at + WORDS_AT_ONCE] = np.bincount(member, self.odds[row]) / np.bincount(member)
        z = np.array([by_word[sorted(x)].mean() if x else 0.0 for x in own]) + self.bias
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-z))


class Network:
    """The embedding table and the softmax on the mean of a text's word vectors, trained by adaptive steps.

    A word is one of hundreds in its text and a row one of dozens in its word, so table
    rows need large steps to be heard: ``members`` is how many rows a text has in the mean.
    """

    def __init__(self, rows: int, members: float, seed: int = 17):
        self.rate, self.shrink = RATE * members, SHRINK / (BATCH * members)
        random = np.random.default_rng(seed)
        self.table = random.uniform(-1 / WIDTH, 1 / WIDTH, (rows, WIDTH))
        self.softmax = random.uniform(-1, 1, (WIDTH, 2))
        self.bias = np.zeros(2)
        self.squares = [np.full(rows, 1e-12), np.full((WIDTH, 2), 1e-6), np.full(2, 1e-6)]

    def gradients(
        self, own: np.ndarray, sizes: np.ndarray, member: np.ndarray, row: np.ndarray, bag_sizes: np.ndarray,
        labels: np.ndarray,
    ):
        """Loss of a batch, and the slopes of the table, the softmax and its bias.

        ``own`` are the words of the batch, ``sizes`` how many each text has; ``member``
        and ``row`` are the words' bags, as far as their rows are in the table, and
        ``bag_sizes`` the sizes of the whole bags.
        """
        n, distinct, text = len(labels), len(bag_sizes), np.repeat(np.arange(len(labels)), sizes)
        in_text, in_bag = np.maximum(sizes, 1)[:, None], bag_sizes[:, None]
        vectors = _sums(member, self.table[row], distinct) / in_bag
        means = _sums(text, vectors[own], n) / in_text
        logits = means @ self.softmax + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weight = np.where(labels == 1, TOXIC_WEIGHT, 1.0)
        loss = -(weight * np.log(np.maximum(p[np.arange(n), labels], 1e-300))).mean()
        off = weight[:, None] * (p - np.eye(2)[labels]) / n
        by_text = off @ self.softmax.T / in_text
        by_word = _sums(own, by_text[text], distinct) / in_bag
        by_row = _sums(row, by_word[member], len(self.table))
        return loss, by_row, means.T @ off, off.sum(axis=0)

    def step(self, *batch, rate: float = 1.0) -> float:
        loss, by_row, by_softmax, by_bias = self.gradients(*batch)
        # One size of step per table row keeps the direction of its slope; rows shrink to
        # zero unless they earn their place.
        power = (by_row**2).mean(axis=1)
        touched = np.flatnonzero(power)
        self.squares[0][touched] += power[touched]
        size = (rate * self.rate / np.sqrt(self.squares[0][touched]))[:, None]
        moved = self.table[touched] - size * by_row[touched]
        norm = np.maximum(np.sqrt((moved**2).sum(axis=1, keepdims=True)), 1e-12)
        self.table[touched] = moved * np.maximum(1 - size * self.shrink / norm, 0)
        for value, slope, squares in ((self.softmax, by_softmax, self.squares[1]), (self.bias, by_bias, self.squares[2])):
            squares += slope**2
            value -= rate * SOFTMAX_RATE * slope / np.sqrt(squares)
        return loss

    def odds(self) -> np.ndarray:
        return self.table @ (self.softmax[:, 1] - self.softmax[:, 0])


def _sums(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    return np.stack([np.bincount(group, rows[:, d], groups) for d in range(rows.shape[1])], axis=1)


def fit(texts: pa.Array | Sequence[Sequence[str]], labels: Sequence[int], steps: int = STEPS) -> Model:
    """A model of texts given by their distinct words, in an order fixed by a seed.

    With labels of one kind, or none, every text gets that kind's score, or 0.
    """
    labels = np.array(labels, np.int64)
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(1 << BITS), np.inf if labels.any() else -np.inf)
    lists = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.list_(pa.string()))
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    index, known = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    own = np.split(index, ends[:-1])
    in_texts = np.bincount(index, minlength=len(known))
    row, bag_sizes, met = _all_bags(known, in_texts)
    # Rows met in few texts teach nothing; they stay zero, and their words are as long as before.
    kept, place = np.flatnonzero(met >= MIN_COUNT), np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    row = place[row]
    common = row >= 0
    begins = np.concatenate([[0], np.cumsum(common, dtype=np.int32)])[np.concatenate([[0], np.cumsum(bag_sizes)])]
    row = row[common]
    members = (in_texts * bag_sizes).sum() / len(own)
    network, random = Network(len(kept), members), np.random.default_rng(18)
    epochs = min(MOST_EPOCHS, -(-steps * BATCH // len(labels)))
    for epoch in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            used, index = np.unique(np.concatenate([own[i] for i in rows]), return_inverse=True)
            spans = begins[used + 1] - begins[used]
            inside = np.repeat(begins[used] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            network.step(
                index, np.array([len(own[i]) for i in rows]), np.repeat(np.arange(len(used)), spans), row[inside],
                bag_sizes[used], labels[rows], rate=1 - epoch / epochs,
            )
    odds = np.zeros(1 << BITS)
    odds[kept] = network.odds()
    return Model(odds, float(network.bias[1] - network.bias[0]))


def _all_bags(known: pa.Array, in_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table rows of all words' bags, one after the other, the sizes of the bags, and how often texts meet each row."""
    rows, sizes, met = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], np.zeros(1 << BITS)
    for at in range(0, len(known), WORDS_AT_ONCE):
        part = known.slice(at, WORDS_AT_ONCE).to_pylist()
        member, row = bags(part)
        rows.append(row.astype(np.int32))
        sizes.append(np.bincount(member, minlength=len(part)))
        met += np.bincount(row, in_texts[at + member], 1 << BITS)
    return np.concatenate(rows), np.concatenate(sizes), met


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept from the fit: one in five, by the CRC-32 of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model fitted on up to ``fit_rows`` labelled rows that are not held out.

    Labels without doc_id or mark are left out; of several for one document, the
    higher counts. The sample is bounded, so it is broadcast to the texts, and its
    words are gathered in the task that fits; the driver receives the model.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = sample.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(fit_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def extract(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                found = [sorted(words(t.as_py())) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(found, pa.list_(pa.string()))],
                    names=["doc_id", "toxic", "words"],
                )

    rows = rated.select(F.col("doc_id").cast("long"), "text", "toxic").mapInArrow(
        extract, "doc_id long, toxic int, words array<string>"
    )

    def train(batches):
        table = pa.Table.from_batches(batches, sample_schema)
        model = fit(table["words"].combine_chunks(), table["toxic"].to_pylist())
        yield pa.RecordBatch.from_pydict({"odds": [model.odds], "bias": [model.bias]})

    sample_schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("words", pa.list_(pa.string()))])
    limited = rows.orderBy("doc_id", F.hash("words")).limit(fit_rows)
    model = limited.mapInArrow(train, "odds array<double>, bias double").toArrow()
    if not len(model):
        return fit([], [])
    return Model(model["odds"].combine_chunks().flatten().to_numpy(), model["bias"][0].as_py())


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score and predicted (1 from a score of 0.5 up).

    A score depends on the whole text and nothing else, so repeated rows come out
    alike. NULL counts as empty; texts without words get the score of the bias. A
    missing doc_id is not held out. Without usable labels every score is 0. An empty
    table gives no rows. Other columns are not read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_on(docs, labels, fit_rows))

    def of_batch(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = (part.column(0) for part in slices(batch, 0, SLICE_BYTES))
        found = [shared.value.scores([words(t.as_py()) for t in part]) for part in parts]
        return pa.array(np.concatenate([np.zeros(0), *found]))

    score = F.arrow_udf(of_batch, "double")(F.col("text"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
