"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight per hashed feature is shared by all grades; ordered thresholds cut the
score into grades: P(grade <= k) = sigmoid(threshold_k - score). From the
probabilities follow the expected grade and the tail probability of reaching a
grade, by which documents are selected.

Features of a text are its distinct words, the beginnings of words (families of words
share them), the marks that end words, and classes of how often words repeat, carry marks or are in capitals. Ratings are noisy and most
words are rare, so features below ``MIN_COUNT`` texts are left out of the fit and
weights shrink to zero unless they earn their place. The model is fitted on a bounded
sample of rated rows, those with the smallest hash of their id; every row of the
table is scored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.packing import slices
from ledgerfold.llm.rows import carried

BITS = 18
FIT_ROWS = 12_000
STEPS, BATCH, RATE, SHRINK, MIN_COUNT = 2000, 64, 0.1, 1e-3, 5
MIN_TAIL = 0.5
KNOWN_WORDS, SLICE_BYTES = 1 << 17, 1 << 21


def _feature(name: str) -> int:
    return xxhash.xxh64_intdigest(name) & ((1 << BITS) - 1)


class Features:
    """Hashed features of texts. Each distinct word of a slice is hashed once and kept."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        if word not in self.known:
            core = word.strip(STOPS + "\"'()[]{}<>")
            letters = core.rstrip(STOPS + MARKS)
            mark = core[len(letters):].strip(STOPS)
            lower = letters.lower()
            self.known[word] = (
                len(letters) > 1 and letters.isupper(), _feature("m " + mark), _feature("w " + lower),
                *(_feature("b " + lower[:n]) for n in BEGINNINGS),
            )
        return self.known[word]

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """Distinct features of every text, ascending; NULL counts as empty."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        words = np.array([self._word(w) for w in coded.dictionary.to_pylist()], np.int64).reshape(-1, 3 + len(BEGINNINGS))
        index = coded.indices.to_numpy(zero_copy_only=False)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = index[a:b]
            distinct = np.unique(own)
            shares = {
                "new": len(distinct), "again": np.count_nonzero(own[1:] == own[:-1]),
                "marks": np.count_nonzero(words[own, 1] != PLAIN), "capitals": words[own, 0].sum(),
            }
            classes = [_feature(f"{name} {int(10 * n / max(len(own), 1))}") for name, n in shares.items()]
            out.append(np.unique(np.concatenate([words[distinct, 1:].ravel(), classes]).astype(np.int64)))
        return out


STOPS, MARKS = ".,;:", "!?#$%&*|_~^=+-/\\@"
BEGINNINGS = (4, 5)
PLAIN = _feature("m ")


@dataclass(frozen=True)
class Model:
    """Shared weights, ordered thresholds between grades, and the grades themselves."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def tails(self, features: Sequence[np.ndarray]) -> np.ndarray:
        """P(grade >= g) for every text and every grade but the lowest."""
        scores = np.array([self.weights[f].sum() for f in features])
        return _sigmoid(scores[:, None] - self.thresholds)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(features: Sequence[np.ndarray], ratings: Sequence[int]) -> Model:
    """Maximum likelihood with an L1 penalty by adaptive proximal steps, in an order fixed by a seed.

    Grades are those that occur. Thresholds stay ordered, as the gaps between them
    are exponentials. Without ratings, or with one grade, every text has that grade.
    """
    grades = np.unique(np.array(ratings, np.int64))
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    cuts = max(len(grades) - 1, 0)
    free, free_squares = np.zeros(cuts), np.full(cuts, 1e-3)

    def thresholds():
        return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))

    if cuts:
        common = np.bincount(np.concatenate(features), minlength=1 << BITS) >= MIN_COUNT
        features = [x[common[x]] if common[x].any() else x[:1] for x in features]
        grade = np.searchsorted(grades, ratings)
        random = np.random.default_rng(17)
        for _ in range(-(-STEPS * BATCH // len(grade))):
            order = random.permutation(len(grade))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                sizes = [len(features[i]) for i in rows]
                columns = np.concatenate([features[i] for i in rows])
                scores = np.add.reduceat(weights[columns], np.cumsum([0, *sizes[:-1]]))
                edges = np.concatenate([[-np.inf], thresholds(), [np.inf]])
                up, down = (_sigmoid(edges[grade[rows] + i] - scores) for i in (1, 0))
                p = np.maximum(up - down, 1e-9)
                by_score = (1 - up - down) / len(rows)
                touched, place = np.unique(columns, return_inverse=True)
                slope = np.bincount(place, np.repeat(by_score, sizes))
                squares[touched] += slope**2
                step = RATE / np.sqrt(squares[touched])
                moved = weights[touched] - step * slope
                weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * SHRINK, 0)
                by_edge = np.bincount(grade[rows] + 1, -up * (1 - up) / p, cuts + 2)
                by_edge += np.bincount(grade[rows], down * (1 - down) / p, cuts + 2)
                by_free = np.cumsum(by_edge[1:-1][::-1])[::-1] / len(rows)
                by_free[1:] *= np.exp(free[1:])
                free_squares += by_free**2
                free -= RATE * by_free / np.sqrt(free_squares)
    return Model(weights, thresholds(), grades if len(grades) else np.zeros(1, np.int64))


def ratings(labels: DataFrame) -> DataFrame:
    """doc_id and rating: one for quality and one for not being toxic.

    Labels without doc_id or with a missing mark are left out; of several for one
    document, the worse marks count.
    """
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg((F.min("quality") + 1 - F.max("toxic")).cast("int").alias("rating"))


def fit_on(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model fitted on up to ``fit_rows`` rated rows of ``docs``.

    The sample is bounded, so it is broadcast to the texts, and its features are
    gathered in the task that fits; the driver receives the model.
    """
    sample = ratings(labels).orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(fit_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def extract(batches):
        features = Features()
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(features.of(part.column(1)), pa.list_(pa.int32()))],
                    names=["doc_id", "rating", "features"],
                )

    rows = rated.select(F.col("doc_id").cast("long"), "text", "rating").mapInArrow(
        extract, "doc_id long, rating int, features array<int>"
    )

    def train(batches):
        table = pa.Table.from_batches(batches, sample_schema)
        lists = table["features"].combine_chunks()
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        features = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        model = fit(features, table["rating"].to_pylist())
        yield pa.RecordBatch.from_pydict({
            "weights": [model.weights], "thresholds": [model.thresholds], "grades": [model.grades],
        })

    sample_schema = pa.schema([("doc_id", pa.int64()), ("rating", pa.int32()), ("features", pa.list_(pa.int32()))])
    limited = rows.orderBy("doc_id", F.hash("features")).limit(fit_rows)
    model = limited.mapInArrow(train, "weights array<double>, thresholds array<double>, grades array<long>").toArrow()
    if not len(model):
        return fit([], [])
    return Model(*[model[c].combine_chunks().flatten().to_numpy() for c in ("weights", "thresholds", "grades")])


def grade(text: Column, model: Model, spark) -> Column:
    """A struct of expected_grade and tail_probability, that of the best grade."""
    shared = spark.sparkContext.broadcast(model)

    def of_batch(texts: pa.Array) -> pa.Array:
        model, features = shared.value, Features()
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [x for part in slices(batch, 0, SLICE_BYTES) for x in features.of(part.column(0))]
        tails = model.tails(found).reshape(len(texts), -1)
        steps = np.diff(model.grades)
        return pa.StructArray.from_arrays(
            [pa.array(model.grades[0] + tails @ steps),
             pa.array(tails[:, -1] if len(steps) else np.ones(len(texts)))],
            names=["expected_grade", "tail_probability"],
        )

    return F.arrow_udf(of_batch, "expected_grade double, tail_probability double")(text)


def graded(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, min_tail: float = MIN_TAIL,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: its grade and whether it is selected.

    Columns: doc_id, expected_grade, tail_probability (of the best grade), kept
    (tail_probability >= ``min_tail``) and ``row``, a struct of the columns named in
    ``carry``, whatever they are called. NULL texts are scored as empty ones, long texts
    whole. Repeated rows come out alike. Without usable labels every row is kept. An
    empty table gives no rows. Columns that are not carried are not read.
    """
    model = fit_on(docs, labels, fit_rows)
    scored = docs.select(
        "doc_id",
        grade(F.col("text"), model, docs.sparkSession).alias("grade"),
        carried(carry).alias("row"),
    )
    return scored.select(
        "doc_id", "grade.expected_grade", "grade.tail_probability",
        (F.col("grade.tail_probability") >= min_tail).alias("kept"), "row",
    )
