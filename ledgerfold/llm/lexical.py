"""Ranked lexical search with bit-sliced Bloom signatures.

Every document has a Bloom signature of its terms; the signatures of a group of
documents are stored by slices, one bitmap of documents for every signature bit. The
slices of a term, taken together, give the documents that may hold it, and never miss
one. A term that occurs often is entered again under a class for each power of two
that its count exceeds, so slices also bound how often it occurs. Sums of term weights
over slices bound every score from above. The best bounds of an item are scored
exactly first; the k-th of these scores then excludes whatever has a lower bound, and
all the rest is scored exactly.

Scale: groups are filled inside the tasks that read the documents, without a shuffle;
signature sizes are powers of two, so short and long documents do not share a group,
and a group's slices take up to 4 MB. Items are searched in blocks of bounded number;
a block scans the slices twice and reads the texts of documents that are not excluded.
Candidates meet their texts by a hash of id and text, which only selects what is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.sources.workspace import shared_folder, written

# Bytes of terms: ASCII letters and digits, and all beyond ASCII; A-Z become a-z.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
PROBES, BITS_PER_KEY, LEAST_BITS = 4, 8, 128
# A term is entered under class c if it occurs at least CLASSES[c] times.
CLASSES = (1, 2, 3, 5, 9, 17, 33, 65)
GROUP_ROWS, GROUP_BITS = 8192, 1 << 25
KNOWN_TERMS, VOCABULARY = 1 << 18, 1 << 18
BLOCK_ITEMS, BROADCAST_ROWS = 512, 1 << 20


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order; none for NULL."""
    return (text or "").encode().translate(_LETTERS).split()


def _hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, 7)


def _places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The slices of each term in class ``level`` of signatures of ``bits``, PROBES each."""
    mixed = (hashes + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    return ((mixed[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


class _Group:
    """Signatures of up to ``rows`` documents, as slices."""

    def __init__(self, bits: int):
        self.bits, self.rows = bits, max(8, min(GROUP_ROWS, GROUP_BITS // bits))
        self.slices = np.zeros((bits, self.rows // 8), np.uint8)
        self.keys: list[int] = []
        self.sizes: list[int] = []

    def add(self, key: int, size: int, places: np.ndarray) -> bool:
        """Enter a document; True if the group is full."""
        n = len(self.keys)
        self.slices[places, n >> 3] |= np.uint8(128 >> (n & 7))
        self.keys.append(key)
        self.sizes.append(size)
        return len(self.keys) == self.rows

    def row(self) -> dict:
        used = -(-len(self.keys) // 8)
        return {"bits": self.bits, "keys": self.keys, "sizes": self.sizes,
                "slices": np.ascontiguousarray(self.slices[:, :used]).tobytes()}


_INDEX = pa.schema([
    ("bits", pa.int64()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("slices", pa.binary()),
    ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("kind", pa.string()),
])
_INDEX_DDL = (
    "bits long, keys array<long>, sizes array<long>, slices binary, terms array<string>, counts array<long>, kind string"
)


def _record(kind: str, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{**dict.fromkeys(_INDEX.names), **values, "kind": kind}], schema=_INDEX)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of signatures, and in how many documents terms occur, of a task's documents."""
    groups: dict[int, _Group] = {}
    known: dict[bytes, int] = {}
    vocabulary: Counter = Counter()

    def counted():
        return _record("vocabulary", terms=[t.decode() for t in vocabulary], counts=list(vocabulary.values()))

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = Counter(terms(text.as_py()))
            if not counts:
                continue
            vocabulary.update(counts.keys())
            if len(known) > KNOWN_TERMS:
                known = {}
            hashes = np.array([known.get(t) or known.setdefault(t, _hash(t)) for t in counts], np.uint64)
            times = np.fromiter(counts.values(), np.int64, len(counts))
            held = [hashes[times >= least] for least in CLASSES]
            keys = sum(map(len, held))
            bits = max(LEAST_BITS, 1 << (keys * BITS_PER_KEY - 1).bit_length())
            group = groups.setdefault(bits, _Group(bits)) if bits not in groups else groups[bits]
            places = np.concatenate([_places(h, c, bits).ravel() for c, h in enumerate(held) if len(h)])
            if group.add(key, int(times.sum()), places):
                yield _record("groups", **groups.pop(bits).row())
            if len(vocabulary) > VOCABULARY:
                yield counted()
                vocabulary.clear()
    for group in groups.values():
        yield _record("groups", **group.row())
    if vocabulary:
        yield counted()


@dataclass(frozen=True)
class Index:
    """Groups of signatures, partial document counts of terms, and the totals N and L."""

    groups: DataFrame
    vocabulary: DataFrame
    documents: int
    terms: int


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with the hash by which candidates are found again; equal rows share it."""
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def index(docs: DataFrame, folder: str) -> Index:
    """The index of all documents with at least one term, written below ``folder``."""
    built = _keyed(docs).select("key", "text").mapInArrow(_build, _INDEX_DDL)
    table = written(built, f"{folder}/index", "kind")
    groups = table.where("kind = 'groups'").select("bits", "keys", "sizes", "slices")
    vocabulary = table.where("kind = 'vocabulary'").select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    totals = groups.agg(
        F.sum(F.size("sizes").cast("long")),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)),
    ).first()
    return Index(groups, vocabulary.select("t.terms", "t.counts").toDF("term", "count"), totals[0] or 0, totals[1] or 0)


@dataclass(frozen=True)
class _Block:
    """Some items with their weighted terms; ``least`` is the lowest score of interest of each."""

    asks: np.ndarray
    terms: list[bytes]
    hashes: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]
    least: np.ndarray
    documents: int
    total: int

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents with ``sizes`` terms."""
        return 75 + (25 * sizes * self.documents) // self.total

    def bounds(self, bits: int, sizes: np.ndarray, slices: np.ndarray) -> Iterator[np.ndarray]:
        """For each item in turn an upper bound of the score of every document of a group."""
        m = self.lengths(sizes)
        held, gains, before = None, [], np.zeros(len(m), np.int64)
        present = []
        for level, _ in enumerate(CLASSES):
            found = np.bitwise_and.reduce(slices[_places(self.hashes, level, bits)], axis=1)
            held = found if held is None else held & found
            if not held.any():
                break
            most = CLASSES[level + 1] - 1 if level + 1 < len(CLASSES) else sizes
            gain = _strength(np.minimum(most, sizes), m)
            gains.append(gain - before)
            present.append(held)
            before = gain
        for own, weights in self.items:
            exact = np.float32 if weights.sum() < 1 << 24 else np.float64
            bound = np.zeros(len(m), np.int64)
            for gain, found in zip(gains, present):
                of_item = found[own]
                if not of_item.any():
                    break
                sums = weights.astype(exact) @ np.unpackbits(of_item, axis=1, count=len(m)).astype(exact)
                bound += sums.astype(np.int64) * gain
            yield bound

    def scores(self, text: str, wanted: list[int]) -> list[int]:
        """The exact scores of a text for the items of those numbers."""
        counts = Counter(terms(text))
        m = int(self.lengths(np.int64(counts.total())))
        strength = {}
        for i, term in enumerate(self.terms):
            if term in counts:
                tf = counts[term]
                strength[i] = 1_000_000_000 * tf // (1000 * tf + 12 * m)
        return [
            sum(w * strength.get(t, 0) for t, w in zip(self.items[i][0].tolist(), self.items[i][1].tolist()))
            for i in wanted
        ]


def _strength(times, m):
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def search(docs: DataFrame, items: DataFrame, k: int, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The k documents with the highest score above 0 for each row of ``items``.

    ``docs`` has doc_id and text, ``items`` item_id and text. A term's weight is
    floor(1000 ln((2N + 2) / (2 df + 1))); a document's m is 75 + 25 n N div L; its score
    sums weight * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats
    included.

    Returns item_id, rank (from 1), doc_id, score; fewer than k rows where fewer
    documents score. Equal scores are ordered by doc_id, a missing one last. Every row
    of ``items`` is an item of its own, and rows of ``docs`` that repeat are documents
    of their own. NULL and empty texts have no terms: such items give no rows, and such
    documents are in no result. Very long texts are read whole. Empty tables give no
    rows. Other columns are not read, whatever their names.
    """
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    found = index(docs, folder)
    number = items.select("item_id", "text").count()
    blocks = -(-number // block_items) or 1
    asked = written(items.select("item_id", "text").repartition(blocks).select(
        F.monotonically_increasing_id().alias("ask"), F.spark_partition_id().alias("block"), "item_id", "text",
    ).mapInArrow(_asked, "ask long, block int, item_id long, term string, times long"), f"{folder}/items")
    wanted = asked.select("term").distinct()
    spread = found.vocabulary.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("count").alias("df"))
    weighed = written(asked.join(spread, "term"), f"{folder}/weighed")
    for block in range(blocks):
        part = weighed.where(F.col("block") == block)
        first = _block(part, found)
        leaders = _leading(_candidates(found.groups, first, k), "item", "bound", k)
        best = _scored(docs, leaders, first, f"{folder}/first-{block}")
        kth = _leading(best, "ask", "score", k).where(F.col("rank") == k)
        certain = _block(part, found, dict(kth.select("ask", "score").collect()))
        _scored(docs, _candidates(found.groups, certain), certain, f"{folder}/scores/block={block}")
    scores = spark.read.schema("ask long, doc_id long, score long").parquet(f"{folder}/scores")
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = weighed.select("ask", "item_id").distinct()
    return ranked.join(names, "ask").select("item_id", "rank", "doc_id", "score")


def _leading(rows: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The rows with the k highest values of each group, ranked; any of those that tie."""
    order = Window.partitionBy(group).orderBy(F.desc(value))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per item and different term."""
    for batch in batches:
        for ask, block, item, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            counts = Counter(terms(text))
            yield pa.RecordBatch.from_arrays([
                pa.array([ask] * len(counts), pa.int64()), pa.array([block] * len(counts), pa.int32()),
                pa.array([item] * len(counts), pa.int64()), pa.array([t.decode() for t in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ], names=["ask", "block", "item_id", "term", "times"])


def _block(part: DataFrame, found: Index, least: dict[int, int] | None = None) -> _Block:
    """The items of one block, which are few, with the terms that documents hold."""
    rows = part.select("ask", "term", "times", "df").toArrow()
    names, place = rows["term"].combine_chunks(), {}
    own = np.array([place.setdefault(t, len(place)) for t in names.to_pylist()], np.int64)
    df = rows["df"].to_numpy()
    # In doubles, as the weight is defined.
    weights = np.floor(1000 * np.log((2 * found.documents + 2) / (2 * df + 1))).astype(np.int64)
    ask, weight = rows["ask"].to_numpy(), weights * rows["times"].to_numpy()
    asks = np.unique(ask)
    items = [(own[ask == a], weight[ask == a]) for a in asks]
    encoded = [t.encode() for t in place]
    lowest = np.array([max((least or {}).get(int(a), 1), 1) for a in asks], np.int64)
    hashes = np.array([_hash(t) for t in encoded], np.uint64)
    return _Block(asks, encoded, hashes, items, lowest, found.documents, found.terms)


def _candidates(groups: DataFrame, block: _Block, best: int | None = None) -> DataFrame:
    """(key, item) of documents whose bound reaches the item's lowest score, or of each task's ``best`` bounds."""
    shared = groups.sparkSession.sparkContext.broadcast(block)

    def scan(batches):
        block = shared.value
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(block.items)
        for batch in batches:
            for row in batch.to_pylist():
                keys, sizes = np.array(row["keys"], np.int64), np.array(row["sizes"], np.int64)
                slices = np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1)
                for i, bound in enumerate(block.bounds(row["bits"], sizes, slices)):
                    reach = np.flatnonzero(bound >= block.least[i])
                    if best is None:
                        if len(reach):
                            yield _pairs(keys[reach], i, bound[reach])
                        continue
                    own = np.concatenate([kept[i][0], keys[reach]]), np.concatenate([kept[i][1], bound[reach]])
                    if len(own[0]) > best:
                        top = np.argpartition(-own[1], best - 1)[:best]
                        own = own[0][top], own[1][top]
                    kept[i] = own
        for i, (keys, bound) in enumerate(kept):
            if len(keys):
                yield _pairs(keys, i, bound)

    return groups.mapInArrow(scan, "key long, item int, bound long")


def _pairs(keys: np.ndarray, item: int, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(np.full(len(keys), item), pa.int32()), pa.array(bound, pa.int64())],
        names=["key", "item", "bound"],
    )


def _scored(docs: DataFrame, candidates: DataFrame, block: _Block, path: str) -> DataFrame:
    """(ask, doc_id, score) of the candidates with a score above 0, written to ``path``."""
    by_key = candidates.groupBy("key").agg(F.collect_set("item").alias("wanted"))
    few = written(by_key, f"{path.replace('/scores/block=', '/candidates-')}-wanted")
    # Few candidates go to the texts; where they are many, both meet by key.
    few = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few.hint("merge")
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def score(batches):
        block = shared.value
        for batch in batches:
            for doc_id, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                scores = block.scores(text.as_py(), wanted)
                found = [(int(block.asks[i]), s) for i, s in zip(wanted, scores) if s > 0]
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([a for a, _ in found], pa.int64()), pa.array([doc_id] * len(found), pa.int64()),
                        pa.array([s for _, s in found], pa.int64()),
                    ], names=["ask", "doc_id", "score"])

    rows = _keyed(docs).join(few, "key").select(F.col("doc_id").cast("long"), "text", "wanted")
    return written(rows.mapInArrow(score, "ask long, doc_id long, score long"), path)
