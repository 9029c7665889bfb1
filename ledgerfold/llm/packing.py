"""Best-fit packing of token pieces by exact-complement hashing.

Documents are encoded, cut where they are longer than a sequence, and counted by
length: at most ``capacity`` numbers, whatever the corpus. The plan is made on
these counts. For each length, longest first, single lengths, sums of two and of
three are looked up that fill its gap exactly, and each combination found is used
as often as the counts allow. What has no exact complement is packed best-fit. A
pattern uses up at least one length, so their number is bounded by the capacity.

Pieces find their place without meeting: a piece is the r-th of its length, and
the plan says which sequence that is. Ranks are counted per task and offset by the
sums of the tasks before, so a hot length is never gathered.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Sequence
from functools import cache
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.operators.balances import shuffle_tasks
from ledgerfold.plans.tables import numbered
from ledgerfold.sources.workspace import shared_folder, written

CAPACITY = 2048
# For each plan the eighths of the capacity from which on a piece's gap is filled by pairs, and by triples.
COMBINED_FROM = ((0, 0), (0, 4), (0, 6), (0, 7), (4, 4), (4, 6), (4, 7), (6, 6), (6, 7), (7, 7))
SLICE_BYTES = 4 << 20
KNOWN_WORDS, RUN_WORDS = 1 << 18, 1024

Pattern = tuple[int, list[tuple[int, int]]]


class WordEncoder:
    """Token ids of whole texts for a tokenizer that never joins across white space.

    Runs between white space that are letters and digits, then ASCII punctuation, are
    split there, as the punctuation is always a pre-token of its own. Each
    distinct core and tail of a slice is encoded once and kept, and texts are put
    together from their ids. Runs with letters beyond Latin-1, which may change their
    kind when normalised, and those that may hold a special token stay whole. What is
    kept only saves time; it starts afresh when full.
    """

    PLAIN = "^[!-~À-ÖØ-öø-ÿ]*$"
    MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    LETTERS = "".join(chr(i) for i in range(256) if chr(i).isascii() and chr(i).isalnum() or i >= 0xC0 and i not in (0xD7, 0xF7))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Encode new words; plain ones in runs, where each is one pre-token."""
        plain, others = [], []
        for word in words:
            (plain if word.isalpha() and (word.isascii() or max(word) <= "ÿ") else others).append(word)
        ids, lengths = [], []
        for at in range(0, len(plain), RUN_WORDS):
            run = plain[at:at + RUN_WORDS]
            found = self.tokenizer.encode(" ".join(run), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            lengths.append(np.bincount(found.word_ids, minlength=len(run)))
        for found in self.tokenizer.encode_batch(others, add_special_tokens=False):
            ids.append(np.array(found.ids, np.uint32))
            lengths.append([len(found.ids)])
        for number, word in enumerate([*plain, *others], len(self.known)):
            self.known[word] = number
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of words under which their ids are kept."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = [self.known.get(w, -1) for w in distinct]
        if -1 in numbers:
            self._learn([w for w, number in zip(distinct, numbers) if number < 0])
            numbers = [self.known[w] for w in distinct]
        return np.array(numbers, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text; none for NULL."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        coded = split.flatten().dictionary_encode()
        runs = coded.dictionary
        plain = pc.and_not(pc.match_substring_regex(runs, self.PLAIN), pc.match_substring(runs, "<|"))
        runs = pc.if_else(plain, pc.utf8_lower(runs), runs)
        cores, tails = pc.utf8_rtrim(runs, self.MARKS), pc.utf8_ltrim(runs, self.LETTERS)
        meet = pc.equal(pc.add(pc.binary_length(cores), pc.binary_length(tails)), pc.binary_length(runs))
        split_up = pc.and_(plain, meet)
        cores, tails = pc.if_else(split_up, cores, runs), pc.if_else(split_up, tails, "")
        both = np.stack([self._numbers(cores), self._numbers(tails)], axis=1)
        unit = both[coded.indices.to_numpy(zero_copy_only=False)].ravel()
        lengths = np.diff(self.ends)[unit]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        stream = self.ids[np.repeat(self.ends[unit] - ends[:-1], lengths) + np.arange(ends[-1])]
        at = ends[2 * bounds]
        return [stream[a:b] for a, b in zip(at[:-1], at[1:])]


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks that a worker runs."""
    return WordEncoder(path)


def slices(batch: pa.RecordBatch, column: int = 0, most: int = SLICE_BYTES) -> list[pa.RecordBatch]:
    """The batch in runs of rows of up to ``most`` bytes of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    cuts, size = [0], 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            cuts.append(i)
            size = 0
        size += n
    return [batch.slice(a, b - a) for a, b in zip(cuts, [*cuts[1:], len(sizes)]) if b > a]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Every document's ids and ``end_id``, cut to ``capacity`` where longer.

    Columns: doc_id, piece, start, length, ids_crc32, and block and rank, which
    count pieces of a length within their task; ``keep_ids`` adds the ids, and the columns
    in ``order``, which are longs, go along. NULL and empty texts are one piece of one id.
    """

    def cut(batches):
        encoder, seen = word_encoder(tokenizer), Counter()
        block = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, 1):
                out = [[] for _ in range(8 + len(order))]
                places = zip(*(part.column(2 + i).to_pylist() for i in range(len(order)))) if order else repeat(())
                for doc_id, ids, place in zip(part.column(0).to_pylist(), encoder.encode(part.column(1)), places):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start:start + capacity]
                        row = (doc_id, piece, start, len(own), zlib.crc32(own.tobytes()), block,
                               seen[len(own)], *place, own if keep_ids else None)
                        seen[len(own)] += 1
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(out, kinds)], names=names
                )

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "rank"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, rank long"
    kinds, names = [*kinds, *[pa.int64()] * len(order)], [*names, *order]
    schema = ", ".join([schema, *(f"{c} long" for c in order)])
    if keep_ids:
        kinds, names, schema = [*kinds, pa.list_(pa.int64())], [*names, "ids"], f"{schema}, ids array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text", *order).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns (times used, [(length, pieces of it)]) that use up all counts.

    Exact complements by one, two and three pieces come first, in every plan. Pairs and
    triples for short pieces use up what longer gaps would need, so plans that stop to
    look for them at different lengths are made, and the one with the fewest sequences
    is taken.
    """
    plans = [_plan(counts, capacity, *(capacity * n // 8 for n in least)) for least in COMBINED_FROM]
    return min(plans, key=lambda patterns: sum(times for times, _ in patterns))


def _plan(counts: dict[int, int], capacity: int, pairs_from: int, triples_from: int) -> list[Pattern]:
    """The plan that fills gaps of pieces of at least these lengths by pairs and by triples too."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[Pattern] = []

    def use(lengths: list[int]) -> None:
        need = Counter(lengths)
        times = int(min(left[x] // n for x, n in need.items()))
        for x, n in need.items():
            left[x] -= times * n
        patterns.append((times, sorted(need.items(), reverse=True)))

    sums = _pair_sums(left, capacity)
    for length in range(capacity, 0, -1):
        while left[length]:
            filled = _exact(left, sums, length, capacity, 3 if length >= triples_from else 2 if length >= pairs_from else 1)
            if filled is None:
                break
            before = left > 0
            use([length, *filled])
            if (before != (left > 0)).any():
                sums = _pair_sums(left, capacity)
    for length in range(capacity, 0, -1):
        while left[length]:
            lengths, gap = [length], capacity - length
            taken = Counter(lengths)
            while gap:
                fits = np.flatnonzero(left[:gap + 1])[::-1]
                best = next((int(x) for x in fits if left[x] > taken[int(x)]), 0)
                if not best:
                    break
                n = int(min(gap // best, left[best] - taken[best]))
                lengths += [best] * n
                taken[best] += n
                gap -= best * n
            use(lengths)
    return patterns


def _pair_sums(left: np.ndarray, capacity: int) -> np.ndarray:
    """For each sum, whether two pieces make it: the index of pair sums."""
    there = (left > 0).astype(np.float64)
    sums = np.rint(np.fft.irfft(np.fft.rfft(there, 2 * capacity + 2) ** 2))[:capacity + 1]
    single = np.flatnonzero(left == 1)
    single = single[2 * single <= capacity]
    sums[2 * single] -= 1  # one piece is no pair
    return sums > 0.5


def _exact(left: np.ndarray, sums: np.ndarray, length: int, capacity: int, most: int) -> list[int] | None:
    """Up to ``most`` lengths whose sum is the gap, longest first; None without any."""
    gap = capacity - length
    free = left.copy()
    free[length] -= 1
    if gap == 0:
        return []
    if free[gap] > 0:
        return [gap]
    if most >= 2 and gap >= 2 and sums[gap] and (pair := _pair(free, free > 0, gap)):
        return pair
    if most >= 3:
        longest = np.arange(min(gap - 2, length), 0, -1)
        for a in longest[(free > 0)[longest] & sums[gap - longest]].tolist():
            free[a] -= 1
            if pair := _pair(free, free > 0, gap - a):
                return [a, *pair]
            free[a] += 1
    return None


def _pair(free: np.ndarray, there: np.ndarray, total: int) -> list[int] | None:
    a = np.arange(total - 1, (total - 1) // 2, -1)
    good = there[a] & there[total - a] & ((2 * a != total) | (free[a] > 1))
    return [int(a[good][0]), int(total - a[good][0])] if good.any() else None


def pack(cut: DataFrame, capacity: int = CAPACITY, order: Sequence[str] = ()) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: their place without gaps.

    ``cut`` must be a written table, as ranks hold for one run of ``pieces``. With
    ``order``, pieces of a length are taken in the order of these columns, and sequences
    are numbered in the order of their first piece. An empty table gives no rows.
    """
    if order:
        cut = _in_order(cut, order)
    counts = cut.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    patterns = plan({x.length: x.n for x in totals}, capacity)
    firsts, used, places = [0, *accumulate(times for times, _ in patterns)], Counter(), []
    for first, (times, items) in zip(firsts, patterns):
        offset = 0
        for length, n in items:
            places.append(((length << 44) + used[length], n, first, offset))
            used[length] += times * n
            offset += length * n
    table = np.array(sorted(places), np.int64).reshape(-1, 4)
    shared = cut.sparkSession.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = cut.join(bases, ["block", "length"]).withColumn("rank", F.col("base") + F.col("rank"))
    ranked = ranked.drop("block", "base")
    names = [c for c in ranked.columns if c != "rank"]

    def place(batches):
        starts, many, first, offset = shared.value.T
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = (length << 44) + batch.column("rank").to_numpy()
            row = np.searchsorted(starts, key, "right") - 1
            nth = key - starts[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(first[row] + nth // many[row]),
                   pa.array(offset[row] + nth % many[row] * length)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(*names).schema)
    placed = ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
    if not order:
        return placed
    placed = written(placed)
    firsts = placed.groupBy("sequence_id").agg(F.min(F.struct(*order)).alias("first"))
    numbers = numbered(firsts, "first", "sequence_id").select("sequence_id", (F.col("row_number") - 1).alias("place"))
    return placed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("place")).drop("place")


def _in_order(cut: DataFrame, order: Sequence[str]) -> DataFrame:
    """The pieces, ranked among those of their length by ``order`` instead of by task.

    A range of the order is a block, and ranks begin anew in it, so that a length with
    most of the pieces is spread over many tasks.
    """
    keys = [*order, "doc_id", "piece", "block", "rank"]
    ranges = cut.repartitionByRange(shuffle_tasks(cut), "length", *keys).sortWithinPartitions("length", *keys)
    rows = written(ranges.withColumns({"at": F.monotonically_increasing_id(), "block": F.spark_partition_id()}))
    first = rows.groupBy("length", "block").agg(F.min("at").alias("first"))
    ranked = rows.join(first, ["length", "block"]).withColumn("rank", F.col("at") - F.col("first"))
    return ranked.select(*cut.columns)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """Encode, cut and pack ``docs``: a row per piece with its place.

    ``order`` names columns of ``docs``, longs, in whose order pieces of a length are
    used and sequences are numbered, from 0.

    NULL texts count as empty; a missing doc_id stays missing; repeated rows are
    packed each. Other columns of ``docs`` are not read, whatever their names.
    """
    folder = shared_folder(docs.sparkSession)
    # Under names that no column of the pieces has.
    by = [f"by_{i}" for i in range(len(order))]
    known = docs.select("doc_id", "text", *[F.col(f"`{c}`").cast("long").alias(b) for b, c in zip(by, order)])
    cut = written(pieces(known, tokenizer, capacity, keep_ids=keep_ids, order=by), f"{folder}/pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(cut, capacity, by).select(*columns, *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ids of all pieces, in place. Needs ``keep_ids``.

    A sequence has at most ``capacity`` ids, so its pieces may meet in one row.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p.doc_id, p.piece, p.offset)).alias("pieces"),
    )
