"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are grouped into partitions, correlated bits together. If partition i
gets a threshold t_i >= -1 and the sum of (t_i + 1) is ``max_bits`` + 1, two
fingerprints within ``max_bits`` agree up to t_i bits on some partition i. The
thresholds are found by dynamic programming on estimated candidate counts, from
statistics of all fingerprints. A partition with threshold t is probed with every
set of t of its bits left out, so each probe is an equality on masked bits.

Identical fingerprints are one class. Buckets of up to ``BUCKET`` classes are
compared pair by pair and verified. Larger ones are probed again on the bits
outside their mask, which must be within ``max_bits`` as well. Buckets that are
still larger are dense, and pairs would grow with the square: their classes meet
at the points halfway between them instead, 65 for two bits. Two fingerprints
within two bits share such a point, and two that share one are within two bits,
so nothing is missed and no pair is formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.components import connected_components
from ledgerfold.llm.rows import carried
from ledgerfold.sources.workspace import shared_folder, written

BITS, SEED = 64, 42
BUCKET = 32
CHUNK = 1 << 16


def _fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1:].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(stops), CHUNK):
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])),
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * ones > len(stops), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of the word shingles of ``text``, as a signed long.

    A-Z is lower-cased; words are runs of characters other than ASCII white space;
    shingles, repeats included, are joined by single blanks. A text with fewer
    words is one shingle, one without words (NULL too) has fingerprint zero. A bit
    is set if it is set in over half of the shingles' XXH64 values with seed 42.
    """

    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array((_fingerprint(t.as_py(), shingle) for t in texts), pa.int64())

    return F.arrow_udf(of_batch, "long")(text)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row of ``docs``: its fingerprint and its component.

    Columns: ``doc_id``, ``fingerprint`` (long), ``component_id``, ``kept`` and
    ``row``, a struct of the columns named in ``carry``. Fingerprints within
    ``max_bits`` (0 to 3) are linked; a component is all that links reach, its id
    the smallest doc_id in it (NULL if it has none). ``kept`` marks one row per
    component, that of the smallest doc_id; of rows that repeat it, exactly one.
    NULL and empty texts have no words; texts without words are linked like any other,
    and long texts are hashed whole. Carried columns may have any names, and others are
    not read. An empty table gives no rows.
    """
    folder = shared_folder(docs.sparkSession)
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            fingerprint(F.col("text"), shingle).alias("fp"),
            carried(carry).alias("row"),
        ),
        f"{folder}/rows",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "uid"))
    classes = written(rows.groupBy("fp").agg(first.alias("first")), f"{folder}/classes")
    roots = connected_components(links(classes.select("fp"), max_bits))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    chosen = placed.groupBy("root").agg(F.min("first").alias("first"))
    chosen = written(
        placed.select("fp", "root").join(chosen, "root").select("fp", "first"), f"{folder}/chosen"
    )
    return rows.join(chosen, "fp").select(
        "doc_id",
        F.col("fp").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        "row",
    )


def links(fingerprints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) that join all of the distinct ``fp`` within ``max_bits``.

    Every pair within the distance is joined by a path of links, and every link is
    within it. In dense buckets such a path goes over the smallest fingerprint
    around each shared point.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError(f"max_bits must be 0 to 3, not {max_bits}")
    folder = shared_folder(fingerprints.sparkSession)
    statistics = bit_statistics(fingerprints)
    masks = allocate(fingerprints, *statistics, max_bits)
    shared = _shared(_index(fingerprints, masks), f"{folder}/probe-1")
    inner = {
        mask: [mask | sub for sub in _parts(_order(statistics[1], ~mask & _ALL), max_bits + 1)]
        for mask in masks
    }
    crowded = shared.where(F.col("size") > BUCKET)
    again = _shared(_index(crowded, inner), f"{folder}/probe-2")
    found = [_pairs(x.where(F.col("size") <= BUCKET), max_bits) for x in (shared, again)]
    dense = again.where(F.col("size") > BUCKET).select("fp").distinct()
    return reduce(DataFrame.union, [*found, _around_points(dense, max_bits)]).distinct()


_ALL = (1 << BITS) - 1


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bit_statistics(fingerprints: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Share of ones of each bit, and the 64 x 64 matrix of absolute correlations.

    Every task sums its own 64 x 64 matrix; the driver gets their sum.
    """

    def both_set(batches):
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(fps), CHUNK):
                bits = np.unpackbits(
                    fps[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                ).astype(np.float32)
                total += bits.T @ bits
            rows += len(fps)
        if rows:
            a, b = np.indices((BITS, BITS)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (a, b, total.astype(np.int64).ravel(), np.full(BITS**2, rows))],
                names=["a", "b", "n", "rows"],
            )

    sums = (
        fingerprints.select("fp")
        .mapInArrow(both_set, "a long, b long, n long, rows long")
        .groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    )
    both, rows = np.zeros((BITS, BITS)), 1
    for x in sums.collect():
        both[x.a, x.b], rows = x.n, x.rows
    share = np.diag(both) / rows
    spread = np.sqrt(share * (1 - share))
    scale = np.outer(spread, spread)
    apart = np.abs(both / rows - np.outer(share, share))
    return share, np.divide(apart, scale, out=np.zeros_like(apart), where=scale > 0)


def _order(correlation: np.ndarray, allowed: int) -> list[int]:
    """The allowed bits, each next to the one that it goes with most."""
    left = [b for b in range(BITS) if allowed >> b & 1]
    order = [left.pop(0)] if left else []
    while left:
        left.sort(key=lambda b: (-correlation[order[-3:], b].sum(), b))
        order.append(left.pop(0))
    return order


def _parts(order: Sequence[int], count: int) -> list[int]:
    """Masks of ``count`` runs of ``order``, as even as possible."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(np.array(order, int), count)]


def allocate(
    fingerprints: DataFrame, share: np.ndarray, correlation: np.ndarray, max_bits: int
) -> list[int]:
    """The masks to probe: partitions, each with the bits left out that its threshold allows.

    Partitionings into ``max_bits`` + 1 and + 2 parts compete. Pairs that agree on a
    partition are counted over all fingerprints; those within t bits are estimated
    from that count and the shares of ones.
    """
    order = _order(correlation, _ALL)
    plans = [_parts(order, count) for count in (max_bits + 1, max_bits + 2)]
    values = fingerprints.select(F.inline(F.array(*[
        F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for m in dict.fromkeys(m for plan in plans for m in plan)
    ])))
    counted = values.groupBy("mask", "key").count().groupBy("mask").agg(
        F.sum(F.col("count").cast("double") ** 2).alias("pairs"), F.sum("count").alias("rows")
    ).collect()
    equal = {x.mask % (1 << BITS): (x.pairs, x.rows) for x in counted}
    differ = 2 * share * (1 - share)
    odds = differ / np.maximum(1 - differ, 1e-9)

    def cost(mask: int, threshold: int) -> float:
        if threshold < 0:
            return 0.0
        pairs, rows = equal.get(mask, (0.0, 0))
        bits = [b for b in range(BITS) if mask >> b & 1]
        sums = [1.0] + [0.0] * threshold
        for b in bits:
            for t in range(threshold, 0, -1):
                sums[t] += sums[t - 1] * odds[b]
        return pairs * sum(sums) + rows * comb(len(bits), threshold)

    best: tuple[float, list[int]] = (float("inf"), [])
    for plan in plans:
        reached: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for mask in plan:
            following: dict[int, tuple[float, list[int]]] = {}
            for spent, (price, chosen) in reached.items():
                for t in range(-1, max_bits + 1 - spent):
                    new = (price + cost(mask, t), [*chosen, t])
                    if new[0] < following.get(spent + t + 1, (float("inf"),))[0]:
                        following[spent + t + 1] = new
            reached = following
        price, thresholds = reached[max_bits + 1]
        if price < best[0]:
            best = price, _probes(plan, thresholds)
    return best[1]


def _probes(plan: Sequence[int], thresholds: Sequence[int]) -> list[int]:
    masks = []
    for mask, t in zip(plan, thresholds):
        bits = [b for b in range(BITS) if mask >> b & 1]
        masks += [mask & ~sum(1 << b for b in out) for out in combinations(bits, max(t, 0))] if t >= 0 else []
    return masks


def _index(rows: DataFrame, masks: Sequence[int] | dict[int, list[int]]) -> DataFrame:
    """A row per fingerprint and mask; for crowded rows, the finer masks of their mask."""

    def probes(some: Sequence[int]) -> Column:
        return F.array(*[
            F.struct(
                F.lit(_signed(m)).alias("mask"),
                F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"),
                "fp",
            )
            for m in some
        ])

    if isinstance(masks, dict):
        finer = [F.when(F.col("mask") == _signed(m), probes(subs)) for m, subs in masks.items()]
        return rows.select(F.inline(F.coalesce(*finer))).distinct()
    return rows.select(F.inline(probes(masks)))


def _shared(index: DataFrame, path: str) -> DataFrame:
    """The rows of buckets with more than one row, and the size of their bucket."""
    sizes = index.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return written(index.join(written(sizes, f"{path}-sizes"), ["mask", "key"]), path)


def _pairs(rows: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs within small buckets."""
    lists = rows.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
    return lists.select(F.inline(F.expr(f"""
        filter(
            flatten(transform(fps, (x, i) ->
                transform(slice(fps, i + 2, size(fps)), y -> struct(x AS a, y AS b)))),
            p -> bit_count(p.a ^ p.b) <= {max_bits}
        )""")))


def _around_points(dense: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints that share a point halfway.

    For an odd distance one bit is left out at a time and the rest is halved. A
    point has at most as many fingerprints around it as its ball has members.
    """
    radius = max_bits // 2
    cases = [(b, 1 << b) for b in range(BITS)] if max_bits % 2 else [(-1, 0)]
    flips = [
        (case, off, sum(1 << b for b in some))
        for case, off in cases
        for size in range(radius + 1)
        for some in combinations([b for b in range(BITS) if not off >> b & 1], size)
    ]
    spark = dense.sparkSession
    moves = spark.createDataFrame(
        [(case, _signed(~off & _ALL), _signed(flip)) for case, off, flip in flips],
        "left_out int, mask long, flip long",
    )
    moves = moves.agg(F.collect_list(F.struct("left_out", "mask", "flip"))).scalar()
    points = dense.select("fp", F.explode(moves).alias("move")).select(
        "fp",
        F.col("move.left_out").alias("left_out"),
        F.col("fp").bitwiseAND(F.col("move.mask")).bitwiseXOR(F.col("move.flip")).alias("point"),
    )
    around = points.groupBy("left_out", "point").agg(F.collect_list("fp").alias("fps"))
    around = around.where(F.size("fps") > 1)
    return around.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")
