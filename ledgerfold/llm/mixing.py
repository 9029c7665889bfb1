"""Mixing sources to target weights with Pfair scheduling.

A source is cut into blocks of ``block_size``. In the fluid mix, all sources that have
not ended are read at once, each at a rate in proportion to its target; block k (from
0) of a source is read there from slot S(k / target) to S((k + 1) / target), where
S(v) = sum over the sources of min(target * v, blocks). A block is released at the
slot in which the fluid mix begins it and due by the one in which that ends it. The
blocks released are taken earliest deadline first; as the fluid mix fills every slot
exactly, every deadline is met, so after any number of slots each source has had its
share to within less than one block. When a source ends, S goes on with the others at
higher rates. Every row is placed; none is dropped or repeated.

Targets are used as they are. The schedule is made on the driver, a number per block.

Within a source, rows follow one another by a hash of their doc_id. Sizes are
summed per run of hashes, so that a source with a third of all rows is spread over
many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from heapq import heappop, heappush
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.rows import carried
from ledgerfold.sources.workspace import written

PERIOD, BLOCK_SIZE, RUN_ROWS = 1000, 1 << 16, 512
ROUNDING = 1e-6  # slots by which bounds may miss a whole number


def period_shares(weights: Sequence[float], period: int = PERIOD) -> list[int]:
    """Slots of a period for each weight: at least one, in all ``period``."""
    if not weights or len(weights) > period or min(weights) <= 0:
        raise ValueError(f"need 1 to {period} weights above 0")
    exact = [w / sum(weights) * period for w in weights]
    shares = [max(1, int(x)) for x in exact]
    while step := (sum(shares) < period) - (sum(shares) > period):
        may = [i for i, share in enumerate(shares) if share + step > 0]
        shares[max(may, key=lambda i: (step * (exact[i] - shares[i]), -i))] += step
    return shares


def fluid_bounds(blocks: Sequence[int], targets: Sequence[float]) -> list[np.ndarray]:
    """For each source the slots, as floats, at which the fluid mix ends its first 0, 1, 2, ... blocks."""
    if not len(targets) or min(targets) <= 0:
        raise ValueError("need targets above 0")
    blocks, targets = np.asarray(blocks, np.int64), np.asarray(targets, np.float64)
    order = np.argsort(blocks / targets, kind="stable")
    ends = (blocks / targets)[order]
    ended = np.concatenate([[0], np.cumsum(blocks[order])])  # blocks of the sources that ended first
    rates = np.concatenate([np.cumsum(targets[order][::-1])[::-1], [0.0]])  # of the others
    out = []
    for n, target in zip(blocks, targets):
        v = np.arange(n + 1) / target
        gone = np.searchsorted(ends, v, "left")
        slots = ended[gone] + v * rates[gone]
        near = np.rint(slots)
        out.append(np.where(np.abs(slots - near) < ROUNDING, near, slots))
    return out


def schedule(blocks: Sequence[int], targets: Sequence[float] | None = None) -> list[int]:
    """The source of every slot, earliest deadline first; targets are the numbers of blocks if not given.

    Rounding of the bounds cannot make a deadline pass: between any two slots it would
    have to add a whole block.
    """
    bounds = fluid_bounds(blocks, blocks if targets is None else targets)
    released, due = [np.floor(b[:-1]).astype(int) for b in bounds], [np.ceil(b[1:]).astype(int) for b in bounds]
    future = [(0, i, 0) for i, n in enumerate(blocks) if n]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    order = []
    for now in range(sum(blocks)):
        while future and future[0][0] <= now:
            _, i, k = heappop(future)
            heappush(ready, (int(due[i][k]), i, k))
        deadline, i, k = heappop(ready)
        if deadline <= now:
            raise AssertionError("a deadline passed")
        order.append(i)
        if k + 1 < blocks[i]:
            heappush(future, (int(released[i][k + 1]), i, k + 1))
    return order


Phase = tuple[int, int, int, int, np.ndarray]


def phases(blocks: Sequence[int], weights: Sequence[float], period: int | None = None) -> list[list[Phase]]:
    """For each source its phases: first block, first slot, blocks and slots a period, slots of one.

    The schedule does not repeat, so that a source has one phase of a single period
    with all of its blocks; ``period`` is not used.
    """
    order = np.array(schedule(blocks, weights), np.int64)
    slots = np.split(np.argsort(order, kind="stable"), np.cumsum(blocks)[:-1])
    return [[(0, 0, n, len(order), own)] if n else [] for n, own in zip(blocks, slots)]


def _lane_of(source: str | None) -> str:
    return "" if source is None else f"={source}"


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    block_size: int = BLOCK_SIZE,
    max_sources: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every row of ``docs`` with its place in the mix; read in order of slot, start, doc_id.

    Columns: doc_id, source, start (characters of its source before it), block, slot
    and ``row``, a struct of the columns named in ``carry``. Sizes are characters;
    a row belongs to the block in which it begins. ``weights`` gives targets by
    source, those without one get 1; without ``weights``, a source's target is its
    size to the power of ``temperature``. Every source is scheduled by itself; with
    ``max_sources``, only so many of the largest are, and all others as one source with
    the sum of their targets.

    A missing source is a source of its own. A row without doc_id is ordered by its
    text; NULL and empty texts have size 0; rows that repeat a doc_id follow one
    another. Carried columns may have any names, and others are not read. An empty
    table gives no rows.
    """
    rows = docs.select(
        "doc_id", "source",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(5), F.coalesce("text", F.lit(""))))
        .otherwise(F.xxhash64(F.lit(4), "doc_id")).bitwiseAND(F.lit((1 << 63) - 1)).alias("key"),
        carried(carry).alias("row"),
    )
    sums = written(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    sources = sorted(sums.collect(), key=lambda x: (-x.size, x.source is None, x.source or ""))
    n_rows, sizes = sum(x.n for x in sources), [x.size for x in sources]
    targets = [
        max(x.size, 1) ** temperature if weights is None else float(weights.get(x.source, 1.0)) for x in sources
    ]
    # A lane's name tells a missing source from an empty one.
    numbers = {_lane_of(x.source): i for i, x in enumerate(sources)}
    lane = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    if max_sources is not None and max_sources < len(sources):
        single = F.array(*[F.lit(_lane_of(x.source)) for x in sources[:max_sources]]).cast("array<string>")
        lane = F.when(F.array_contains(single, lane), lane).otherwise(F.lit("others"))
        numbers = {_lane_of(x.source): i for i, x in enumerate(sources[:max_sources])} | {"others": max_sources}
        sizes[max_sources:], targets[max_sources:] = [sum(sizes[max_sources:])], [sum(targets[max_sources:])]
    blocks = [size // block_size + 1 for size in sizes]
    run_bits = max(0, ceil(log2(max(n_rows, 1) / RUN_ROWS)))
    rows = rows.withColumn("lane", lane).withColumn("run", F.shiftright("key", 63 - run_bits))
    runs = rows.groupBy("lane", "run").agg(F.sum("size").alias("run_size"))
    before = Window.partitionBy("lane").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("lane", "run", F.coalesce(F.sum("run_size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("lane", "run").orderBy("key", "doc_id", "size", "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = rows.join(runs, ["lane", "run"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    # All slots by lane and block, and where those of a lane begin.
    slots_of = [p[0][4] for p in phases(blocks, targets)] if n_rows else []
    tables = docs.sparkSession.sparkContext.broadcast(
        (numbers, np.cumsum([0, *blocks]), np.concatenate([np.zeros(0, np.int64), *slots_of]))
    )

    def slots(lanes: pa.Array, block: pa.Array) -> pa.Array:
        numbers, begins, at = tables.value
        lanes = lanes.dictionary_encode()
        begin = np.array([begins[numbers[x]] for x in lanes.dictionary.to_pylist()], np.int64)
        return pa.array(at[begin[lanes.indices.to_numpy()] + block.to_numpy()])

    block = F.floor(F.col("start") / block_size).cast("long")
    return placed.withColumn("block", block).select(
        "doc_id", "source", "start", "block", F.arrow_udf(slots, "long")("lane", "block").alias("slot"), "row"
    )
