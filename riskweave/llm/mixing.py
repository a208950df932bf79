"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are put in a random but repeatable order and cut into blocks. A fluid mixture would serve all
sources at once, each at a rate in proportion to its weight; when one runs dry the others go on in proportion. Block j of a
source is served by the fluid from the time of its j-th to that of its (j + 1)-th block, which follow from the weights and
sizes in closed form. The block is released at the floor of the first and due by the ceiling of the second; earliest deadline
first, one block a slot, then keeps every source within one block of the fluid at all times, over the whole mixture. The
fluid is a schedule in which every block lies inside its window, so no deadline can be missed. All times are exact rationals.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.common import cut_lineage, free_names

BLOCK = 64  # documents
SLOTS = 1000  # that the task of the schedule hands on together
TEMPERATURE = 0.5  # weights follow the size of a source to this power unless given
BROADCAST_PLACES = 500_000  # places (16 bytes each) that may be broadcast to the texts; beyond that Spark joins by shuffle
BUCKET_ROWS = 20_000  # rows that are numbered together


class Fluid:
    """The fluid mixture of sources with some blocks and weights, as exact rationals."""

    def __init__(self, blocks: Mapping[str, int], weights: Mapping[str, float]):
        exact = {s: Fraction(weights[s]) for s in blocks if blocks[s]}
        scale = lcm(*(w.denominator for w in exact.values()))
        self.blocks = {s: blocks[s] for s in exact}
        self.rate = {s: int(w * scale) for s, w in exact.items()}
        ends: dict[Fraction, list[str]] = {}
        for s, u in self.rate.items():
            ends.setdefault(Fraction(blocks[s], u), []).append(s)
        # in virtual time, in which a source of rate u serves u blocks a unit: when sources run dry, and before each
        # such moment the rate of those left and the blocks of those that ran dry earlier
        self.dry = sorted(ends)
        self.rates, self.served = [sum(self.rate.values())], [0]
        for v in self.dry:
            self.rates.append(self.rates[-1] - sum(self.rate[s] for s in ends[v]))
            self.served.append(self.served[-1] + sum(blocks[s] for s in ends[v]))

    def time(self, source: str, block: int, part: int = 0) -> tuple[int, int, int]:
        """Slots (floor, ceiling) by which the fluid has served so many blocks of a source, and the part of the mixture.

        `part` is the number of moments before at which sources ran dry, or a smaller one.
        """
        u = self.rate[source]
        if block * self.dry[part].denominator > self.dry[part].numerator * u:
            part = bisect_left(self.dry, Fraction(block, u), part)
        whole, rest = divmod(self.rates[part] * block, u)
        return whole + self.served[part], whole + self.served[part] + (rest > 0), part


def schedule(fluid: Fluid) -> Iterator[tuple[str, int]]:
    """The source and block of each slot, by earliest deadline among released blocks (ties: the earlier name).

    Holds one block a source, however long the mixture is.
    """
    waiting = [(0, s, 0, 0) for s in sorted(fluid.blocks)]  # release, source, block, part
    ready: list[tuple[int, str, int, int, int]] = []  # deadline, source, block, part, release of the next block
    for t in range(sum(fluid.blocks.values())):
        while waiting and waiting[0][0] <= t:
            _, s, j, part = heapq.heappop(waiting)
            release, due, part = fluid.time(s, j + 1, part)
            heapq.heappush(ready, (due, s, j, part, release))
        due, s, j, part, release = heapq.heappop(ready)
        if t >= due:
            raise AssertionError("a deadline was missed")
        yield s, j
        if j + 1 < fluid.blocks[s]:
            heapq.heappush(waiting, (release, s, j + 1, part))


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], slots: int = SLOTS) -> list[dict]:
    """The whole schedule, for a look at small ones: rows (source, first, stop, quota, start, period, offsets).

    A row for each source and phase, the slots between two moments at which sources run dry. The weight of the source is
    quota / period; block j with first <= j < stop lies in slot start + offsets[j - first].
    """
    fluid = Fluid(blocks, weights)
    turns, done, start, out = schedule(fluid), dict.fromkeys(fluid.blocks, 0), 0, []
    for v, rate, served in zip(fluid.dry, fluid.rates, fluid.served):
        end = -(-(rate * v + served).numerator // (rate * v + served).denominator)
        offsets: dict[str, list[int]] = {}
        for t, (s, _) in enumerate(islice(turns, end - start)):
            offsets.setdefault(s, []).append(t)
        for s, held in sorted(offsets.items()):
            out.append({"source": s, "first": done[s], "stop": done[s] + len(held), "quota": fluid.rate[s], "start": start, "period": rate, "offsets": held})
            done[s] += len(held)
        start = end
    return out


def slot_of(plan: list[dict], source: str, block: int) -> int:
    for r in plan:
        if r["source"] == source and r["first"] <= block < r["stop"]:
            return r["start"] + r["offsets"][block - r["first"]]
    raise KeyError(source)


def source_key(source: Column) -> Column:
    """Text that names a source; rows without one are a source of their own."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows numbered from 0 within their source in the order of a hash, and the sizes (source, n) of the sources.

    A source may hold any part of the rows: it is cut into buckets by the hash, each numbered on its own, and the sizes of
    the buckets before are added.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("source"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit("mix")))
    rows = cut_lineage(rows)
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * buckets).cast("long"))
    sizes = cut_lineage(rows.groupBy("source", "bucket").count())
    totals = sizes.groupBy("source").agg(F.sum("count").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0).cast("long"))).drop("count")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1).join(sizes, ["source", "bucket"])
    return rows.select("doc_id", "source", (F.col("before") + F.col("inside")).alias("number")), totals


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, slots: int = SLOTS, temperature: float = TEMPERATURE) -> DataFrame:
    """doc_id, source, block, slot, position for each row of (doc_id, source); `position` runs from 0 over the mixture.

    `weights` gives the target weight of sources (None for rows without one); sources that are not named get the mean
    weight. Without weights they follow from the sizes. Each source is used up, nothing is repeated or left out. Rows of one
    doc_id each get a place, ties in no set order; further columns are ignored. An empty table gives no rows.

    One task walks the schedule, which is sequential: it reads a row a source, writes a row a block and holds one block a
    source, `slots` rows of output at a time.
    """
    named = None if weights is None else {"-" if s is None else f"={s}": float(w) for s, w in weights.items()}
    if named and any(w <= 0 for w in named.values()):
        raise ValueError("weights must be positive")
    rows, sizes = _numbered(docs)
    slotted = cut_lineage(sizes.repartition(1).mapInArrow(_slots(named, block, slots, temperature), "source string, block long, slot long, lost long"))
    out = rows.withColumn("block", F.floor(F.col("number") / block)).join(slotted, ["source", "block"])
    position = F.col("slot") * block + F.col("number") % block - F.col("lost")
    return out.select("doc_id", F.when(F.col("source") != "-", F.expr("substring(source, 2)")).alias("source"), "block", "slot", position.alias("position"))


def _slots(named: dict[str, float] | None, block: int, slots: int, temperature: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[str, int] = {}
        for batch in batches:
            sizes.update(zip(batch.column("source").to_pylist(), batch.column("n").to_pylist(), strict=True))
        if not sizes:
            return
        if named is None:
            target = {s: float(n) ** temperature for s, n in sizes.items()}
        else:
            usual = sum(named.values()) / max(len(named), 1) or 1.0
            target = {s: named.get(s, usual) for s in sizes}
        turns = schedule(Fluid({s: -(-n // block) for s, n in sizes.items()}, target))
        slot, lost = 0, 0
        while part := list(islice(turns, slots)):
            gaps = []
            for s, j in part:  # the last block of a source may be short: positions behind it move up
                gaps.append(lost)
                lost += max((j + 1) * block - sizes[s], 0)
            columns = [[s for s, _ in part], [j for _, j in part], range(slot, slot + len(part)), gaps]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i else pa.string()) for i, c in enumerate(columns)], names=["source", "block", "slot", "lost"])
            slot += len(part)

    return run


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """All rows of `docs` with their columns, laid out by position: written files, read by name, hold the mixture in order."""
    key, place = free_names(docs, "id", "position")
    places = mix(docs, **options).groupBy(F.col("doc_id").alias(key)).agg(F.min("position").alias(place))
    places = cut_lineage(places)
    few = places.count() <= BROADCAST_PLACES
    out = docs.join(F.broadcast(places) if few else places, docs["doc_id"].cast("long").eqNullSafe(F.col(key)))
    return out.repartitionByRange(place).sortWithinPartitions(place).select(*docs.columns)
