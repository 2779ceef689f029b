"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in a fixed pseudo-random order, are cut into blocks of equal
row counts. Block k of a source that shall have the share w of all slots is released at
floor(k / w) and due at ceil((k + 1) / w); in each slot the released block with the earliest
deadline is placed. So at any time every source is less than one block away from its share.

When a source has no blocks left, a new phase begins in which the others share the slots by
their weights; nothing is dropped or repeated. Shares are whole numbers of 2^-60 of all
slots, finer than doubles hold them, so what rounding adds is below a millionth of a block
in a million million slots.

The schedule is worked out by many tasks, each for its own run of slots. For that, the number
of blocks each source has had at a border is told without what came before: its share rounded
down or up, such that the number rounded up among those released last, and among those due
first, is off by less than one. Then neither what is before the border nor what is after it
lacks slots, and earliest deadline first fills both. A run is as long as the longest window
(the inverse of the smallest share) at least, so that no block lies across two borders. Tasks and
driver hold a few numbers a source; the phases cost the square of the number of sources.

Defined cases: a null source counts as the source ''; a source with rows but without a
target weight, or with one that is not above 0 and finite, is an error, one without rows
takes no slots; rows without an id and repeated rows are placed like others; the last block of
a source may be short; an empty table gives no rows.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import chain, islice
from math import ceil, isfinite

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ROWS = 16
WHOLE = 1 << 60
RUN = 4096  # slots worked out at a time, at least
TASK_SLOTS = 1 << 18
TEMPERATURE = 0.5
BUCKET_ROWS = 10_000


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Shares as whole numbers that sum to ``WHOLE``, one at least for each source."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = (WHOLE - len(exact)) / sum(exact.values())
    exact = {s: w * scale for s, w in exact.items()}
    out = {s: int(x) + 1 for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    for s in by_rest[: WHOLE - sum(out.values())]:
        out[s] += 1
    return out


def window(k: int, share: int) -> tuple[int, int]:
    """Release and deadline of a source's block ``k``, in slots."""
    return k * WHOLE // share, -(-(k + 1) * WHOLE // share)


def _signs(some: list[int], orders: tuple[list[int], ...], first: int) -> dict[int, int]:
    """1 or -1 for each, neighbours (first and second, third and fourth ...) of each order apart."""
    chosen, beside = set(some), {i: [] for i in some}
    for order in orders:
        line = [i for i in order if i in chosen]
        for x, y in zip(line[::2], line[1::2]):
            beside[x].append(y)
            beside[y].append(x)
    out: dict[int, int] = {}
    for i in sorted(some, key=lambda i: i != first):
        todo = [] if i in out else [(i, 1)]
        while todo:
            x, sign = todo.pop()
            out[x] = sign
            todo += [(y, -sign) for y in beside[x] if y not in out]
    return out


def served(shares: list[int], t: int, first: int = -1) -> list[int]:
    """Blocks that each source has had after ``t`` slots; they sum to ``t``.

    The share of the slots is rounded bit by bit from the lowest, half of the odd ones up and
    half down, neighbours by release and by deadline apart: the sums along both orders
    stay less than one off. Source ``first`` is always rounded up.
    """
    down, rest = [w * t // WHOLE for w in shares], [w * t % WHOLE for w in shares]
    sides = [window(k, w) for k, w in zip(down, shares)]
    orders = tuple(sorted(range(len(shares)), key=lambda i: (sides[i][side], i)) for side in (0, 1))
    bit = 1
    while bit < WHOLE:
        odd = [i for i, x in enumerate(rest) if x & bit]
        for i, sign in _signs(odd, orders, first).items():
            rest[i] += sign * bit
        bit <<= 1
    return [k + x // WHOLE for k, x in zip(down, rest)]


@dataclass
class Phase:
    number: int
    begin: int  # slots before it
    length: int
    sources: list[str]
    shares: list[int]
    done: list[int]  # blocks before it
    ends: int  # a source that places its last block

    def served(self, t: int) -> list[int]:
        return served(self.shares, t, self.ends if t == self.length else -1)

    def runs(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Borders of the runs that begin in slots ``low`` to ``high``; the last one takes what is over."""
        size = max(RUN, -(-WHOLE // min(self.shares)))
        last = max(1, self.length // size) - 1
        for k in range(max(0, -(-(low - self.begin) // size)), last + 1):
            if self.begin + k * size >= high:
                break
            yield k * size, self.length if k == last else (k + 1) * size

    def slots(self, start: int, end: int) -> Iterator[tuple[str, int, int, int, int, int]]:
        """(source, block, phase, slot, release, deadline) of all slots between two borders."""
        now, last = self.served(start), self.served(end)
        waiting = [(window(k, w)[0], i) for i, (k, w) in enumerate(zip(now, self.shares)) if k < last[i]]
        heapq.heapify(waiting)
        ready: list[tuple[int, int]] = []
        for t in range(start, end):
            while waiting and waiting[0][0] <= t:
                _, i = heapq.heappop(waiting)
                heapq.heappush(ready, (min(end, window(now[i], self.shares[i])[1]), i))
            due, i = heapq.heappop(ready)
            assert t < due
            release, due = window(now[i], self.shares[i])
            yield self.sources[i], self.done[i] + now[i], self.number, self.begin + t, self.begin + release, self.begin + due
            now[i] += 1
            if now[i] < last[i]:
                heapq.heappush(waiting, (window(now[i], self.shares[i])[0], i))


def phases(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[Phase]:
    """The phases in order; each ends where a source places its last block."""
    left = {s: blocks[s] for s in sorted(blocks) if blocks[s] > 0}
    done, begin, number = dict.fromkeys(left, 0), 0, 0
    while left:
        share = whole_weights({s: weights[s] for s in left})
        length = min(n * WHOLE // share[s] for s, n in left.items())
        ends = next(i for i, (s, n) in enumerate(left.items()) if -(-share[s] * length // WHOLE) == n)
        phase = Phase(number, begin, length, list(left), [share[s] for s in left], [done[s] for s in left], ends)
        yield phase
        for s, n in zip(phase.sources, phase.served(length)):
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n > 0}
        begin, number = begin + length, number + 1


def placed(blocks: dict[str, int], weights: dict[str, float], low: int, high: int) -> Iterator[Iterator[tuple]]:
    """The slots of all runs that begin in ``low`` to ``high``, run by run."""
    for phase in phases(blocks, weights):
        for start, end in phase.runs(low, high):
            yield phase.slots(start, end)
        if phase.begin + phase.length >= high:
            break


def schedule(spark, blocks: dict[str, int], weights: dict[str, float]) -> DataFrame:
    """One row per block: ``__of``, ``__block`` and ``__at`` (slot, phase, release, deadline)."""
    names = ["__of", "__block", "__phase", "__slot", "__release", "__deadline"]
    kind = pa.schema([(names[0], pa.string()), *[(n, pa.int64()) for n in names[1:]]])

    def run(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                rows = chain.from_iterable(placed(blocks, weights, task * TASK_SLOTS, (task + 1) * TASK_SLOTS))
                while some := list(islice(rows, 1 << 16)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*some), kind)], schema=kind
                    )

    tasks = max(1, -(-sum(blocks.values()) // TASK_SLOTS))
    found = spark.range(0, tasks, 1, tasks).mapInArrow(
        run, "__of string, __block long, __phase long, __slot long, __release long, __deadline long"
    )
    return found.select("__of", "__block", F.struct("__slot", "__phase", "__release", "__deadline").alias("__at"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, *, block_rows: int = BLOCK_ROWS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """``docs`` with ``__block``, ``__place`` (in the block), ``__phase``, ``__release``,
    ``__deadline`` and ``__slot``.

    Without weights a source's is its number of rows to the power ``temperature``. A row's place
    in its source goes by a hash of its id and then the id. Rows are counted per source and
    bucket of the hash first, so that no task ranks more than a bucket, however large a
    source is; the slots of a bucket's blocks come to its rows with these counts.
    """
    docs = docs.withColumn("__source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    counts = {r[0]: r[1] for r in docs.groupBy("__source").count().collect()}
    if weights is None:
        weights = {s: n**temperature for s, n in counts.items()}
    missing = [s for s in counts if s not in weights or not (isfinite(weights[s]) and weights[s] > 0)]
    if missing:
        raise ValueError(f"no target weight for {sorted(missing)[:5]}")
    weights = {s: weights[s] for s in counts}
    table = schedule(docs.sparkSession, {s: ceil(n / block_rows) for s, n in counts.items()}, weights)
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    # Rows without an id go by their text, where it is at hand.
    other = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    hashed = docs.withColumn("__hash", F.when(F.col("doc_id").isNull(), other).otherwise(F.xxhash64("doc_id")))
    place = F.floor((F.shiftrightunsigned("__hash", 32)) * buckets / float(1 << 32)).cast("long")
    hashed = hashed.withColumn("__bucket", place)
    sizes = hashed.groupBy("__source", "__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__source").orderBy("__bucket")) - F.col("__n")
    sizes = sizes.select("__source", "__bucket", "__n", before.alias("__before"))
    held = F.sequence(F.expr(f"__before DIV {block_rows}"), F.expr(f"(__before + __n - 1) DIV {block_rows}"))
    sizes = (
        sizes.withColumn("__has", F.explode(held))
        .join(table, (F.col("__source") == F.col("__of")) & (F.col("__has") == F.col("__block")))
        .groupBy("__source", "__bucket")
        .agg(F.min("__before").alias("__before"), F.sort_array(F.collect_list(F.struct("__block", "__at"))).alias("__held"))
    )
    within = Window.partitionBy("__source", "__bucket").orderBy("__hash", "doc_id", *(["text"] if "text" in docs.columns else []))
    ranked = hashed.withColumn("__within", F.row_number().over(within)).join(sizes, ["__source", "__bucket"])
    rank = F.col("__before") + F.col("__within") - 1
    ranked = ranked.withColumns({"__block": F.floor(rank / block_rows), "__place": rank % block_rows})
    at = F.expr(f"get(__held, CAST(__block - __before DIV {block_rows} AS INT)).__at")
    return ranked.withColumns(
        {f"__{n}": at.getField(f"__{n}") for n in ("slot", "phase", "release", "deadline")}
    ).drop("__held")


def plan(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """One row per document: source, block, place in it, phase, release, deadline, slot."""
    names = ("block", "place", "phase", "release", "deadline", "slot")
    out = mix(docs.select("doc_id", "source"), weights, **options)
    return out.select("doc_id", F.col("__source").alias("source"), *[F.col(f"__{n}").alias(n) for n in names])


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """``docs`` in mixed order; same rows and columns."""
    out = mix(docs, weights, **options)
    order = ["__slot", "__place"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*[out[c] for c in docs.columns])
