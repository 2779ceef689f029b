"""Sharding along a Hilbert curve, with DataFrame functions only.

Each metadata dimension is cut at its own quantiles, those of whole strings included, into
``2 ** BITS`` cells; the cells' place on the Hilbert curve, then the
document's id, give one total order, which is cut into runs of equal row counts. Rows that
agree or are close in any dimension share few files, so readers skip files by their
minimum and maximum of each dimension.

Law: ``rows``. Shard sizes differ by one row at most, whatever the hot values are. Nulls
form the lowest cell of their dimension; a null or empty text counts 0 bytes (size 16,
crc 0); rows with null or equal ids follow one another in the order of crc and size;
repeated rows take neighbouring slots; of an empty table nothing comes. Other columns pass
through, but for those named like a result, which the result replaces.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.operators.ranking import positions
from vacantia.session import cut_lineage

SHARDS = 40
BITS = 4
OVERHEAD = 16  # bytes counted for each row besides its text


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Digit and next state for each (state, corner) of the ``n``-dimensional curve.

    A state is an entry corner and a main axis; the digit of a corner is its inverse Gray
    code as seen from the state.
    """
    gray = lambda i: i ^ (i >> 1)
    place = {gray(i): i for i in range(1 << n)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1
    digit, following = [], []
    for state in range(n << n):
        entry, axis = state % (1 << n), state >> n
        for corner in range(1 << n):
            w = place[_rotate(corner ^ entry, n - (axis + 1) % n, n)]
            start = 0 if w == 0 else gray(2 * ((w - 1) // 2))
            turn = 0 if w == 0 else trailing(w - 1) % n if w % 2 == 0 else trailing(w) % n
            digit.append(w)
            following.append((axis + turn + 1) % n << n | entry ^ _rotate(start, axis + 1, n))
    return digit, following


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of the cell with these coordinates, each below ``2 ** bits``."""
    n = len(cells)
    digits, states = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def level(acc: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for j, cell in enumerate(cells):
            corner = corner + F.call_function("shiftright", cell, bit).bitwiseAND(F.lit(1)) * (1 << j)
        at = acc["state"] * (1 << n) + corner
        return F.struct(
            (acc["index"] * (1 << n) + F.get(digits, at)).alias("index"),
            F.get(states, at).alias("state"),
        )

    start = F.struct(F.lit(0).alias("index"), F.lit(0).alias("state"))
    steps = F.array(*[F.lit(b) for b in reversed(range(bits))])
    return F.aggregate(steps, start, level, lambda acc: acc["index"])


def _string_cuts(df: DataFrame, names: list[str], parts: int) -> dict[str, list[str]]:
    """For each column the values at which its share of rows passes a multiple of ``1 / parts``.

    Whole values count, however long a beginning they share. Rows are counted by value
    first, so a hot value is one row of what is sorted.
    """
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
    counts = df.select(F.inline(entries)).filter("value IS NOT NULL").groupBy("name", "value").agg(F.count("*").alias("n"))
    ordered = cut_lineage(counts.orderBy("name", "value")).withColumn("part", F.spark_partition_id())
    # At most one row per column and partition of the sorted values.
    sums = ordered.groupBy("name", "part").agg(F.sum("n").alias("m"))
    before = sums.select(
        "name", "part", F.sum("m").over(Window.partitionBy("name")).alias("total"),
        (F.sum("m").over(Window.partitionBy("name").orderBy("part")) - F.col("m")).alias("before"),
    )
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("name", "part").orderBy("value"))
    shares = ordered.join(before, ["name", "part"]).withColumn("upto", upto)
    passed = shares.filter(f"least(upto * {parts} div total, {parts - 1}) > (upto - n) * {parts} div total")
    out: dict[str, list[str]] = {n: [] for n in names}
    for r in passed.select("name", "value").collect():  # fewer than ``parts`` a column
        out[r["name"]].append(r["value"])
    return out


def cells(df: DataFrame, dimensions: list[str], bits: int = BITS) -> tuple[int, list[Column]]:
    """Number of rows, and quantile cell of each dimension.

    The cuts, fewer than ``2 ** bits`` a dimension, are literals.
    """
    parts = 1 << bits
    kinds = dict(df.dtypes)
    texts = [d for d in dimensions if kinds[d] == "string"]
    values = {d: F.col(d) if d in texts else F.col(d).cast("double") for d in dimensions}
    shares = [i / parts for i in range(1, parts)]
    numbers = [d for d in dimensions if d not in texts]
    total, *found = df.agg(F.count("*"), *[F.percentile_approx(values[d], shares, 10000) for d in numbers]).first()
    cuts = dict(zip(numbers, found)) | (_string_cuts(df, texts, parts) if texts else {})
    out = []
    for d in dimensions:
        cell = F.lit(0)
        for c in sorted(set(cuts[d] or [])):
            cell = cell + F.when(values[d] >= c, 1).otherwise(0)
        out.append(cell)
    return total, out


def shard(
    docs: DataFrame, *, by: tuple[str, ...] = ("source", "lang"), shards: int = SHARDS,
    bits: int = BITS, keep: bool = True, order: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with curve, size, text_crc32, law, shard, slot and grown_shard.

    The dimensions are the columns in ``by`` and the size of the text. With ``keep=False``
    of the columns only ``doc_id`` stays, and no text is moved.

    With ``order``, columns that together name a row, rows of one place on the curve and the
    slots of each shard follow it; these columns do not stay.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    size = F.octet_length(body).cast("bigint") + OVERHEAD
    own = {"curve", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "__place", *order}
    kept = [c for c in docs.columns if c.lower() not in own] if keep else ["doc_id"]
    dims = {f"__dim{i}": F.col(c) for i, c in enumerate(by)}
    measured = [*[c.alias(k) for k, c in dims.items()], size.alias("size"), F.crc32(body).alias("text_crc32")]
    base = docs.select(*(order or kept), *measured)
    if order or not keep:
        # No text is in it: written once, so the texts are read once for cuts and places.
        base = cut_lineage(base)
    total, at = cells(base, [*dims, "size"], bits)
    new = {"curve": curve_index(at, bits), "size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("rows")}
    row = "(__place - 1)"
    number = F.expr(f"{row} * {shards} div {max(total, 1)}")
    placed = base.select(*(order or kept), *[c.alias(k) for k, c in new.items()])
    if order:
        # The curve cuts the runs, then each run is put in order; the texts come to it once.
        cut = positions(placed, [F.col(c) for c in ("curve", *order)], "__place").withColumn("shard", number)
        inside = positions(cut.drop("__place"), [F.col(c) for c in ("shard", *order)], "__place").drop("shard")
        ranked = docs.select(*kept, *order).join(inside, [*order]).drop(*order).orderBy("__place")
        ranked = ranked.select(*kept, *new, "__place")
    else:
        ranked = positions(placed, [F.col(c) for c in ("curve", "doc_id", "text_crc32", "size")], "__place")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", number.cast("int"))
        .withColumn("slot", F.expr(row) - first)
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .drop("__place")
    )
