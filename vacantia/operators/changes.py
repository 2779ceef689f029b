"""Snapshot-to-snapshot change detection."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vacantia.functions.money import band, band_text
from vacantia.functions.once import evaluate_once
from vacantia.operators.merge import first_per_key, one_per_id

TRACKED = ["title", "url", "location", "salary", "remote_policy", "seniority"]
SUMMARY = ["company_slug", "title", "url", "location", "source", "posted_at"]


class EmptySnapshotError(RuntimeError):
    """Today's snapshot has no rows although yesterday's has."""


def repaired(jobs: DataFrame) -> DataFrame:
    """Null text becomes empty and the flat salary columns become one validated struct."""
    salary = band(
        F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"), F.col("salary_period")
    )
    text = {
        c: F.coalesce(c, F.lit(""))
        for c in ("title", "location", "description_md")
        if c in jobs.columns
    }
    lists = {
        c: F.coalesce(c, F.array().cast("array<string>"))
        for c in ("countries", "languages", "stack")
        if c in jobs.columns
    }
    return jobs.withColumns({**text, **lists, "salary": salary}).drop(
        "salary_min", "salary_max", "salary_currency", "salary_period"
    )


def _last_rows(jobs: DataFrame, sequence: str | None) -> tuple[DataFrame, T.StructType]:
    """``id``, ``text`` and ``posted_at`` of one row per id, and the columns that the text holds.

    The text breaks ties between rows of an id. It tells all compared columns but the exact time,
    so rows move as that alone, not once as text and once as columns.
    """
    columns = list(dict.fromkeys(SUMMARY + TRACKED))
    rows = repaired(jobs)
    held = rows.select(*[c for c in columns if c != "posted_at"]).schema
    text = F.to_json(F.struct(*columns)).alias("text")
    rows = rows.select("id", text, "posted_at", *([sequence] if sequence in rows.columns else []))
    order = [F.col("text").desc()]
    if sequence in rows.columns:
        order = [F.col(sequence).desc_nulls_last(), *order]
    return first_per_key(rows, ["id"], order).select("id", "text", "posted_at"), held


def _sides(today: DataFrame, yesterday: DataFrame, sequence: str | None) -> tuple[DataFrame, Callable, Callable]:
    """The last rows of both dates side by side, and how to read the other columns of each from its text."""
    now, held_now = _last_rows(today, sequence)
    was, held_was = _last_rows(yesterday, sequence)
    both = now.select("id", F.col("text").alias("__now"), F.col("posted_at").alias("__now_at")).join(
        was.select("id", F.col("text").alias("__was"), F.col("posted_at").alias("__was_at")), "id", "full_outer"
    )
    return both, lambda text: F.from_json(text, held_now), lambda text: F.from_json(text, held_was)


def pair_snapshots(
    today: DataFrame, yesterday: DataFrame, *, sequence: str | None = "ingest_seq"
) -> DataFrame:
    """One row per id of either side: ``id``, structs ``now`` and ``was`` (null if absent).

    An id held several times counts with its last row, by ``sequence`` where it is stored.
    """
    both, now, was = _sides(today, yesterday, sequence)
    read = evaluate_once(both, now=now(F.col("__now")), was=was(F.col("__was")))

    def whole(side: str) -> Column:
        fields = [F.col(f"__{side}_at") if c == "posted_at" else F.col(side)[c] for c in dict.fromkeys(SUMMARY + TRACKED)]
        named = [c.alias(n) for n, c in zip(dict.fromkeys(SUMMARY + TRACKED), fields)]
        return F.when(F.col(side).isNotNull(), F.struct(*named)).alias(side)

    return read.select("id", whole("now"), whole("was"))


def _text(side: Column, field: str) -> Column:
    return band_text(side[field]) if field == "salary" else side[field].cast("string")


def change_events(
    today: DataFrame, yesterday: DataFrame, *, sequence: str | None = "ingest_seq"
) -> DataFrame:
    """The change log: ``new`` rows with summary fields, ``removed`` ids, ``changed`` fields.

    One full outer join; the three kinds of event come out of a single explode.
    Description text is never read.
    """
    now, was = F.col("now"), F.col("was")
    null = F.lit(None).cast("string")

    def event(kind: str, field: Column, old: Column, new: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("event"), field.cast("string").alias("field"),
            old.cast("string").alias("old"), new.cast("string").alias("new"),
        )

    changes = F.filter(
        F.array(
            *[
                F.when(
                    ~was[f].eqNullSafe(now[f]),
                    event("changed", F.lit(f), _text(was, f), _text(now, f)),
                )
                for f in TRACKED
            ]
        ),
        lambda e: e.isNotNull(),
    )
    events = (
        F.when(was.isNull(), F.array(event("new", null, null, null)))
        .when(now.isNull(), F.array(event("removed", null, null, null)))
        .otherwise(changes)
    )
    both, read_now, read_was = _sides(today, yesterday, sequence)
    # Equal texts are equal rows, and nothing is told of a removed row: neither is read.
    known = F.when(F.col("__now").isNull() & F.col("__was").isNotNull(), F.lit("{}")).otherwise(F.col("__was"))
    differ = both.filter(~F.col("__now").eqNullSafe(F.col("__was")))
    pairs = evaluate_once(differ, now=read_now(F.col("__now")), was=read_was(known))
    exploded = pairs.select("id", "now", "__now_at", F.explode(events).alias("e"))
    is_new = F.col("e.event") == "new"
    return exploded.select(
        F.col("e.event").alias("event"),
        "id",
        *[F.when(is_new, F.col("__now_at") if c == "posted_at" else now[c]).alias(c) for c in SUMMARY],
        F.col("e.field").alias("field"),
        F.col("e.old").alias("old"),
        F.col("e.new").alias("new"),
    )


def bucket_digests(jobs: DataFrame) -> DataFrame:
    """``n`` and two sums of row hashes for each bucket, over the columns that a diff compares.

    Equal figures mean equal rows, whatever their order; only pruned columns are read, and the
    sums are formed before the shuffle. Sums of two dates can be added up to coarser buckets.
    """
    columns = ["id", *dict.fromkeys(SUMMARY + TRACKED), *[c for c in ("ingest_seq",) if c in jobs.columns]]
    row = F.struct(*[F.col(c) for c in columns])
    rows = repaired(jobs)
    hashes = [F.xxhash64(F.lit(seed), row).cast("decimal(38,0)") for seed in (1, 2)]
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.sum(h).cast("decimal(38,0)").alias(f"sum_{i}") for i, h in enumerate(hashes)]
    )


def changed_buckets(today: DataFrame, yesterday: DataFrame) -> tuple[int, list[int]] | None:
    """Number of buckets both dates can be cut into, and those in which they differ.

    None where a date has no digests. Bucket counts are powers of two, so the finer ones add up.
    """
    sides, fewest = [], [df.agg(F.min("buckets")).first()[0] for df in (today, yesterday)]
    if None in fewest:
        return None
    common = min(fewest)
    for df in (today, yesterday):
        sums = [F.sum(c).alias(c) for c in ("n", "sum_0", "sum_1")]
        sides.append(df.groupBy((F.col("bucket") % common).alias("bucket")).agg(*sums).select("bucket", F.struct("n", "sum_0", "sum_1").alias("d")))
    now, was = sides
    both = now.join(was.withColumnRenamed("d", "old"), "bucket", "full_outer").filter(~F.col("d").eqNullSafe(F.col("old")))
    return common, sorted(r[0] for r in both.select("bucket").collect())  # at most one row a bucket


def refuse_if_broken(today: DataFrame, yesterday: DataFrame) -> None:
    """Stop before writing a diff against an empty (broken) run."""
    if today.isEmpty() and not yesterday.isEmpty():
        raise EmptySnapshotError("today's snapshot is empty while yesterday's is not")


def events_by_company(events: DataFrame) -> DataFrame:
    """Small rollup both the counts and the leaderboard of a summary start from."""
    return events.groupBy("event", "company_slug").agg(F.count("*").alias("n"))


def change_summary(events: DataFrame, *, top: int = 5) -> DataFrame:
    """One row: the three counts, the ``top`` companies of new rows, and the alert text."""
    rollup = events_by_company(events)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("event") == kind, F.col("n"))), F.lit(0))

    counts = rollup.agg(
        total("new").alias("n_new"),
        total("removed").alias("n_removed"),
        total("changed").alias("n_changed"),
    )
    leaders = (
        rollup.filter(F.col("event") == "new")
        .orderBy(F.col("n").desc(), F.col("company_slug"))
        .limit(top)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "company_slug"))).alias("t"))
        .select(
            F.array_join(
                F.transform(
                    "t", lambda r: F.concat(r["company_slug"], F.lit("("), (-r["k"]).cast("string"), F.lit(")"))
                ),
                ", ",
            ).alias("top")
        )
    )
    head = F.concat(
        F.lit("+"), F.col("n_new"), F.lit(" new · -"), F.col("n_removed"),
        F.lit(" removed · ~"), F.col("n_changed"), F.lit(" changed"),
    )
    return counts.withColumn("top", F.coalesce(leaders.scalar(), F.lit(""))).select(
        "n_new", "n_removed", "n_changed", "top",
        ((F.col("n_new") + F.col("n_removed") + F.col("n_changed")) == 0).alias("is_empty"),
        F.concat(
            head, F.when(F.col("top") != "", F.concat(F.lit("\nTop: "), F.col("top"))).otherwise("")
        ).alias("summary"),
    )


def apply_changes(base: DataFrame, events: DataFrame) -> DataFrame:
    """Tracked text fields of ``base`` after replaying a change log over it.

    Used to check a diff: applying diff(a, b) to a gives b on the tracked fields.
    """
    base = one_per_id(base, [c for c in base.columns if c != "id"], sequence="ingest_seq")
    per_id = (
        events.filter(F.col("event") == "changed")
        .groupBy("id")
        .agg(F.map_from_entries(F.collect_list(F.struct("field", F.col("new")))).alias("m"))
    )
    kept = base.join(events.filter(F.col("event") == "removed").select("id"), "id", "left_anti")
    texts = [f for f in TRACKED if f != "salary"]
    changed = kept.join(per_id, "id", "left").select(
        "id",
        *[
            F.when(F.map_contains_key(F.col("m"), F.lit(f)), F.col("m")[f])
            .otherwise(F.col(f))
            .alias(f)
            for f in texts
        ],
    )
    added = events.filter(F.col("event") == "new").select(
        "id", *[F.col(f) if f in events.columns else F.lit(None).cast("string").alias(f) for f in texts]
    )
    return changed.unionByName(added)


def weekly_velocity(
    jobs: DataFrame, *, key: str = "company_slug", ts: str = "posted_at", period: str = "week"
) -> DataFrame:
    """Count per key and period, with the period before it of the same key.

    A period without rows counts 0: the one right before is looked at, not the last that
    had rows. The first period of a key has none before. Rows collapse to one per key and
    period before the window sees them.
    """
    counts = (
        jobs.filter(F.col(ts).isNotNull())
        .groupBy(key, F.date_trunc(period, F.col(ts)).cast("date").alias("period"))
        .agg(F.count("*").alias("n"))
    )
    return velocity(counts, key, period)


def velocity(counts: DataFrame, key: str, period: str = "week") -> DataFrame:
    """The same from counts ``(key, period, n)``."""
    w = Window.partitionBy(key).orderBy("period")
    before = F.date_sub("period", 1)
    right_before = F.lag("period").over(w) == F.date_trunc(period, before).cast("date")
    previous = F.when(right_before, F.lag("n").over(w)).when(F.lag("n").over(w).isNotNull(), 0)
    return counts.select(
        key, "period", "n", previous.alias("previous_n"), (F.col("n") - previous).alias("delta")
    )
