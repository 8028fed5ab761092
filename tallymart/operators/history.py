"""Dimension history: versions with half-open validity, and facts resolved at event time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymart.tables import written

#: Where the first version of a key starts, and where an open one ends for comparisons.
BEGINNING, FOREVER = "1900-01-01 00:00:00", "9999-12-31 00:00:00"


def covers(event: Column, start: str = "effective", end: str = "expiration") -> Column:
    """start <= event < end, an open end being forever."""
    return (event >= F.col(start)) & (event < F.coalesce(F.col(end), F.lit(FOREVER).cast("timestamp")))


def intervals(versions: DataFrame, keys: Sequence[str], effective: str = "effective") -> DataFrame:
    """versions with expiration (the next version's start) and is_current recomputed."""
    nxt = F.lead(effective).over(Window.partitionBy(*keys).orderBy(effective))
    return versions.withColumn("expiration", nxt).withColumn("is_current", F.col("expiration").isNull())


def interval_join(fact: DataFrame, history: DataFrame, keys: Sequence[str], event: str, start: str = "effective", end: str = "expiration", how: str = "inner") -> DataFrame:
    """Rows of fact with the version valid at the event. An equi join on the key; the interval is a residual test."""
    versions = history.select(*[F.col(c).alias(f"_h_{c}") if c in keys or c in fact.columns else F.col(c) for c in history.columns])
    on = covers(F.col(event), f"_h_{start}" if f"_h_{start}" in versions.columns else start, f"_h_{end}" if f"_h_{end}" in versions.columns else end)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_h_{k}"))
    return fact.join(versions, on, how).drop(*[c for c in versions.columns if c.startswith("_h_")])


#: A key with at least this share of the rows is hot: there are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 0.01
#: Time buckets of a hot key, and parts that the rows of a bucket are spread over.
BUCKETS, PARTS = 32, 4


def hot_keys(fact: DataFrame, keys: Sequence[str], event: str, n: int | None = None) -> DataFrame | None:
    """keys and bounds (ascending event times that cut the key's rows into about equal parts) of the hot keys; None if there is none.

    At most 1 / HOT_SHARE rows. Null keys are not hot, as they match nothing. n: the number of rows, if it is known.
    """
    n = fact.count() if n is None else n
    many = fact.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= max(n * HOT_SHARE, 2)).dropna(subset=list(keys)).select(*keys)
    found = many.collect()
    if not found:
        return None
    hot = fact.sparkSession.createDataFrame(found, many.schema)
    cuts = [F.lit(i / BUCKETS) for i in range(1, BUCKETS)]
    bounds = F.array_distinct(F.percentile_approx(F.unix_micros(F.col(event).cast("timestamp")), F.array(*cuts)))
    return written(fact.join(F.broadcast(hot), list(keys)).groupBy(*keys).agg(bounds.alias("bounds")), "hot-keys")


def interval_join_spread(fact: DataFrame, history: DataFrame, keys: Sequence[str], event: str, start: str = "effective", end: str = "expiration", how: str = "inner", base: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """interval_join for keys that may hold a large share of the rows.

    The rows of a hot key are cut by time into buckets and each bucket into parts by where the rows were read; a version of it goes to
    every bucket that it spans and every part, so the key is spread over tasks. Other keys and their versions are in one bucket. Rows with
    a null key match nothing and are spread too. how: inner or left. base: a table with the keys and events of the fact, if the fact itself
    is costly: hot keys are counted there. n: its number of rows, if it is known.
    """
    hot = hot_keys((fact if base is None else base).select(*keys, event), keys, event, n)
    if hot is None:
        return interval_join(fact, history, keys, event, start, end, how)

    def bucket(at: Column) -> Column:
        return F.size(F.filter("_bounds", lambda b: b <= F.unix_micros(at.cast("timestamp"))))

    named = F.broadcast(hot.select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)], F.col("bounds").alias("_bounds")))  # at most 1 / HOT_SHARE rows
    same = [F.col(k) == F.col(f"_hot{i}") for i, k in enumerate(keys)]
    lost = F.col(event).isNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    of_fact = F.when(lost, -1 - F.pmod(F.spark_partition_id(), F.lit(BUCKETS * PARTS))).when(F.col("_bounds").isNull(), F.lit(0)).otherwise(1 + bucket(F.col(event)) * PARTS + part)
    rows = fact.join(named, same, "left").withColumn("_bucket", of_fact).select(*fact.columns, "_bucket")
    last = F.coalesce(F.col(end), F.lit(FOREVER).cast("timestamp"))
    spans = F.transform(F.sequence(bucket(F.col(start)) * PARTS, bucket(last) * PARTS + (PARTS - 1)), lambda x: x + 1)
    versions = history.join(named, same, "left").withColumn("_bucket", F.explode(F.when(F.col("_bounds").isNull() | ~(F.col(start) <= last), F.array(F.lit(0))).otherwise(spans))).select(*history.columns, "_bucket")
    return interval_join(rows, versions, [*keys, "_bucket"], event, start, end, how).drop("_bucket")


def as_of_versions(fact: DataFrame, history: DataFrame, key: str, event: str, value: str, start: str = "effective") -> DataFrame:
    """The same lookup for one value as a sweep: history and facts of a key in time order, the last version carried on. For keys with very many versions."""
    rows = fact.withColumn("_at", F.col(event)).withColumn("_kind", F.lit(1)).withColumn("_value", F.lit(None).cast(history.schema[value].dataType))
    marks = history.select(F.col(key), F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(value).alias("_value"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    carried = F.last("_value", ignorenulls=True).over(Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(value, carried).filter("_kind = 1").select(*fact.columns, value)


def scd2_backfill(snapshots: DataFrame, keys: Sequence[str], effective: str, hash_col: str) -> DataFrame:
    """History from many snapshots in time order at once: rows whose hash differs from the one before, the first from the beginning."""
    w = Window.partitionBy(*keys).orderBy(effective)
    changed = snapshots.withColumn("_before", F.lag(hash_col).over(w)).withColumn("_n", F.row_number().over(w))
    kept = changed.filter(F.col("_before").isNull() | (F.col("_before") != F.col(hash_col)))
    start = F.when(F.col("_n") == 1, F.lit(BEGINNING).cast("timestamp")).otherwise(F.col(effective))
    return intervals(kept.withColumn("effective", start).drop("_before", "_n", *([effective] if effective != "effective" else [])), keys)


def scd2_opened(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], hash_col: str, effective: str) -> DataFrame:
    """The versions (keys, attributes, hash_col, effective) that a batch opens, see scd2_apply."""
    columns = [c for c in history.columns if c not in ("effective", "expiration", "is_current")]
    rows = snapshot.withColumn("_effective", F.col(effective))
    marks = history.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(hash_col).alias("_hash"), F.col("effective").alias("_start"), F.col("expiration").alias("_end"))
    on = covers(F.col("_effective"), "_start", "_end")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k{i}"))
    known = history.groupBy(*keys).agg(F.lit(True).alias("_known"))
    joined = rows.join(marks, on, "left").join(known, list(keys), "left")
    new = joined.filter(F.col("_hash").isNull() | (F.col("_hash") != F.col(hash_col)))
    start = F.when(F.col("_known").isNull(), F.lit(BEGINNING).cast("timestamp")).otherwise(F.col("_effective"))
    return new.withColumn("effective", start).select(*columns, "effective")


def scd2_apply(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], hash_col: str, effective: str) -> DataFrame:
    """History after one batch.

    history: keys, attributes, hash_col, effective, expiration, is_current; snapshot: keys, attributes, hash_col, effective column.
    A row whose covering version has its hash changes nothing; any other opens a version, which ends where the next
    begins, also when it arrives late; a new key starts at the beginning; absent keys stay. All expirations of
    the table follow from the starts, so nothing is updated in place.
    """
    opened = scd2_opened(history, snapshot, keys, hash_col, effective)
    return intervals(history.select(*opened.columns).unionByName(opened), keys)


def scd2_conflicts(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], hash_col: str, effective: str) -> DataFrame:
    """keys, reason: a key twice in the snapshot, or a version with the same start and another hash."""
    twice = snapshot.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys, F.lit("duplicate_key").alias("reason"))
    old = history.select(*keys, F.col("effective").alias("_start"), F.col(hash_col).alias("_hash"))
    clash = snapshot.join(old, list(keys)).filter((F.col(effective) == F.col("_start")) & (F.col(hash_col) != F.col("_hash")))
    return twice.unionByName(clash.select(*keys, F.lit("same_time_other_content").alias("reason")).distinct())


def overlaps(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that begin before an earlier one of their key has ended; a window, not a self join."""
    before = Window.partitionBy(*keys).orderBy("effective").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.max(F.coalesce("expiration", F.lit(FOREVER).cast("timestamp"))).over(before)
    return history.withColumn("_ended", ended).filter(F.col("_ended") > F.col("effective")).drop("_ended")


def scd2_integrity(history: DataFrame, keys: Sequence[str], surrogate: str) -> DataFrame:
    """issue, n: overlapping versions, repeated surrogates, keys with several current rows. Rows with n = 0 are left out."""
    parts = [
        overlaps(history, keys).agg(F.lit("overlap").alias("issue"), F.count("*").alias("n")),
        history.groupBy(surrogate).agg(F.count("*").alias("c")).filter("c > 1").agg(F.lit("duplicate_surrogate").alias("issue"), F.count("*").alias("n")),
        history.filter("is_current").groupBy(*keys).agg(F.count("*").alias("c")).filter("c > 1").agg(F.lit("several_current").alias("issue"), F.count("*").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("n > 0")


def resolve_event_time(fact: DataFrame, history: DataFrame, grain: Sequence[str], keys: Sequence[str], event: str, surrogate: str) -> tuple[DataFrame, DataFrame]:
    """(fact with the surrogate valid at the event, grain and matches of the rows that do not have exactly one)."""
    joined = interval_join(fact, history.select(*keys, "effective", "expiration", surrogate), keys, event, how="left")
    counted = joined.groupBy(*grain).agg(F.count(surrogate).alias("matches"), F.count("*").alias("rows")).filter("matches <> 1 OR rows <> 1").select(*grain, "matches")
    return joined, counted


@dataclass(frozen=True)
class Role:
    """How a fact finds one of its dimensions.

    column: the name that the surrogate gets in the fact. dimension: the history or static table. on: columns of the fact, or carried by
    roles before, to columns of the dimension. surrogate: the dimension's. carried: its columns that later roles look up by, to names. timed:
    whether the version at the event is meant; a static dimension has no versions.
    """

    column: str
    dimension: str
    on: Mapping[str, str]
    surrogate: str
    carried: Mapping[str, str] = field(default_factory=dict)
    timed: bool = True


def resolve_roles(fact: DataFrame, dimensions: Mapping[str, DataFrame], roles: Sequence[Role], grain: Sequence[str], event: str) -> tuple[DataFrame, DataFrame]:
    """(fact with the surrogate of every role, what proves it wrong).

    The second frame has grain, n_rows, missing and ambiguous (names of roles) for every value of the grain that has not exactly one
    row with one match in each role; it is empty where the resolution is exact. All roles are joined in one chain, a role may
    look up by what one before has carried, and the joined rows are written once for both results. The fact is written first, as hot keys of
    every role are counted in it.
    """
    fact = rows = written(fact, "role-fact")
    n = fact.count()
    for r in roles:
        if r.timed and not set(r.on) <= set(fact.columns):
            rows = written(rows, "resolved")
        dimension = dimensions[r.dimension]
        names = {d: f for f, d in r.on.items()}
        picked = [F.col(d).alias(f) for d, f in names.items()] + [F.col(r.surrogate).alias(r.column)] + [F.col(c).alias(n) for c, n in r.carried.items()]
        if r.timed:
            rows = interval_join_spread(rows, dimension.select(*picked, F.col("effective").alias("_from"), F.col("expiration").alias("_to")), list(r.on), event, "_from", "_to", "left", *((fact, n) if set(r.on) <= set(fact.columns) else (rows, None))).drop("_from", "_to")
        else:
            rows = rows.join(dimension.select(*picked), list(r.on), "left")
    rows = written(rows, "resolved")
    missing = F.array_compact(F.array(*[F.when(F.count(r.column) < F.count("*"), F.lit(r.column)) for r in roles]))
    ambiguous = F.array_compact(F.array(*[F.when(F.min(r.column) != F.max(r.column), F.lit(r.column)) for r in roles]))
    proof = rows.groupBy(*grain).agg(F.count("*").alias("n_rows"), missing.alias("missing"), ambiguous.alias("ambiguous"))
    carried = [n for r in roles for n in r.carried.values()]
    return rows.select(*fact.columns, *[r.column for r in roles]).drop(*[c for c in carried if c not in fact.columns]), proof.filter("n_rows <> 1 OR size(missing) > 0 OR size(ambiguous) > 0")


def absent_from(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    return left.join(right, condition, "left_anti")
