"""Publication: summaries, reconciliation, upserts with stable surrogates, and decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.operators.marts import all_marts
from tallymart.operators.star import allocate_keys, representative


def counts_of(frames: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, n_rows: one job for all tables."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("dataset"), F.count("*").alias("n_rows")) for n, df in frames.items()])


def batch_summary(stages: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """dataset and a count column for each stage, 0 where a stage has no such dataset."""
    parts = [counts_of(frames).withColumn("stage", F.lit(stage)) for stage, frames in stages.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("dataset").pivot("stage", list(stages)).agg(F.first("n_rows")).fillna(0)


def verify_summary(declared: DataFrame, frames: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, declared, counted of every dataset that differs, on either side only included. declared: dataset, n_rows."""
    got = counts_of(frames).withColumnRenamed("n_rows", "counted")
    rows = declared.withColumnRenamed("n_rows", "declared").join(got, "dataset", "full")
    return rows.filter(~F.col("declared").eqNullSafe(F.col("counted")))


def verify_identity(declared: DataFrame, expected: Sequence[str], identity: Mapping[str, object]) -> DataFrame:
    """dataset, field, declared: what a summary declares otherwise than the batch's identity (batch, versions), and datasets too many or missing.

    declared: dataset and a column for each field of the identity. field is `dataset` where the set of datasets differs.
    """
    want = declared.sparkSession.createDataFrame([(n,) for n in expected], "dataset string")
    fields = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).cast("string").alias("declared"), F.lit(v).cast("string").alias("want")) for k, v in identity.items()])
    wrong = declared.select("dataset", F.explode(fields).alias("f")).filter(~F.col("f.declared").eqNullSafe(F.col("f.want"))).select("dataset", "f.field", "f.declared")
    sets = declared.select("dataset", F.lit("unexpected").alias("declared")).join(want, "dataset", "left_anti").unionByName(want.join(declared.select("dataset"), "dataset", "left_anti").withColumn("declared", F.lit("missing")))
    return wrong.unionByName(sets.select("dataset", F.lit("dataset").alias("field"), "declared"))


def diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of either side that the other has not as often; side says where from."""
    more = expected.exceptAll(actual.select(*expected.columns)).withColumn("side", F.lit("expected"))
    return more.unionByName(actual.select(*expected.columns).exceptAll(expected).withColumn("side", F.lit("actual")))


def sync_static(dimension: DataFrame, snapshot: DataFrame, key: str, surrogate: str) -> DataFrame:
    """The dimension with attributes taken from the snapshot where it has the key, unseen keys added with new surrogates, and no key lost."""
    attributes = [c for c in dimension.columns if c not in (key, surrogate)]
    fresh = snapshot.select(key, *[F.col(c).alias(f"_s_{c}") for c in attributes], F.lit(True).alias("_in"))
    both = dimension.join(fresh, key, "left")
    kept = both.select(*[F.when(F.col("_in"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c) for c in dimension.columns])
    new = snapshot.join(dimension.select(key), key, "left_anti").select(key, *attributes)
    return kept.unionByName(allocate_keys(new, dimension, key, surrogate).select(*dimension.columns))


def publish_snapshot(target: DataFrame, snapshot: DataFrame, key: str, surrogate: str) -> DataFrame:
    """The snapshot with the target's surrogate where the key is known and a new one where not; keys absent from it go."""
    old = target.select(key, surrogate)
    known = snapshot.join(old, key)
    new = snapshot.join(old.select(key), key, "left_anti")
    return known.unionByName(allocate_keys(new, target, key, surrogate))


def publication_decision(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """batch_id, decision. registry and requests: batch_id, fingerprint. No entry: PUBLISH; the same fingerprint: NO_OP; another: CONFLICT; several: ERROR."""
    seen = registry.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("fingerprint").alias("old"))
    rows = requests.join(seen, "batch_id", "left")
    decision = F.when(F.col("n").isNull(), "PUBLISH").when(F.col("n") > 1, "ERROR").when(F.col("old") == F.col("fingerprint"), "NO_OP").otherwise("CONFLICT")
    return rows.select("batch_id", decision.alias("decision"))


def publication_events(decisions: DataFrame, at: str) -> DataFrame:
    """batch_id, event, recorded_at: rows to append to the event table."""
    events = F.when(F.col("decision") == "PUBLISH", F.array(F.lit("STARTED"), F.lit("COMPLETED"))).when(F.col("decision") == "NO_OP", F.array(F.lit("NO_OP"))).when(F.col("decision") == "CONFLICT", F.array(F.lit("CONFLICT")))
    return decisions.select("batch_id", F.explode(F.coalesce(events, F.array(F.lit("FAILED")))).alias("event"), F.lit(at).cast("timestamp").alias("recorded_at"))


def registry_rows(requests: DataFrame, decisions: DataFrame, at: str) -> DataFrame:
    """batch_id, fingerprint, published_at of the requests (batch_id, fingerprint) that are to be published: rows to append to the registry."""
    return requests.join(decisions.filter("decision = 'PUBLISH'").select("batch_id"), "batch_id").select("batch_id", "fingerprint", F.lit(at).cast("timestamp").alias("published_at"))


def current_snapshot(registry: DataFrame) -> DataFrame:
    """One row: the batch last published, by time and then by name; none for an empty registry."""
    last = registry.agg(F.max(F.struct("published_at", "batch_id", "fingerprint")).alias("r")).filter("r IS NOT NULL")
    return last.select("r.batch_id", "r.fingerprint", "r.published_at")


def verify_registry(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """batch_id, issue of requests (batch_id, fingerprint) that the registry does not have once and with that fingerprint."""
    seen = registry.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("fingerprint").alias("old"))
    rows = requests.join(seen, "batch_id", "left")
    issue = F.when(F.col("n").isNull(), "unregistered").when(F.col("n") > 1, "registered_twice").when(~F.col("old").eqNullSafe(F.col("fingerprint")), "other_fingerprint")
    return rows.select("batch_id", issue.alias("issue")).filter("issue IS NOT NULL")


def verify_publication(registry: DataFrame, request: DataFrame, expected: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """subject, issue: what the registry has otherwise (subject is the batch), then every table that is not published as expected."""
    tables = verify_published(expected, target).select(F.col("dataset").alias("subject"), F.concat(F.col("differing_rows").cast("string"), F.lit(" rows differ")).alias("issue"))
    return verify_registry(registry, request).select(F.col("batch_id").alias("subject"), "issue").unionByName(tables)


def verify_published(expected: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, differing_rows of every table that is not published as expected."""
    parts = [diff(df, target[n]).agg(F.lit(n).alias("dataset"), F.count("*").alias("differing_rows")) for n, df in expected.items()]
    return reduce(DataFrame.unionByName, parts).filter("differing_rows > 0")


def verify_marts(enriched: DataFrame, sales: DataFrame, published: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, differing_rows of every mart that is not what the facts give; all eight are built again."""
    return verify_published(all_marts(enriched, sales), published)


def existence(frames: Mapping[str, DataFrame]) -> DataFrame:
    """probe, has_rows: whether each frame has a row. No task reads on after its first one."""
    parts = [df.select(F.lit(1)).limit(1).agg(F.lit(n).alias("probe"), (F.count("*") > 0).alias("has_rows")) for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def verify_representative(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders of the fact whose payment type is not the first payment's."""
    first = representative(payments.select("order_id", "payment_sequential", "payment_type"), ["order_id"], ["payment_sequential", "payment_type"])
    rows = fact.select("OrderID", "PaymentType").distinct().join(first.select(F.col("order_id").alias("OrderID"), F.col("payment_type").alias("expected")), "OrderID", "left")
    return rows.filter(~F.col("PaymentType").eqNullSafe(F.col("expected")))


def stage_completeness(staged: DataFrame, expected: Sequence[str], attempt_id: str, batch_id: str) -> DataFrame:
    """issue, dataset. staged: dataset, attempt_id, batch_id, ordinal of every staged row."""
    spark = staged.sparkSession
    want = spark.createDataFrame([(n,) for n in expected], "dataset string")
    own = staged.filter((F.col("attempt_id") == attempt_id) & (F.col("batch_id") == batch_id))
    issue = lambda df, name: df.select(F.lit(name).alias("issue"), "dataset")
    return reduce(DataFrame.unionByName, [
        issue(want.join(own.select("dataset").distinct(), "dataset", "left_anti"), "missing"),
        issue(own.select("dataset").distinct().join(want, "dataset", "left_anti"), "unexpected"),
        issue(own.groupBy("dataset", "ordinal").agg(F.count("*").alias("n")).filter("n > 1").select("dataset").distinct(), "duplicate_ordinal"),
        issue(staged.filter(~((F.col("attempt_id") == attempt_id) & (F.col("batch_id") == batch_id))).select("dataset").distinct(), "foreign_identity"),
    ])


def load_columns(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in that order, as a load into a table takes them."""
    return source.select(*columns)


def order_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.orderBy(*columns)
