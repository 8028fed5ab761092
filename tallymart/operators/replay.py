"""Replay of batches as set-based decisions: what each manifest means given the audit of earlier submissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

IDENTITY = ["batch_timestamp", "source_file_id", "content_sha256"]
#: Decision: validator status, pipeline outcome, terminal status, retryable.
AUDIT = {
    "initial-load": ("accepted", "PASSED", "SUCCEEDED", False),
    "new-content": ("accepted", "PASSED", "SUCCEEDED", False),
    "late-content": ("accepted-with-warnings", "PASSED", "SUCCEEDED", False),
    "no-op": ("accepted", "PASSED", "SKIPPED", False),
    "retry": ("accepted", "PASSED", "SUCCEEDED", False),
    "reused-failure": ("reject-dataset", "FAILED", "FAILED", False),
    "fail-batch": ("fail-batch", "FAILED", "FAILED", False),
}


def latest_attempt(audit: DataFrame) -> DataFrame:
    """The row with the largest attempt of each dataset and batch; one reduction, no sort."""
    rest = [c for c in audit.columns if c not in ("dataset", "batch_id")]
    last = audit.groupBy("dataset", "batch_id").agg(F.max_by(F.struct(*rest), "attempt_number").alias("r"))
    return last.select("dataset", "batch_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def latest_match(audit: DataFrame) -> DataFrame:
    """dataset, content_sha256, submission_id of the last success with a content."""
    good = audit.filter("terminal_status = 'SUCCEEDED'")
    return good.groupBy("dataset", "content_sha256").agg(F.max_by("submission_id", F.struct("submitted_at", "submission_id")).alias("submission_id"))


def replay_decisions(manifests: DataFrame, audit: DataFrame) -> DataFrame:
    """manifests with decision, reason and reused_submission_id.

    manifests: batch_id, batch_timestamp, dataset, source_file_id, content_sha256. audit: those, attempt_number,
    submission_id, submitted_at, terminal_status, retryable, replay_outcome, reused_submission_id. Where both have
    max_event_timestamp, new content that is earlier than the greatest one loaded before is late-content.
    """
    names = ["batch_id", "batch_timestamp", "dataset", "source_file_id", "content_sha256"]
    same = audit.groupBy("dataset", "batch_id").agg(
        F.count("*").alias("n_attempts"), F.countDistinct("attempt_number").alias("n_different"), F.min("attempt_number").alias("least_attempt"), F.max("attempt_number").alias("last_attempt"),
        F.max_by(F.struct(*IDENTITY, "terminal_status", "retryable", "replay_outcome", "submission_id", "reused_submission_id"), "attempt_number").alias("last"),
    )
    matched = latest_match(audit).select("dataset", "content_sha256", F.col("submission_id").alias("matched_id"))
    timed = "max_event_timestamp" in manifests.columns and "max_event_timestamp" in audit.columns
    seen = F.max("max_event_timestamp" if timed else F.lit(None).cast("timestamp")).alias("seen")
    loaded = audit.filter("terminal_status = 'SUCCEEDED'").groupBy("dataset").agg(seen).withColumn("loaded", F.lit(True))
    rows = manifests.join(same, ["dataset", "batch_id"], "left").join(matched, ["dataset", "content_sha256"], "left").join(loaded, "dataset", "left")

    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    unnamed = blank(names[0])
    for c in names[1:]:
        unnamed = unnamed | blank(c)
    bad_hash = ~F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))
    repeated = F.col("n_attempts").isNotNull()
    moved = F.lit(False)
    for c in IDENTITY:
        moved = moved | ~F.col(c).cast("string").eqNullSafe(F.col(f"last.{c}").cast("string"))
    broken = (F.col("n_attempts") != F.col("n_different")) | (F.col("least_attempt") < 1) | F.col("least_attempt").isNull() | (F.col("last_attempt") != F.col("n_attempts"))
    done = (F.col("last.terminal_status") == "SUCCEEDED") | ((F.col("last.terminal_status") == "SKIPPED") & (F.col("last.replay_outcome") == "no-op"))
    steps: list[tuple[Column, str, str]] = [
        (unnamed, "fail-batch", "missing identity"), (bad_hash, "fail-batch", "invalid content hash"), (repeated & moved, "fail-batch", "identity changed"),
        (repeated & broken, "fail-batch", "invalid attempts"), (repeated & done, "no-op", "batch already done"),
        (repeated & (F.col("last.terminal_status") == "FAILED") & F.coalesce("last.retryable", F.lit(False)), "retry", "retryable failure"),
        (repeated & (F.col("last.terminal_status") == "FAILED"), "reused-failure", "final failure"), (repeated, "fail-batch", "unknown status"),
        (F.col("matched_id").isNotNull(), "no-op", "content already loaded"), (F.col("loaded").isNull(), "initial-load", "first load"),
        (F.col("max_event_timestamp") < F.col("seen") if timed else F.lit(False), "late-content", "earlier than what is loaded"),
    ]
    decision = reason = None
    for condition, what, why in steps:
        c = F.coalesce(condition, F.lit(False))
        decision = F.when(c, what) if decision is None else decision.when(c, what)
        reason = F.when(c, why) if reason is None else reason.when(c, why)
    out = rows.withColumns({"decision": decision.otherwise("new-content"), "reason": reason.otherwise("new content")})
    own = F.when(F.col("last.terminal_status") == "SKIPPED", F.col("last.reused_submission_id")).otherwise(F.col("last.submission_id"))
    reused = F.when((F.col("decision") == "no-op") & repeated, own).when(F.col("decision") == "no-op", F.col("matched_id")).when(F.col("decision") == "reused-failure", F.col("last.submission_id"))
    return out.withColumn("reused_submission_id", reused).select(*names, "decision", "reason", "reused_submission_id")


def late_content(manifests: DataFrame, history: DataFrame) -> DataFrame:
    """manifests (dataset, batch_id, max_event_timestamp) with is_late: earlier than the greatest successful one before."""
    before = history.groupBy("dataset").agg(F.max("max_event_timestamp").alias("_seen"))
    return manifests.join(before, "dataset", "left").withColumn("is_late", F.coalesce(F.col("max_event_timestamp") < F.col("_seen"), F.lit(False))).drop("_seen")


def abort_batch(decisions: DataFrame, final: Sequence[str] = ("no-op", "reused-failure", "fail-batch")) -> DataFrame:
    """A fail-batch turns the other decisions of its batch that are not final into fail-batch."""
    failed = F.max((F.col("decision") == "fail-batch").cast("int")).over(Window.partitionBy("batch_id"))
    return decisions.withColumn("decision", F.when((failed == 1) & ~F.col("decision").isin(*final), "fail-batch").otherwise(F.col("decision")))


def batch_timestamp_conflicts(manifests: DataFrame) -> DataFrame:
    return manifests.groupBy("batch_id").agg(F.countDistinct("batch_timestamp").alias("n_timestamps")).filter("n_timestamps > 1")


def manifest_set_check(manifests: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """batch_id and the datasets it lacks."""
    have = manifests.groupBy("batch_id").agg(F.collect_set("dataset").alias("have"))  # at most the contract's datasets a batch
    missing = F.array_except(F.array(*[F.lit(d) for d in datasets]), "have")
    return have.select("batch_id", F.explode(missing).alias("missing"))


def next_attempt(manifests: DataFrame, audit: DataFrame) -> DataFrame:
    last = audit.groupBy("dataset", "batch_id").agg(F.max("attempt_number").alias("_last"))
    return manifests.join(last, ["dataset", "batch_id"], "left").withColumn("next_attempt", (F.coalesce("_last", F.lit(0)) + 1).cast("int")).drop("_last")


def audit_records(decisions: DataFrame) -> DataFrame:
    """decisions with validator_status, pipeline_outcome, terminal_status and retryable."""
    out = {}
    for i, name in enumerate(("validator_status", "pipeline_outcome", "terminal_status", "retryable")):
        c = None
        for decision, values in AUDIT.items():
            hit = F.col("decision") == decision
            c = F.when(hit, F.lit(values[i])) if c is None else c.when(hit, F.lit(values[i]))
        out[name] = c
    return decisions.withColumns(out)


def audit_violations(audit: DataFrame) -> DataFrame:
    """dataset, batch_id, attempt_number, issue of rows that do not fit the rules of an audit."""
    w = Window.partitionBy("dataset", "batch_id")
    rows = audit.withColumns({"_least": F.min("attempt_number").over(w), "_same": F.count("*").over(Window.partitionBy("dataset", "batch_id", "attempt_number"))})
    other = audit.select(F.col("submission_id").alias("reused_submission_id"), F.col("submitted_at").alias("_then"), F.col("dataset").alias("_dataset"))
    rows = rows.join(other, "reused_submission_id", "left")
    tests = {
        "unknown_status": ~F.col("terminal_status").isin("SUCCEEDED", "SKIPPED", "FAILED"),
        "unknown_outcome": ~F.col("replay_outcome").isin(*[k for k in AUDIT]),
        "first_attempt_not_1": F.col("_least") != 1,
        "duplicate_attempt": F.col("_same") > 1,
        "reused_not_found": F.col("reused_submission_id").isNotNull() & F.col("_then").isNull(),
        "reused_not_earlier": F.col("_then") >= F.col("submitted_at"),
        "reused_other_dataset": F.col("_dataset") != F.col("dataset"),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in tests.items()]))
    return rows.select("dataset", "batch_id", "attempt_number", F.explode(found).alias("issue"))
