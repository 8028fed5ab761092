"""Row, key and reference quality: every rule is data, every check one pass or one join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.contracts import Contract
from tallymart.functions.parsing import RAW
from tallymart.tables import written

#: What each reason means and how severe it is.
REASONS = {
    "required_key_null": ("A required contracted field is null.", "reject-row"),
    "invalid_parse": ("A required value is blank or cannot be parsed as its contracted type.", "reject-row"),
    "invalid_monetary_value": ("A monetary value is negative.", "reject-row"),
    "invalid_review_score": ("The review score is outside the inclusive range 1 through 5.", "reject-row"),
    "impossible_timestamp": ("Timestamp ordering is chronologically impossible.", "reject-row"),
    "invalid_range": ("A numeric value is outside its valid range.", "reject-row"),
    "conflicting_business_key": ("More than one row has the contracted business key.", "reject-dataset"),
    "duplicate_fact_grain": ("More than one row has the contracted fact grain.", "reject-dataset"),
    "orphan_reference": ("A foreign-key value has no accepted parent row.", "reject-row"),
    "missing_dimension_lookup": ("a dimension key resolves to nothing", "reject-row"),
    "exact_duplicate": ("a row repeats another", "warning"),
    "missing_column": ("a header is not the contract's", "fail-batch"),
}
SEVERITIES = ["warning", "reject-row", "reject-dataset", "fail-batch"]
OUTCOMES = {"warning": "PASSED", "reject-row": "PASSED_WITH_REJECTIONS", "reject-dataset": "FAILED", "fail-batch": "FAILED"}


@dataclass(frozen=True)
class Rule:
    """A row is rejected where the condition is true; a condition that is null rejects nothing."""

    code: str
    condition: Column


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False))


def required(columns: Sequence[str]) -> Rule:
    return Rule("required_key_null", any_of([F.col(c).isNull() for c in columns]))


def unparsed(contract: Contract) -> Rule:
    """Text without a value, or a required value missing that is no key."""
    lost = [(F.trim(RAW + f.name) != "") & F.col(f.name).isNull() for f in contract.fields]
    missing = [F.col(f.name).isNull() for f in contract.fields if not f.nullable and f.name not in contract.key]
    return Rule("invalid_parse", any_of(lost + missing))


def not_negative(columns: Sequence[str], least: Mapping[str, int] | None = None) -> Rule:
    return Rule("invalid_monetary_value", any_of([F.col(c) < 0 for c in columns] + [F.col(c) < v for c, v in (least or {}).items()]))


def score_between(column: str, low: int = 1, high: int = 5) -> Rule:
    return Rule("invalid_review_score", ~F.col(column).between(low, high))


def in_order(pairs: Sequence[tuple[str, str]]) -> Rule:
    """For each (earlier, later)."""
    return Rule("impossible_timestamp", any_of([F.col(later) < F.col(earlier) for earlier, later in pairs]))


def in_range(bounds: Mapping[str, tuple[float | None, float | None]]) -> Rule:
    tests = [F.col(c) < low for c, (low, _) in bounds.items() if low is not None] + [F.col(c) > high for c, (_, high) in bounds.items() if high is not None]
    return Rule("invalid_range", any_of(tests))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with rejection_codes (sorted, distinct, together with any it has) and rejection_descriptions."""
    codes = F.array_compact(F.array(*[F.when(r.condition, F.lit(r.code)) for r in rules]))
    if "rejection_codes" in df.columns:
        codes = F.concat("rejection_codes", codes)
    text = F.create_map(*[F.lit(x) for code, (words, _) in REASONS.items() for x in (code, words)])
    out = df.withColumn("rejection_codes", F.array_sort(F.array_distinct(codes.cast("array<string>"))))
    return out.withColumn("rejection_descriptions", F.transform("rejection_codes", lambda c: F.try_element_at(text, c)))


def split_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid without the reason columns, rejected with them)."""
    return df.filter(F.size("rejection_codes") == 0).drop("rejection_codes", "rejection_descriptions"), df.filter(F.size("rejection_codes") > 0)


def reject_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    return split_rows(with_reasons(df, rules))


def row_signature(df: DataFrame) -> Column:
    """SHA-256 of the row as JSON, columns by name, nulls left out; by name, so it holds for any frame with these columns."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)


class ConflictingKeys(ValueError):
    """A deduplication key has rows that differ."""


def deduplicate(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """(A row for each key, the number of rows that went). Raises ConflictingKeys where rows of a key differ.

    Raw text columns take no part in the comparison; of equal rows with different raw text one stays. Null keys are
    equal. One aggregation, combined before the shuffle and written, gives the rows, the count and the conflicts.
    """
    content = [c for c in df.columns if not c.startswith(RAW)]
    signed = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], row_signature(df.select(*content)).alias("signature"), F.struct(*df.columns).alias("row"))
    of_key = [f"k{i}" for i in range(len(keys))]
    groups = signed.groupBy(*of_key).agg(F.min_by("row", "signature").alias("row"), F.min("signature").alias("least"), F.max("signature").alias("most"), F.count("*").alias("n"))
    groups = written(groups, "deduplicated")
    stats = groups.agg(F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("removed"), F.count_if(F.col("least") != F.col("most")).alias("conflicts")).first()
    if stats["conflicts"]:
        raise ConflictingKeys(f"{stats['conflicts']} values of {list(keys)} have rows that differ")
    return groups.select("row.*"), stats["removed"]


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key, chosen by signature."""
    signed = df.withColumn("_signature", row_signature(df))
    least = signed.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), "_signature").alias("_row"))
    return least.select("_row.*")


def duplicates_removed(df: DataFrame) -> DataFrame:
    """n_rows, n_distinct, n_removed."""
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return counts.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct")).withColumn("n_removed", F.col("n_rows") - F.col("n_distinct"))


def conflicting_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one different row, and how many."""
    return df.dropDuplicates().groupBy(*keys).agg(F.count("*").alias("n_versions")).filter("n_versions > 1")


def grain_violations(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    return df.groupBy(*grain).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


#: Parts that rows with a repeated key are spread over.
SPREAD = 16


def flag_duplicate_keys(df: DataFrame, keys: Sequence[str], code: str = "conflicting_business_key", among: Column | None = None) -> DataFrame:
    """Every row of a repeated key gets the code. Null keys are equal. among: only rows where it is true count and are flagged.

    Keys are counted with partial sums; what is joined back is the repeated keys alone, once for each part of the rows that the
    partitions read make, so that a key (or null) with very many rows is no task of its own.
    """
    among = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    repeated = df.filter(among).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_n")).filter("_n > 1")
    repeated = repeated.drop("_n").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_of") == F.col("_part"))
    marked = df.withColumn("_of", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).join(repeated, on, "left")
    flagged = with_reasons(marked, [Rule(code, F.col("_part").isNotNull() & among)])
    return flagged.select(*[c for c in df.columns if c not in ("rejection_codes", "rejection_descriptions")], "rejection_codes", "rejection_descriptions")


def drop_repeated_accepted(flagged: DataFrame) -> DataFrame:
    """Of accepted rows with the same typed columns one stays; rejected rows stay as often as they stand. copies: how many a row stands for.

    Raw text takes no part in the comparison; of equal rows that with the smallest columns stays. One shuffle by content.
    """
    content = [c for c in flagged.columns if not c.startswith(RAW) and c not in ("rejection_codes", "rejection_descriptions")]
    alone = F.when(F.size("rejection_codes") > 0, F.monotonically_increasing_id())
    signed = flagged.select(row_signature(flagged.select(*content)).alias("_signature"), alone.alias("_alone"), F.struct(*flagged.columns).alias("_row"))
    rows = signed.groupBy("_signature", "_alone").agg(F.min("_row").alias("_row"), F.count("*").alias("copies"))
    return rows.select("_row.*", "copies")


def three_way_counts(flagged: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, rejected_rows, processed_rows, duplicate_rows of frames with copies: one job."""
    bad = F.size("rejection_codes") > 0
    parts = [df.agg(F.lit(n).alias("dataset"), F.count_if(bad).alias("rejected_rows"), F.count_if(~bad).alias("processed_rows"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows")) for n, df in flagged.items()]
    return reduce(DataFrame.unionByName, parts)


def flag_orphans(child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str], code: str = "orphan_reference") -> DataFrame:
    """Rows without an accepted parent, or with a null reference, get the code."""
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_key)], F.lit(True).alias("_known")).distinct()
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(child_key)])
    joined = child.join(keys, on, "left")
    return with_reasons(joined, [Rule(code, F.col("_known").isNull())]).select(*[c for c in child.columns if c not in ("rejection_codes", "rejection_descriptions")], "rejection_codes", "rejection_descriptions")


def reject_orphans(child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return split_rows(flag_orphans(child, parent, child_key, parent_key))


@dataclass(frozen=True)
class Reference:
    child: str
    child_key: tuple[str, ...]
    parent: str
    parent_key: tuple[str, ...]


def cascade_references(frames: Mapping[str, DataFrame], references: Sequence[Reference]) -> dict[str, DataFrame]:
    """All frames with reasons; parents are settled before their children, so a rejected parent makes orphans.

    What is settled is written, so that neither the children nor later counts work it out again.
    """
    order = TopologicalSorter({name: {x.parent for x in references if x.child == name} for name in frames})
    out = {name: df if "rejection_codes" in df.columns else with_reasons(df, []) for name, df in frames.items()}
    for name in order.static_order():
        for r in references:
            if r.child == name:
                out[name] = flag_orphans(out[name], out[r.parent].filter(F.size("rejection_codes") == 0), r.child_key, r.parent_key)
        out[name] = written(out[name], "cascade")
    return out


def missing_dimension_lookup(fact: DataFrame, dimension: DataFrame, fact_key: Sequence[str], dimension_key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): fact rows whose dimension key resolves to nothing are rejected rows."""
    return split_rows(flag_orphans(fact, dimension, fact_key, dimension_key, "missing_dimension_lookup"))


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.select(F.explode("rejection_codes").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def summary_rows(name: str, flagged: DataFrame) -> DataFrame:
    """One pass: dataset, input_rows, valid_rows, rejected_rows and the worst severity met."""
    rank = F.create_map(*[F.lit(x) for code, (_, s) in REASONS.items() for x in (code, SEVERITIES.index(s))])
    worst = F.array_max(F.transform("rejection_codes", lambda c: F.try_element_at(rank, c)))
    bad = F.size("rejection_codes") > 0
    return flagged.agg(F.lit(name).alias("dataset"), F.count("*").alias("input_rows"), F.count_if(~bad).alias("valid_rows"), F.count_if(bad).alias("rejected_rows"), F.coalesce(F.max(worst), F.lit(-1)).alias("worst"))


def quality_summary(flagged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each dataset and its outcome."""
    rows = reduce(DataFrame.unionByName, [summary_rows(n, df) for n, df in flagged.items()])
    outcome = F.when(F.col("worst") < 1, "PASSED")
    for i, s in enumerate(SEVERITIES):
        outcome = outcome.when(F.col("worst") == i, OUTCOMES[s])
    return rows.withColumn("outcome", outcome).drop("worst")


def severity_counts(flagged: Mapping[str, DataFrame]) -> DataFrame:
    """severity, n: rejected rows for row rules; for dataset rules a dataset counts once."""
    table = next(iter(flagged.values())).sparkSession.createDataFrame([(c, s) for c, (_, s) in REASONS.items()], "reason string, severity string")
    reasons = reduce(DataFrame.unionByName, [reason_counts(df).withColumn("dataset", F.lit(n)) for n, df in flagged.items()])
    each = reasons.join(F.broadcast(table), "reason").groupBy("severity", "dataset").agg(F.sum("n_rows").alias("n"))  # the table has a row for each reason code
    whole = F.when(F.col("severity").isin("reject-dataset", "fail-batch"), F.lit(1)).otherwise(F.col("n"))
    return each.groupBy("severity").agg(F.sum(whole).alias("n"))


def reconcile_counts(counts: DataFrame) -> DataFrame:
    """Datasets whose source rows are not rejected + processed + exact duplicates."""
    return counts.filter(F.col("source_rows") != F.col("rejected_rows") + F.col("processed_rows") + F.col("duplicate_rows"))


def violations(flagged: Mapping[str, DataFrame], row_key: Mapping[str, Sequence[str]]) -> DataFrame:
    """dataset, row_id, rule, severity for every reason of every row; row_id is the dataset's own key as text."""
    severity = F.create_map(*[F.lit(x) for code, (_, s) in REASONS.items() for x in (code, s)])
    parts = []
    for name, df in flagged.items():
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_key[name]])
        rows = df.filter(F.size("rejection_codes") > 0).select(F.lit(name).alias("dataset"), row.alias("row_id"), F.explode("rejection_codes").alias("rule"))
        parts.append(rows.withColumn("severity", F.try_element_at(severity, F.col("rule"))))
    return reduce(DataFrame.unionByName, parts)


def overall_status(found: DataFrame) -> DataFrame:
    """status of a batch by the worst violation; one row."""
    worst = F.max(F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity")))
    names = ["accepted", "accepted-with-warnings", "accepted-with-rejections", "reject-dataset", "fail-batch"]
    return found.agg(F.element_at(F.array(*[F.lit(n) for n in names]), (F.coalesce(worst, F.lit(0)) + 1).cast("int")).alias("status"))


def content_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with a missing required value or a RecordHash that is not 64 lower-case hex digits."""
    tests = [F.col(f.name).isNull() for f in contract.fields if not f.nullable]
    if "RecordHash" in df.columns:
        tests.append(~F.col("RecordHash").rlike("^[0-9a-f]{64}$"))
    return df.filter(any_of(tests))
