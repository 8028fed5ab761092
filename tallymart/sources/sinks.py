"""Writing: layers, exports, databases, published batches and registered tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallymart.contracts import Contract
from tallymart.operators.identity import tracked_hash
from tallymart.sources.publication import publish


def write_layer(df: DataFrame, path: str) -> None:
    """Overwrite with as many files as the plan has partitions."""
    df.write.mode("overwrite").parquet(path)


def write_csv_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def connection(spark: SparkSession, options: Mapping[str, str]):
    """A JDBC connection of the driver, without auto-commit. options: url, driver, and properties such as user and password."""
    jvm = spark.sparkContext._jvm
    kind = jvm.java.lang.Class.forName(options["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    more = jvm.java.util.Properties()
    for k, v in options.items():
        if k not in ("url", "driver"):
            more.setProperty(k, v)
    got = kind.getDeclaredConstructor(spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)).newInstance(spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0)).connect(options["url"], more)
    got.setAutoCommit(False)
    return got


def executed(db, statements: Sequence[tuple[str, str]]) -> int:
    """Run statements, each with one text value that is bound and not part of the statement, as one transaction; rows that the last one changed."""
    n = 0
    try:
        for text, value in statements:
            statement = db.prepareStatement(text)
            statement.setString(1, value)
            n = statement.executeUpdate()
            statement.close()
        db.commit()
    except Exception:
        db.rollback()
        raise
    return n


#: Times that rows are staged before append_jdbc gives up.
TRIES = 3


class NotStaged(ValueError):
    """A staging table has not the rows that were written to it."""


def append_jdbc(df: DataFrame, options: dict[str, str], table: str, attempt_id: str, attempt_column: str = "ATTEMPT_ID") -> DataFrame:
    """Append with the attempt's tag, each row once, and what the table then has under that tag.

    Tasks write to `<table>_STAGING`; where a task was repeated after it had committed, the staged rows are more than were written, and they
    are staged again. Then one transaction takes away what the table has under the tag and copies the staged rows, so an attempt that is
    run again leaves the same rows, and readers of the table see all of it or nothing.
    """
    spark, staging = df.sparkSession, f"{table}_STAGING"
    writer = lambda rows, name: rows.write.format("jdbc").options(**options).option("dbtable", name).option("createTableColumnTypes", f"{attempt_column} VARCHAR(128)").mode("append").save()
    tagged = df.withColumn(attempt_column, F.lit(attempt_id))
    own = lambda name: spark.read.format("jdbc").options(**options).option("dbtable", name).load().filter(F.col(attempt_column) == attempt_id)
    for name in (table, staging):
        writer(tagged.limit(0), name)  # makes the table, if there is none
    columns = ", ".join(f'"{c}"' for c in tagged.columns)
    db = connection(spark, options)
    try:
        clear = (f'DELETE FROM {staging} WHERE "{attempt_column}" = ?', attempt_id)
        for _ in range(TRIES):
            executed(db, [clear])
            seen = Observation()
            writer(tagged.observe(seen, F.count(F.lit(1)).alias("n")), staging)
            if own(staging).count() == seen.get["n"]:
                break
        else:
            raise NotStaged(f"{staging} has not the rows of {attempt_id}")
        executed(db, [(f'DELETE FROM {table} WHERE "{attempt_column}" = ?', attempt_id), (f'INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} WHERE "{attempt_column}" = ?', attempt_id)])
        executed(db, [clear])
    finally:
        db.close()
    return own(table)


def publish_batch(frames: Mapping[str, DataFrame], root: str, batch_id: str) -> DataFrame:
    """Publish all tables of a batch or none (see publication.py); the marker (dataset, n_rows, batch_id).

    A repeated publication takes the place of the one before, whose folders are removed after the switch.
    """
    return publish(frames, root, batch_id, keep_old=False).select("dataset", "n_rows", "batch_id")


def register_tables(spark: SparkSession, contracts: Sequence[Contract], root: str) -> None:
    """An external Parquet table for each contract."""
    for c in contracts:
        spark.catalog.createTable(c.name, path=f"{root}/{c.name}", source="parquet", schema=c.schema())


def stage_for_history(df: DataFrame, contract: Contract, attempt_id: str, batch_id: str, effective: str) -> DataFrame:
    """The contract's columns with tracked hash, attempt, batch and effective time."""
    more = {"TrackedHash": tracked_hash(df, contract.tracked or contract.names), "AttemptID": F.lit(attempt_id), "BatchID": F.lit(batch_id), "EffectiveAt": F.lit(effective).cast("timestamp")}
    return df.withColumns(more).select(*contract.names, *more)
