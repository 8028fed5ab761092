"""Publications in two phases: tables are written aside and verified, then one marker switches to all of them.

A table's rows of a batch lie in `<root>/<dataset>/batch_id=<batch>/version=<version>`, a folder that is written once. A marker,
`<root>/_published/<batch>/<number>.json`, names the version of every table of the batch; it appears whole or not at all and never over
another (create-if-absent). The marker with the largest number holds; readers find their folders through it, so they see all of a
publication or nothing of it, and a failure before the marker leaves the state before. Rows are counted while they are written.

Create-if-absent is a hard link on a local file system and a rename without overwriting elsewhere, which HDFS does atomically. A
store whose rename is not atomic needs a file system client with conditional writes.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tallymart.tables import remove

#: A line of a marker: one for each dataset of the batch.
MARKER = "batch_id string, number int, dataset string, version string, n_rows long, totals map<string,string>, fields string, fingerprint string, published_at timestamp"
EVENT = "batch_id string, attempt_id string, event string, recorded_at timestamp, detail string"


class NotVerified(ValueError):
    """What was staged is not what was asked for."""


class Conflict(ValueError):
    """Another publication of the batch came first."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, the path in its form)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(Name, time of the last change in milliseconds) of what is in a folder; none if there is no such folder."""
    fs, at = file_system(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(at)] if fs.exists(at) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one: then False, and that one stays."""
    fs, at = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(aside.toUri().getPath(), at.toUri().getPath())
            except FileExistsError:
                return False
            return True
        try:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(aside), fs.makeQualified(at), options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True
    finally:
        fs.delete(aside, False)


# Staging.


def escaped(value: str) -> str:
    """A value as a folder's name; Spark reads such escapes of ASCII characters back."""
    return "".join(c if c.isalnum() or c in "-_." or ord(c) > 127 else f"%{ord(c):02X}" for c in value)


def folder(root: str, dataset: str, batch_id: str, version: str) -> str:
    return f"{root}/{dataset}/batch_id={escaped(batch_id)}/version={version}"


def write_counted(df: DataFrame, path: str, totals: Sequence[str] = ()) -> tuple[int, dict[str, str]]:
    """(Rows, sums as text) of df, taken by the tasks that write it: one job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).cast("string").alias(f"total_{i}") for i, c in enumerate(totals)]).write.parquet(path)
    got = seen.get
    return got["n_rows"], {c: got[f"total_{i}"] for i, c in enumerate(totals)}


def staged(frames: Mapping[str, DataFrame], root: str, batch_id: str, version: str, totals: Mapping[str, Sequence[str]] | None = None) -> list[dict]:
    """Every table written under its batch and version; a marker line for each."""
    out = []
    for name, df in frames.items():
        n, sums = write_counted(df, folder(root, name, batch_id, version), (totals or {}).get(name, ()))
        out.append({"batch_id": batch_id, "dataset": name, "version": version, "n_rows": n, "totals": sums, "fields": df.schema.json()})
    return out


def verify_staged(spark: SparkSession, root: str, lines: Sequence[dict], expected: Mapping[str, int] | None = None) -> None:
    """Raises NotVerified unless each folder has as many rows as were counted while it was written, and as expected where that is said."""
    parts = [spark.read.schema(T.StructType.fromJson(json.loads(x["fields"]))).parquet(folder(root, x["dataset"], x["batch_id"], x["version"])).agg(F.lit(x["dataset"]).alias("dataset"), F.count("*").alias("n")) for x in lines]
    found = {r.dataset: r.n for r in reduce(DataFrame.unionByName, parts).collect()} if parts else {}
    wrong = [(x["dataset"], found[x["dataset"]], x["n_rows"]) for x in lines if found[x["dataset"]] != x["n_rows"]]
    wrong += [(n, found.get(n), want) for n, want in (expected or {}).items() if found.get(n) != want]
    if wrong:
        raise NotVerified(f"rows staged, and as they should be: {wrong}")


def drop_version(spark: SparkSession, root: str, datasets: Sequence[str], batch_id: str, version: str) -> None:
    for name in datasets:
        remove(spark, folder(root, name, batch_id, version))


# Markers.


def numbers(spark: SparkSession, root: str, batch_id: str) -> list[int]:
    """Numbers of a batch's markers, ascending."""
    found = children(spark, f"{root}/_published/{escaped(batch_id)}")
    return sorted(int(n.removesuffix(".json")) for n, _ in found if n.endswith(".json") and not n.startswith("."))


def switch(spark: SparkSession, root: str, batch_id: str, number: int, lines: Sequence[dict], at: str, fingerprint: str | None = None) -> bool:
    """Write the marker of that number. False if there is one: somebody else has published in between."""
    text = "\n".join(json.dumps(x | {"number": number, "fingerprint": fingerprint, "published_at": at}) for x in lines)
    return create_if_absent(spark, f"{root}/_published/{escaped(batch_id)}/{number:08d}.json", text)


def markers(spark: SparkSession, root: str) -> DataFrame:
    """All lines of all markers."""
    if not children(spark, f"{root}/_published"):
        return spark.createDataFrame([], MARKER)
    return spark.read.schema(MARKER).json(f"{root}/_published/*/*.json")


def published(spark: SparkSession, root: str) -> DataFrame:
    """The marker lines that hold: those of each batch's largest number."""
    lines = markers(spark, root)
    return lines.join(lines.groupBy("batch_id").agg(F.max("number").alias("number")), ["batch_id", "number"]).select(*[f.split()[0] for f in MARKER.split(", ")])


def read_published(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The rows of a table in all batches, as the markers that hold name them, with batch_id; a filter on it prunes folders.

    The columns are those of the batch published last; a batch that has not got one has null there.
    """
    rows = sorted(published(spark, root).filter(F.col("dataset") == dataset).select("batch_id", "version", "fields", "published_at").collect(), key=lambda r: (r.published_at, r.batch_id))
    if not rows:
        raise ValueError(f"{dataset} has not been published under {root}")
    schema = T.StructType.fromJson(json.loads(rows[-1].fields)).add("batch_id", "string").add("version", "string")
    paths = [folder(root, dataset, r.batch_id, r.version) for r in rows]
    return spark.read.schema(schema).option("basePath", f"{root}/{dataset}").parquet(*paths).drop("version")


def publish(frames: Mapping[str, DataFrame], root: str, batch_id: str, at: str | None = None, expected: Mapping[str, int] | None = None, totals: Mapping[str, Sequence[str]] | None = None, keep_old: bool = True) -> DataFrame:
    """Stage, verify and switch; the marker's lines. A batch may be published again; what fails before the marker leaves the state before.

    expected: rows that a table must have. totals: columns whose sums go to the marker. keep_old: leave the folders of the publication
    before for readers that are under way (remove_unnamed takes them later). Raises NotVerified, or Conflict where somebody else has
    published the batch meanwhile.
    """
    spark = next(iter(frames.values())).sparkSession
    before, version = numbers(spark, root, batch_id), uuid.uuid4().hex
    number = before[-1] + 1 if before else 0
    try:
        lines = staged(frames, root, batch_id, version, totals)
        verify_staged(spark, root, lines, expected)
        if not switch(spark, root, batch_id, number, lines, at or datetime.now().isoformat(sep=" ")):
            raise Conflict(f"{batch_id} has been published by another attempt")
    except Exception:
        drop_version(spark, root, list(frames), batch_id, version)
        raise
    if before and not keep_old:
        for old in markers(spark, root).filter((F.col("batch_id") == batch_id) & (F.col("number") < number)).select("dataset", "version").distinct().collect():
            remove(spark, folder(root, old.dataset, batch_id, old.version))
    return published(spark, root).filter(F.col("batch_id") == batch_id)


def remove_unnamed(spark: SparkSession, root: str, datasets: Sequence[str], before_ms: int) -> int:
    """Delete version folders that no marker that holds names and that were last changed before a time; how many.

    Folders of publications under way are younger than that, if the time is.
    """
    named = {(r.dataset, r.batch_id, r.version) for r in published(spark, root).select("dataset", "batch_id", "version").collect()}
    n = 0
    for dataset in datasets:
        for batch, _ in children(spark, f"{root}/{dataset}"):
            for version, changed in children(spark, f"{root}/{dataset}/{batch}"):
                key = (dataset, unquote(batch.removeprefix("batch_id=")), version.removeprefix("version="))
                if version.startswith("version=") and key not in named and changed < before_ms:
                    remove(spark, f"{root}/{dataset}/{batch}/{version}")
                    n += 1
    return n


# Registered publications: a batch once, by its fingerprint.


def record_event(spark: SparkSession, root: str, batch_id: str, attempt_id: str, event: str, at: str, detail: str | None = None) -> None:
    """Append to the event table: a file of its own for each event."""
    row = {"batch_id": batch_id, "attempt_id": attempt_id, "event": event, "recorded_at": at, "detail": detail}
    create_if_absent(spark, f"{root}/_events/{uuid.uuid4().hex}.json", json.dumps(row))


def events(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(EVENT).json(f"{root}/_events/*.json") if children(spark, f"{root}/_events") else spark.createDataFrame([], EVENT)


def registry(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, fingerprint, published_at: a row for each registered batch, from its first marker."""
    rows = markers(spark, root).filter("number = 0 AND fingerprint IS NOT NULL")
    return rows.groupBy("batch_id").agg(F.min("fingerprint").alias("fingerprint"), F.min("published_at").alias("published_at"))


def registered_as(spark: SparkSession, root: str, batch_id: str, fingerprint: str) -> str | None:
    """NO_OP if the batch is registered with this fingerprint, CONFLICT if with another, else None."""
    if not numbers(spark, root, batch_id):
        return None
    known = [r.fingerprint for r in registry(spark, root).filter(F.col("batch_id") == batch_id).collect()]
    return "NO_OP" if known == [fingerprint] else "CONFLICT"


def publish_once(frames: Mapping[str, DataFrame], root: str, batch_id: str, fingerprint: str, at: str, attempt_id: str, totals: Mapping[str, Sequence[str]] | None = None) -> str:
    """PUBLISHED, NO_OP or CONFLICT. The first marker of the batch is its entry in the registry, so registering and switching are one act.

    Of attempts side by side one creates the marker; the others find it: with the same fingerprint they have nothing to do, with
    another they are in conflict, and what they staged goes. Every attempt leaves its events; a failure leaves FAILED and is raised.
    """
    spark = next(iter(frames.values())).sparkSession
    note = lambda event, detail=None: record_event(spark, root, batch_id, attempt_id, event, at, detail)
    if decided := registered_as(spark, root, batch_id, fingerprint):
        note(decided)
        return decided
    note("STARTED")
    version = uuid.uuid4().hex
    try:
        lines = staged(frames, root, batch_id, version, totals)
        verify_staged(spark, root, lines)
        first = switch(spark, root, batch_id, 0, lines, at, fingerprint)
    except Exception as e:
        drop_version(spark, root, list(frames), batch_id, version)
        note("FAILED", type(e).__name__)
        raise
    if first:
        note("COMPLETED")
        return "PUBLISHED"
    drop_version(spark, root, list(frames), batch_id, version)
    decided = registered_as(spark, root, batch_id, fingerprint)
    note(decided)
    return decided


# Catalog tables over publications.


def register_published(spark: SparkSession, root: str, dataset: str, name: str) -> None:
    """An external table over a published dataset, partitioned by batch_id, each partition at the folder that its marker names.

    Called again it recovers: batches that are new come in, those published again move to their new folder, those gone go.
    """
    rows = {r.batch_id: r for r in published(spark, root).filter(F.col("dataset") == dataset).collect()}
    if not rows:
        raise ValueError(f"{dataset} has not been published under {root}")
    if not spark.catalog.tableExists(name):
        last = max(rows.values(), key=lambda r: (r.published_at, r.batch_id))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(last.fields)).fields)
        spark.sql(f"CREATE TABLE {name} ({fields}, batch_id STRING) USING parquet PARTITIONED BY (batch_id) LOCATION '{root}/{dataset}'")
    known = {unquote(r.partition.removeprefix("batch_id=")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    for batch in known - set(rows):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (batch_id = {text(batch)})")
    for batch, r in rows.items():
        part, place = f"PARTITION (batch_id = {text(batch)})", text(folder(root, dataset, batch, r.version))
        spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {place}" if batch in known else f"ALTER TABLE {name} ADD {part} LOCATION {place}")
    spark.catalog.refreshTable(name)


# Summaries.


def terminal_summary(spark: SparkSession, root: str, batch_id: str, identity: Mapping[str, object], outcome: str) -> dict:
    """What a publication has come to: prefixes, rows and totals of the tables, the batch's identity and its outcome. From the marker alone."""
    rows = published(spark, root).filter(F.col("batch_id") == batch_id).orderBy("dataset").collect()
    made = {r.dataset: {"prefix": folder(root, r.dataset, batch_id, r.version), "row_count": r.n_rows} for r in rows}
    sums = {r.dataset: r.totals for r in rows if r.totals}
    return {**identity, "batch_id": batch_id, "produced_datasets": made, "row_counts": {n: x["row_count"] for n, x in made.items()}, "totals": sums, "terminal_outcome": outcome, "publication_status": "COMPLETED" if rows else "MISSING"}
