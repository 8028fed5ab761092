"""Reading: contract CSV, inferred CSV, layers, databases and inventories of files."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.contracts import Contract
from tallymart.sources.publication import file_system
from tallymart.tables import known_to_workers


class MissingColumn(ValueError):
    """A header is not the contract's ordered list of names."""


def read_contract_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Header CSV, every column text. A file's header line is held against the contract at once, those of a folder's other files when Spark reads them (enforceSchema)."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    want = [f.source_name for f in contract.fields]
    if header != want:
        raise MissingColumn(f"{contract.name}: header {header} instead of {want}")
    return spark.read.schema(contract.raw_schema()).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).csv(path)


def header_violations(spark: SparkSession, path: str, contract: Contract, suffix: str = "*") -> DataFrame:
    """path, reason (missing_column), header of the files of a folder whose first line is not the contract's ordered list of names.

    One distributed pass: the first line of a file is the first row of its first block. An empty file has no header; it is listed with null.
    """
    lines = spark.read.option("pathGlobFilter", suffix).text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    want = [f.source_name for f in contract.fields]
    names = F.transform(F.split(F.regexp_replace("header", "^\ufeff|\r$", ""), ","), lambda c: F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"))
    bad = first.filter(names != F.array(*[F.lit(n) for n in want])).select("path", "header")
    none = empty_files(spark, path, suffix).select("path", F.lit(None).cast("string").alias("header"))
    return bad.unionByName(none).select("path", F.lit("missing_column").alias("reason"), "header")


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with types found by a pass over the data: for exploring, not for production."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, options: dict[str, str], query: str, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """The query runs in the database; options: url, driver and what else the connection needs.

    split: a numeric or time column of the result, its bounds and the number of parts that are read side by side; otherwise one connection reads all.
    """
    reader = spark.read.format("jdbc").options(**options)
    if split is None:
        return reader.option("query", query).load()
    parts = dict(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), map(str, split), strict=True))
    return reader.options(**parts).option("dbtable", f"({query}) q").load()


def empty_files(spark: SparkSession, folder: str, suffix: str, recursive: bool = False) -> DataFrame:
    """path, length of the files without content: Spark's scans leave these out. The driver lists the folder, as it does for a scan."""
    fs, at = file_system(spark, folder)
    found, paths = fs.listFiles(at, recursive), []
    while found.hasNext():
        status = found.next()
        if not status.getLen() and fnmatch.fnmatchcase(status.getPath().getName(), suffix) and status.getPath().getName()[0] not in "._":
            paths.append((status.getPath().toString(), 0))
    return spark.createDataFrame(paths, "path string, length long")


def file_list(spark: SparkSession, folder: str, suffix: str = "*.csv") -> DataFrame:
    """path, name, length of files, empty ones too; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", True).load(folder)
    files = files.select("path", "length").unionByName(empty_files(spark, folder, suffix, True))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def source_inventory(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """name, status: accepted, missing, duplicate-name, case-ambiguous or unexpected."""
    want = spark.createDataFrame([(n, n.lower()) for n in expected], "wanted string, key string")
    found = file_list(spark, folder, "*").groupBy("name").agg(F.count("*").alias("n")).withColumn("key", F.lower("name"))
    ways = found.groupBy("key").agg(F.count("*").alias("ways"))
    rows = found.join(ways, "key").join(want, "key", "full")
    status = (
        F.when(F.col("name").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").when(F.col("ways") > 1, "case-ambiguous")
        .when(F.col("n") > 1, "duplicate-name").when(F.col("name") != F.col("wanted"), "case-ambiguous").otherwise("accepted")
    )
    return rows.select(F.coalesce("name", "wanted").alias("name"), status.alias("status"))


#: Largest file that is read as one value of a task, by Spark from any store it knows; larger ones are read in blocks by a Python worker.
WHOLE, BLOCK = 256 << 20, 8 << 20


def stream_of(path: str) -> BinaryIO:
    """A file opened for reading in blocks: of the local file system, or of a store that Arrow knows by the path's scheme."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    from pyarrow.fs import FileSystem

    store, name = FileSystem.from_uri(path)
    return store.open_input_stream(name)


def file_digests(spark: SparkSession, folder: str, suffix: str = "*.csv", whole: int = WHOLE) -> DataFrame:
    """path, length, digest (SHA-256 of the content, hex) of the files of a folder, of any size in bounded memory.

    Sizes are known before contents are read, so a large file is never a value of a row. A file is hashed by one task, as SHA-256 goes
    through it in order; files are spread over tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for path in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with stream_of(path) as file:
                    while block := file.read(BLOCK):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], names=["path", "length", "digest"])

    found = known_to_workers(spark).read.format("binaryFile").option("pathGlobFilter", suffix).load(folder)
    small = found.filter(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("digest"))
    large = found.filter(F.col("length") > whole).select("path", "length")
    none = empty_files(spark, folder, suffix).withColumn("digest", F.sha2(F.lit(b""), 256))
    return small.unionByName(none).unionByName(large.mapInArrow(run, "path string, length long, digest string"))


def file_manifests(spark: SparkSession, folder: str, batch_id: str, batch_timestamp: str, suffix: str = "*.csv") -> DataFrame:
    """A manifest row for each file, with the SHA-256 of its bytes and an address made from it."""
    files = file_digests(spark, folder, suffix)
    name, digest = F.element_at(F.split("path", "/"), -1), F.col("digest")
    dataset = F.regexp_replace(name, r"\.[^.]*$", "")
    return files.select(
        F.lit(batch_id).alias("batch_id"), F.lit(batch_timestamp).alias("batch_timestamp"), dataset.alias("dataset"), name.alias("source_file_id"), digest.alias("content_sha256"),
        F.col("length").alias("n_bytes"), F.concat_ws("/", dataset, F.concat(F.lit("sha256="), digest), name).alias("address"),
    )
