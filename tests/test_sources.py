"""Contents of files of any size, headers of all files, appends to a database that may be repeated."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallymart.contracts import contract
from tallymart.operators import identity as I
from tallymart.sources import files, sinks


def test_files_of_any_size_are_hashed(spark, tmp_path):
    for name, text in {"a.csv": b"", "b.csv": b"x" * 5000, "c d.csv": b"y" * 100_000, "n.txt": b"z"}.items():
        (tmp_path / name).write_bytes(text)
    want = {name: hashlib.sha256((tmp_path / name).read_bytes()).hexdigest() for name in ("a.csv", "b.csv", "c d.csv")}
    for whole in (files.WHOLE, 4000, -1):
        got = files.file_digests(spark, str(tmp_path), whole=whole).collect()
        assert {r.path.rpartition("/")[2].replace("%20", " "): r.digest for r in got} == want and {r.length for r in got} == {0, 5000, 100_000}
    one = I.file_fingerprint(spark, str(tmp_path), "*.csv").first()
    assert (one.n_files, one.n_bytes) == (3, 105_000)


def test_a_file_of_three_gigabytes(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.touch()
    os.truncate(path, 3 << 30)
    digest, block = hashlib.sha256(), bytes(8 << 20)
    for _ in range(384):
        digest.update(block)
    got = files.file_manifests(spark, str(tmp_path), "b1", "2018-04-01 00:00:00").first()
    assert got.content_sha256 == digest.hexdigest() and got.n_bytes == 3 << 30 and got.address == f"large/sha256={digest.hexdigest()}/large.csv"


def test_headers_of_all_files(spark, tmp_path):
    c = contract("t", "a string, b_name>b integer", "a")
    for name, text in {"good.csv": "a,b_name\n1,2\n" + "x,9\n" * 9000, "quoted.csv": '"a","b_name"\n1,2\n', "dos.csv": "a,b_name\r\n1,2\r\n", "order.csv": "b_name,a\n1,2\n", "short.csv": "a\n1\n", "empty.csv": ""}.items():
        (tmp_path / name).write_text(text, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = {r.path.rpartition("/")[2]: (r.reason, r.header) for r in files.header_violations(spark, str(tmp_path), c).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"order.csv": ("missing_column", "b_name,a"), "short.csv": ("missing_column", "a"), "empty.csv": ("missing_column", None)}


def test_an_attempt_that_is_repeated_leaves_each_row_once(spark, monkeypatch):
    options = {"url": "jdbc:derby:memory:again;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(50).selectExpr("CAST(id AS INT) AS ID", "concat('n', id) AS NAME").repartition(4)
    count = lambda name: spark.read.format("jdbc").options(**options).option("dbtable", name).load().count()
    tag = "it's; DROP TABLE T"
    for _ in range(2):
        assert sinks.append_jdbc(df, options, "T", tag).count() == 50
    assert sinks.append_jdbc(df.limit(3), options, "T", "other").count() == 3
    assert (count("T"), count("T_STAGING")) == (53, 0)

    # Rows that a repeated task leaves: the first staging has some twice, the second has not.
    real, calls = sinks.executed, []

    def with_leftovers(db, statements):
        n = real(db, statements)
        calls.append(statements[0][0])
        if len(calls) == 1:
            df.limit(7).withColumn("ATTEMPT_ID", F.lit("late")).write.format("jdbc").options(**options).option("dbtable", "T_STAGING").mode("append").save()
        return n

    monkeypatch.setattr(sinks, "executed", with_leftovers)
    got = sinks.append_jdbc(df, options, "T", "late")
    assert got.count() == 50 and count("T_STAGING") == 0 and sum(c.startswith("DELETE FROM T_STAGING") for c in calls) == 3
    monkeypatch.setattr(sinks, "TRIES", 0)
    with pytest.raises(sinks.NotStaged):
        sinks.append_jdbc(df, options, "T", "never")
    assert count("T") == 103
