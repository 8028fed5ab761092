"""What the text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallymart.tables import known_to_workers, new_path, release, scratch, unused, written

__all__ = ["SPACE", "WORD", "by_run", "known_to_workers", "new_path", "release", "scratch", "unused", "written"]

#: Words as every operator here takes them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def by_run(rows: DataFrame, keys: list[str], answers: DataFrame, how: str = "inner") -> DataFrame:
    """rows (with `run`, the partition they were written in) joined to answers, a row for each value of keys.

    The answers go to a row for each run and value first and from there to the run's own rows, so that a value with very many
    rows is spread over the runs.
    """
    known = rows.select("run", *keys).distinct().join(answers, keys)
    return rows.join(known, ["run", *keys], how)
