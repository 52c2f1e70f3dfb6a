"""Tables written once to the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitsync.session import work_dir


def unused(name: str, df: DataFrame) -> str:
    """``name``, or a longer one if ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it again.

    Cuts the lineage, and fixes what is not repeatable (row numbers): a lost executor
    reads the file again instead of computing it anew.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
