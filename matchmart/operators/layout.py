"""Physical layout of written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

#: upper bound on rows per output file
MAX_RECORDS_PER_FILE = 5_000_000

#: tables hold checksums, names and texts that this packs to half of what Parquet's default does
CODEC = "zstd"
#: folders a task writes side by side; with more it sorts the rest of its rows by folder
_OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FOLDERS = 64


def by_folder(frame: DataFrame, *folders: str) -> DataFrameWriter:
    """A writer into partition folders that are replaced.

    Spark sorts the rows of a task by folder before it writes them, which holds a
    whole task's rows in memory; a run has few folders, whose files are kept open instead.
    """
    spark = frame.sparkSession
    if spark.conf.get(_OPEN_FOLDERS) == "0":
        spark.conf.set(_OPEN_FOLDERS, str(OPEN_FOLDERS))
    return (
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*folders)
    )


def clustered(frame: DataFrame, folders: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """Bring the rows of a folder together and sort them.

    The rebalance hint lets adaptive execution merge small folders into one
    task and split a folder that holds most of the rows, by measured size and
    without a sampling pass.
    """
    return frame.hint("rebalance", *folders).sortWithinPartitions(*folders, *sort)


def file_count(frame: DataFrame, files: int = 0) -> DataFrame:
    """Cap the number of output files; 0 leaves them to adaptive execution."""
    return frame.coalesce(files) if files > 0 else frame
