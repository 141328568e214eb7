"""File stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """Watch a directory of CSV / JSON / parquet files as a stream.

    The schema is always explicit (no inference on a stream).
    """
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load(path)
