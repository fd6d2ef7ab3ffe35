"""Work tables: intermediate results written to the folder that all executors share, so that lineage is cut and a lost
executor costs only its running tasks. A ``WorkFolder`` belongs to its caller, who removes it when the run is over."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from .warehouse_store import remove_tree


class WorkFolder:
    """A new folder below ``spark.checkpoint.dir``. As a context manager it is removed at the end, also after an error."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/retailq-work/{label}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them back: one scan of the sources, whatever reads the table later."""
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove_tree(self.spark, self.path)

    def __enter__(self) -> "WorkFolder":
        return self

    def __exit__(self, *error) -> None:
        self.remove()
