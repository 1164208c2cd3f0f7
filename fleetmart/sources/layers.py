"""Bronze and Silver Parquet, whole or by delivery day."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "ds"


class Layers:
    """Staged tables under one root.

    ``<root>/<layer>/<entity>`` holds a whole table; for daily deliveries it is
    partitioned by ``ds``, and writing a day again replaces that day only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, entity: str) -> str:
        return f"{self.root}/{layer}/{entity}"

    def save(self, df: DataFrame, layer: str, entity: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(layer, entity))
        return self.load(layer, entity, df.schema)

    def load(self, layer: str, entity: str, schema: T.StructType | None = None) -> DataFrame:
        """A stored table; with a known schema no file is opened for it.

        Without one it has the columns of all its files: days may differ.
        """
        path = self.path(layer, entity)
        reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", True)
        try:
            return reader.parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(path) from e
            raise

    def save_day(self, df: DataFrame, layer: str, entity: str, day: str) -> DataFrame:
        (
            df.withColumn(DAY, F.lit(day))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(self.path(layer, entity))
        )
        return self.load_day(layer, entity, day, df.schema)

    def load_day(self, layer: str, entity: str, day: str, schema: T.StructType | None = None) -> DataFrame:
        """The rows of one day; other days' folders are not listed as input."""
        if schema:
            schema = T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])
        return self.load(layer, entity, schema).where(F.col(DAY) == day).drop(DAY)
