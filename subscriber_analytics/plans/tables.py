"""Tables with one row a customer, bucketed by customer, so that later reads join them without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKETS = 64
KEY = "customer_id"


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int = BUCKETS, key: str = KEY) -> None:
    """Write ``df`` as the table ``name`` at ``path``: a file a bucket, each in the order of the key.

    The number of buckets stays with the table. Two tables join without a shuffle if theirs is the same.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )


def attach_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int = BUCKETS,
                    key: str = KEY) -> DataFrame:
    """The files of a bucketed table as a table of this session, for instance after a restart without a metastore."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{location}'")
    return spark.table(name)
