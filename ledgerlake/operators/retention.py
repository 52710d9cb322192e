"""Physical retention (SNK10, SNK11): expired partitions are dropped, no row is read.

A stored folder is registered as a table of the session's catalog, partitioned as its
folders are.  What has expired is seen from the list of partitions alone; these are
dropped from the catalog and their folders deleted.  The others are not opened.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder


def register(spark: SparkSession, path: str, schema: T.StructType, column: str) -> str:
    """Register the folder ``path`` as a table partitioned by ``column``; returns its name."""
    name = f"stored_{hashlib.sha1(path.encode()).hexdigest()[:20]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """The values (as text) of the table's partition column, from the catalog."""
    value = F.url_decode(F.element_at(F.split("partition", "=", 2), 2))
    return spark.sql(f"SHOW PARTITIONS {name}").select(value.alias("value"))


def drop_expired(spark: SparkSession, path: str, name: str, column: str, as_of: dt.date | str,
                 days: int | None = None, months: int | None = None) -> list[str]:
    """Drop the partitions before the retention limit; returns their values.

    ``column`` holds dates (``days``) or ``yyyy-MM`` cycles (``months``); both sort as text.
    The null partition is no date and stays.  A job lost between the two steps leaves a
    folder that ``register`` finds again, so a re-run ends it.
    """
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if days is not None:
        limit = (day - dt.timedelta(days=days)).isoformat()
    elif months is not None:
        at = day.year * 12 + day.month - 1 - months
        limit = f"{at // 12:04d}-{at % 12 + 1:02d}"
    else:
        raise ValueError("give days or months")
    old = partitions(spark, name).filter((F.col("value") < limit) & ~F.col("value").startswith("__HIVE"))
    values = sorted(r["value"] for r in old.collect())  # one for each partition
    hive = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for v in values:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = '{v}')")
        delete_folder(spark, f"{path}/{hive.getPartitionPathString(column, v)}")
    return values
