"""Tables whose days lie in plain ``yyyy/MM/dd`` folders, known to the catalog as partitions with that text.

Folder names carry no column name, so the catalog says which day a folder holds. A batch writes its days below a folder of
its own; then each day's partition is pointed there in place, so that readers find the old rows or the new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.layout import spread_for_write
from tidemark.tables import storage
from tidemark.tables.catalog import place_partitions

# The text of a day, and of rows without one.
SLASH_PATTERN = "yyyy/MM/dd"
NO_DAY = "undated"
_PARTS = ("tidemark_year", "tidemark_month", "tidemark_day")


def write_days(rows: DataFrame, folder: str, day: str) -> dict[str, str]:
    """Writes rows below ``folder`` by their day (a text of the pattern); returns the folder of each day.

    The writer names folders after columns; they are renamed once all are written. The driver sees one name per day.
    """
    spark = rows.sparkSession
    text = F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY))
    parts = {p: F.coalesce(F.try_element_at(F.split(text, "/"), F.lit(k + 1)), F.lit("-")) for k, p in enumerate(_PARTS)}
    spread_for_write(rows.withColumns(parts).drop(day), _PARTS).write.partitionBy(*_PARTS).parquet(folder)
    found = {}
    for path in storage.partition_folders(spark, folder, len(_PARTS)):
        values = [piece.split("=", 1)[1] for piece in path.split("/")]
        name = "/".join(v for v in values if v != "-")
        _rename(spark, f"{folder}/{path}", f"{folder}/{name}")
        found[name] = f"{folder}/{name}"
    for left in storage.children(spark, folder):
        if left.startswith(f"{_PARTS[0]}="):
            storage.delete(spark, f"{folder}/{left}")
    return found


def _rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target).getParent())
    if not files.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")


def publish_days(spark: SparkSession, table: str, schema: str, day: str, days: dict[str, str], home: str) -> None:
    """Points the partitions of ``table`` at the folders of these days; other days stay as they are.

    ``schema`` lists the columns without the day. The table is made if needed, on the folder ``home``.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}, `{day}` STRING) USING parquet PARTITIONED BY (`{day}`) LOCATION '{home}'")
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    listed = [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    known = {_clause(day, unescape(v)) for v in listed}
    place_partitions(spark, table, {_clause(day, d): place for d, place in days.items()}, known)


def _clause(day: str, value: str) -> str:
    return f"PARTITION (`{day}` = '{value}')"
