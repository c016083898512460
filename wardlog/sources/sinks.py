"""Writing and reading back tables, profiles, metrics and maps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.functions import one_line


def write_table(df: DataFrame, path: str, partition_by=()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is what a CSV cell can hold."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """One line per record: line breaks inside texts are escaped, so the files can be split."""
    flat = _flat(df)
    lines = flat.select(*[one_line(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in flat.dtypes])
    lines.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_log_lines(events: DataFrame, path: str, mode="overwrite") -> None:
    """Raw events as JSON lines, as the sensor writes them. Absent keys stay absent."""
    from wardlog.schema import RAW_FIELDS

    line = F.to_json(F.struct(*[F.col(n) for n in RAW_FIELDS if n in events.columns]))
    events.select(line.alias("value")).write.mode(mode).text(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Wide metrics as long rows (model, metric, value)."""
    long_metrics(metrics).write.mode("overwrite").parquet(path)


def long_metrics(metrics: DataFrame) -> DataFrame:
    names = [f.name for f in metrics.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return metrics.unpivot("model", names, "metric", "value")


def sample_rows(df: DataFrame, id_col="id", n=5) -> DataFrame:
    """The first n rows by id."""
    return df.orderBy(id_col).limit(n)
