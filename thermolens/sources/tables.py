"""Reading and writing readings tables, fitted state and result tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolens.operators.features import enrich
from thermolens.schema import LABELS, RAW_SCHEMA, TARGET, TIME

_SUFFIX_FORMATS = {".csv": "csv", ".csv.gz": "csv", ".json": "json", ".parquet": "parquet",
                   ".orc": "orc"}


#: Name of the column that names the folders of a table by days.
DAY = "day"
#: Name of the text column that takes unreadable lines.
CORRUPT = "_corrupt_record"


def format_of(path: str) -> str:
    """The format by suffix; a path without a known suffix is a folder of Parquet files."""
    lowered = path.lower().rstrip("/")
    return next((f for s, f in _SUFFIX_FORMATS.items() if lowered.endswith(s)), "parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA) -> DataFrame:
    """CSV with a header. A given schema saves a pass over the file; bad cells become null.

    A schema that ends with CORRUPT gets the raw line of every row with a bad cell there, so that
    such rows can be counted or set aside.
    """
    reader = spark.read.option("header", True)
    if isinstance(schema, T.StructType) and CORRUPT in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA) -> DataFrame:
    kind = format_of(path)
    if kind == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.format(kind)
    if kind == "json" and schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_first_available(spark: SparkSession, paths: Iterable[str],
                         schema: T.StructType | None = RAW_SCHEMA) -> DataFrame:
    """The first of several candidate paths that exists."""
    tried = []
    for path in paths:
        tried.append(path)
        try:
            return read_table(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError("No readings found at: " + ", ".join(tried))


def load_readings_table(spark: SparkSession, paths: str | Sequence[str],
                        schema: T.StructType | None = RAW_SCHEMA,
                        partitions: int | None = None) -> DataFrame:
    """Read, add the physical features, and set the partition count if one is asked for."""
    df = enrich(read_first_available(spark, [paths] if isinstance(paths, str) else paths, schema))
    return df.repartition(partitions) if partitions else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_days(df: DataFrame, path: str, column: str = TIME) -> None:
    """Parquet in one folder per day of ``column``, a zone-less time stamp. Days that ``df`` has rows
    of are replaced as a whole, all others stay, so a run for a day can be repeated. Null times
    have a folder of their own."""
    df.withColumn(DAY, F.to_date(column)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
              column: str = TIME) -> DataFrame:
    """Rows from ``start`` on and before ``end`` (ISO times) of a table by :func:`write_days`; only
    the folders of these days are read. Without any bound rows without a time are there too."""
    df = spark.read.parquet(path)
    for bound, is_start in ((start, True), (end, False)):
        if bound is not None:
            at = F.lit(bound).cast("timestamp_ntz")
            df = df.filter((F.col(column) >= at) & (F.col(DAY) >= F.to_date(at)) if is_start
                           else (F.col(column) < at) & (F.col(DAY) <= F.to_date(at)))
    return df.drop(DAY)


def write_csv(df: DataFrame, path: str, decimals: int | None = None) -> None:
    """CSV with a header; ``decimals`` fixes the digits of every floating-point column."""
    if decimals is not None:
        pattern = f"%.{decimals}f"
        df = df.select(*[
            F.format_string(pattern, F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema])
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def rows_to_table(spark: SparkSession, rows: Sequence[Mapping[str, object]],
                  schema: T.StructType) -> DataFrame:
    """Dictionaries to a typed table: absent or uncastable values are null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    values = [tuple(None if row.get(f.name) is None else str(row[f.name]) for f in schema)
              for row in rows]
    return coerce_schema(spark.createDataFrame(values, text), schema)


def coerce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, each cast or null."""
    return df.select(*[
        (_whole(f.name, f.dataType) if isinstance(f.dataType, T.IntegralType)
         else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema])


def _whole(name: str, kind: T.DataType) -> Column:
    """Whole-number cast within the type's own range that also takes text such as '25.0', dropping
    the fraction."""
    value = F.col(name)
    return F.coalesce(value.try_cast(kind), value.try_cast("decimal(38,9)").try_cast(kind))


def feature_metadata(features: Sequence[str], imputed: Sequence[str], engineered: Sequence[str],
                     with_std: bool = True, with_mean: bool = False) -> dict[str, object]:
    """What a consumer of the feature vectors needs to know about them."""
    return {
        "target_column": TARGET,
        "label_index_column": "label",
        "labels": list(LABELS),
        "feature_vector_dimension": len(features),
        "feature_names": list(features),
        "imputed_columns": list(imputed),
        "engineered_columns": list(engineered),
        "scaling": {"method": "StandardScaler", "with_std": with_std, "with_mean": with_mean},
    }


def write_metadata(spark: SparkSession, metadata: Mapping[str, object], path: str) -> None:
    """One JSON record, written through Spark so that any file system works."""
    from pyspark.sql import Row

    row = Row(**{k: Row(**v) if isinstance(v, dict) else v for k, v in metadata.items()})
    write_json(spark.createDataFrame([row]).coalesce(1), path)
