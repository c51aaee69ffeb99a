"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Quotes inside a quoted field are doubled. Fields with line ends need ``multiLine``, which reads each file in one task.
CSV_DIALECT = {"quote": '"', "escape": '"'}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float/double NaN becomes NULL so every operator sees one missing value."""
    cols = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{f.name}`")
            cols.append(F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name))
            changed = True
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols) if changed else df


def read_parquet(spark: SparkSession, path: str, nan_as_null: bool = True) -> DataFrame:
    """Parquet scan. ``nan_as_null`` rewrites float columns with ``nanvl``;
    a predicate on a rewritten column can no longer be pushed into the scan,
    so pass False for sources known to hold no NaN (other columns always
    keep pushdown)."""
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_as_null else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer_schema: bool = True, **options) -> DataFrame:
    """CSV scan; a malformed file fails the job (FAILFAST) instead of
    silently dropping rows."""
    reader = spark.read.options(**CSV_DIALECT).option("header", header).option("mode", "FAILFAST")
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return nan_to_null(reader.csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multi_line: bool = True, flatten: bool = True) -> DataFrame:
    """JSON table scan: an array of flat records (``multi_line``) or JSON
    lines. Nested struct fields are flattened to ``parent_child`` columns;
    arrays and maps are refused, since the table model is flat."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if flatten:
        df = _flatten(df)
    return nan_to_null(df)


def _flatten(df: DataFrame) -> DataFrame:
    out = []
    stack = [((), f) for f in df.schema.fields]
    while stack:
        path, field = stack.pop(0)
        full = path + (field.name,)
        if isinstance(field.dataType, T.StructType):
            stack = [(full, f) for f in field.dataType.fields] + stack
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            raise ValueError(f"Nested field {'.'.join(full)} is not a flat column")
        else:
            ref = F.col(".".join(f"`{p}`" for p in full))
            out.append(ref.alias("_".join(full)))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """Reader chosen by file suffix, as an upload would be."""
    lower = path.lower().rstrip("/")
    if lower.endswith(".csv") or lower.endswith(".csv.gz"):
        return read_csv(spark, path, **options)
    if lower.endswith(".json") or lower.endswith(".jsonl"):
        return read_json(spark, path, multi_line=not lower.endswith(".jsonl"), **options)
    if lower.endswith(".parquet"):
        return read_parquet(spark, path)
    raise ValueError(f"Unsupported file type: {path}")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header and no index column (S3). Spark writes one
    part file per partition; the folder is the table."""
    df.write.mode(mode).options(**CSV_DIALECT).option("header", True).csv(path)
