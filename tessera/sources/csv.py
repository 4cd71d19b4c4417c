"""CSV scans and sinks.

Schemas are always explicit: inference costs a full extra pass over the
input.  Money columns that must keep their raw text are read as strings and
get a lenient numeric twin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from tessera.functions.text import lenient_double


def scan_csv(spark: SparkSession, path: str, schema: StructType, null_value: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema; ``null_value`` (e.g. ``\\N``)
    becomes null at the scan."""
    r = spark.read.option("header", True).schema(schema)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def scan_csv_typed(spark: SparkSession, path: str, schema: StructType, raw_columns: Sequence[str],
                   raw_suffix: str = "_raw") -> DataFrame:
    """Scan with ``raw_columns`` read as text: each keeps its text as
    ``<col>_raw`` and gets a lenient double ``<col>`` (junk → null)."""
    fields = [StructField(f.name, StringType(), True) if f.name in raw_columns else f for f in schema.fields]
    df = scan_csv(spark, path, StructType(fields))
    out = df.withColumns({f"{c}{raw_suffix}": F.col(c) for c in raw_columns})
    return out.withColumns({c: lenient_double(f"{c}{raw_suffix}") for c in raw_columns})


def sink_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, float_digits: int | None = 4,
             mode: str = "overwrite") -> None:
    """Write selected columns as header CSV; doubles rounded to
    ``float_digits`` (the ``'%.4f'`` float format)."""
    d = df.select(*columns) if columns else df
    if float_digits is not None:
        d = d.withColumns({f.name: F.round(f.name, float_digits) for f in d.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))})
    d.write.mode(mode).option("header", True).csv(path)


def load_stack_table(spark: SparkSession, path: str, key: str, prefix: str, schema: StructType) -> DataFrame:
    """Read an earlier stage's probability table and prefix its columns so
    it can be stacked next to other stages' outputs."""
    df = scan_csv(spark, path, schema)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c != key})
