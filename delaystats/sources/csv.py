"""Delimited-file sources: quoted CSV scan and naive line split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.operators.ingest import CORRUPT
from delaystats.schema import COLUMNS, all_string_schema
from delaystats.session import write_settings


def read_flights_csv(spark: SparkSession, paths: str | list[str],
                     extra: T.StructType | None = None, header: bool = True,
                     flag_malformed: bool = True) -> DataFrame:
    """Quoted CSV with a header line per file; all 29 fields as text.

    Several paths are read as one UNION ALL (order of inputs kept, no
    de-duplication).  Empty fields come back as ``''`` like the csv module
    gives them, not NULL.  With ``flag_malformed`` short and long rows are
    kept and marked in ``_corrupt_record`` so that the load rejects them; every
    field of a row is then split, whichever columns a query asks for, or the
    mark would depend on the query.  A line is a record: for quoted fields
    with line ends see ``multiline.read_multiline_csv``.
    """
    schema = all_string_schema(extra)
    if flag_malformed:
        schema = schema.add(T.StructField(CORRUPT, T.StringType(), True))
    reader = (spark.read.schema(schema)
              .option("header", header)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("columnPruning", not flag_malformed)
              .option("quote", '"')
              .option("escape", '"'))
    df = reader.csv(paths)
    text = set(COLUMNS)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c)
                       for c in df.columns])


def read_split_lines(spark: SparkSession, paths: str | list[str],
                     header_line: str | None = None) -> DataFrame:
    """Lines split on every comma, quotes not honoured.

    Trailing empty fields are dropped (``"a,b,,"`` gives two fields); a line
    of commas only gives no fields; an empty line gives one empty field.
    Lines equal to ``header_line`` are skipped.
    """
    lines = spark.read.text(paths)
    if header_line is not None:
        lines = lines.where(F.col("value") != F.lit(header_line))
    stripped = F.regexp_replace(F.col("value"), ",+$", "")
    fields = (F.when(F.col("value") == "", F.array(F.lit("")))
              .when(stripped == "", F.array().cast("array<string>"))
              .otherwise(F.split(stripped, ",", -1)))
    return lines.select(fields.alias("fields"))


def chain(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of several inputs, in order, duplicates kept.

    (Reading one path twice in a single ``spark.read`` would list its files
    once, so each input is its own scan.)
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    with write_settings(df.sparkSession, split=False):
        df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)
    return path


def header_of(columns: list[str]) -> str:
    return ",".join(columns)
