"""Readers and writers: snapshots, exports, official tables, run logs, archives."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.functions.text import match_name
from lastro.params import Portfolio

UTF8, LATIN = "UTF-8", "ISO-8859-1"
SEPARATORS = (";", ",", "\t", "|")
CORRUPT = "_corrompido"
_NO_SEPARATOR = "\x01"


# Column names ---------------------------------------------------------------


def resolve_column(df: DataFrame, name: str, required: bool = True, drop: str = " _.") -> str | None:
    """The frame's column that matches ``name`` but for accents, case and ``drop``.

    Headers read under a wrong encoding match too: each of their non-ASCII
    characters stands for any one character of the wanted name.
    """
    target = match_name(name, drop)
    for column in df.columns:
        if match_name(column, drop) == target:
            return column
    for column in df.columns:
        pattern = "".join(re.escape(c) if c.isascii() else "." for c in column)
        if not column.isascii() and re.fullmatch(pattern, name, flags=re.IGNORECASE):
            return column
    if required:
        raise ValueError(f"no column matches {name!r}; the frame has {df.columns}")
    return None


def named(name: str) -> Column:
    """Column by its exact name, whatever characters it has."""
    return F.col(f"`{name}`")


# Readers --------------------------------------------------------------------


def read_snapshot_dir(spark: SparkSession, path: str) -> DataFrame:
    """All part files of a Parquet directory; an empty directory is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        raise ValueError(f"no part file in {path}") from error


def read_snapshot(spark: SparkSession, lake_path: str, override: str | None = None) -> DataFrame:
    """The lake snapshot, or the one a configured path puts in its place."""
    return read_snapshot_dir(spark, override or lake_path)


def read_official_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog table of an official month."""
    return spark.read.table(name)


def generation(snapshot: DataFrame) -> DataFrame:
    """Rows and generation stamps of a snapshot."""
    stamp = F.col("snapshot_gerado_em")
    return snapshot.agg(F.count(F.lit(1)).alias("linhas"), F.min(stamp).alias("primeira"), F.max(stamp).alias("gerado_em"))


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    return spark.read.csv(path, sep=_NO_SEPARATOR, quote="", encoding=encoding, schema="linha string", mode="PERMISSIVE")


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 unless some line does not decode. Stops at the first such line."""
    bad = _lines(spark, path, UTF8).where(F.col("linha").contains("\ufffd"))
    return UTF8 if bad.isEmpty() else LATIN


def _windows_marks() -> tuple[str, str]:
    """Control characters Latin-1 shows where Windows-1252 has letters and marks."""
    pairs = []
    for byte in range(0x80, 0xA0):
        try:
            pairs.append((chr(byte), bytes([byte]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def read_export_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Delimited export of unknown separator and encoding, every column as text.

    Malformed rows keep their raw line in ``_corrompido``. ``multi_line`` allows
    line breaks inside quotes, at the price of one task per file.
    """
    encoding = detect_encoding(spark, path)
    first = _lines(spark, path, encoding).head()
    if first is None:
        raise ValueError(f"{path} is empty")
    header = first.linha.lstrip("\ufeff")
    separator = max(SEPARATORS, key=header.count)
    if header.count(separator) == 0:
        raise ValueError(f"{path} has a single column")
    names = [part.strip().strip('"') for part in header.split(separator)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, CORRUPT)])
    rows = spark.read.csv(
        path,
        schema=schema,
        sep=separator,
        encoding=encoding,
        header=True,
        enforceSchema=False,  # a part file with another header is an error, never read by position
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        multiLine=multi_line,
    )
    if encoding == UTF8:
        return rows
    controls, marks = _windows_marks()
    return rows.select(*(F.translate(named(c), controls, marks).alias(c) for c in rows.columns))


def read_partitioned(spark: SparkSession, path: str, portfolio: Portfolio) -> DataFrame:
    """A table written by ``write_partitioned``, other prefixes never listed."""
    return spark.read.parquet(path).where(F.col("obra_prefix").isin(*portfolio.prefixes)).drop("obra_prefix")


# Writers --------------------------------------------------------------------


def write_partitioned(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Partitioned by development prefix, so the prefix predicate prunes directories."""
    prefixed = df.withColumn("obra_prefix", F.left("obra", F.lit(2)))
    prefixed.write.mode(mode).partitionBy("obra_prefix").parquet(path)


def _number_text(field: T.StructField, decimal_comma: bool) -> Column:
    col = F.col(f"`{field.name}`")
    if decimal_comma and isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.translate(F.format_string("%.2f", col.cast("double")), ".", ",").alias(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return col.cast("double").alias(field.name)
    return col


def write_csv_br(df: DataFrame, path: str, decimal_comma: bool = False) -> None:
    """';' separated UTF-8 part files with header. Spark writes no byte order mark."""
    shown = df.select(*(_number_text(field, decimal_comma) for field in df.schema.fields))
    shown.write.mode("errorifexists").option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)


def write_adjusted_copy(df: DataFrame, path: str) -> None:
    """A corrected copy beside the original; an existing copy is never replaced."""
    df.write.mode("errorifexists").parquet(path)


def append_run_log(df: DataFrame, path: str, month: str, executed_at: str) -> None:
    """One execution of a close, appended under its month and execution."""
    stamped = df.withColumns({"anomes": F.lit(month), "dt_execucao": F.lit(executed_at)})
    stamped.write.mode("append").partitionBy("anomes", "dt_execucao").parquet(path)


def publish_month(df: DataFrame, path: str, month: str) -> None:
    """One version per month: the month's partition is replaced, others stay."""
    stamped = df.withColumn("anomes", F.lit(month))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("anomes").parquet(path)


def publish_official_table(df: DataFrame, name: str, path: str) -> None:
    """A catalog table over files in a new folder; a table of that name is replaced, its old files stay."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)


def archive_snapshot(snapshot: DataFrame, path: str, first: date, last: date, force: bool = False) -> None:
    """Dated copy of a photo; refused when it was taken outside [first, last]."""
    day = F.to_date("snapshot_gerado_em")
    if not force:
        outside = snapshot.where(~day.between(F.lit(first), F.lit(last)) | day.isNull())
        if not outside.isEmpty():
            raise ValueError(f"the photo was not taken between {first} and {last}")
    snapshot.withColumn("foto", day).write.mode("append").partitionBy("foto").parquet(path)
