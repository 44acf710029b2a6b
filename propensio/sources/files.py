"""File sources and sinks for client tables and reports."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats a client table may be read from; anything else is refused.
SUPPORTED_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".orc": "orc"}


#: The client table as typed columns; a file may hold them in any order, and further ones, which stay text.
CLIENT_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.IntegerType()),
    T.StructField("FamilyMembers", T.IntegerType()),
    T.StructField("FinancialEducation", T.DoubleType()),
    T.StructField("RiskPropensity", T.DoubleType()),
    T.StructField("Income", T.DoubleType()),
    T.StructField("Wealth", T.DoubleType()),
    T.StructField("AccumulationInvestment", T.IntegerType()),
    T.StructField("IncomeInvestment", T.IntegerType()),
])
CORRUPT = "_corrupt_record"


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names (Spark keeps them)."""
    return df.toDF(*[c.strip() for c in df.columns])


def normalize_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, once, at the source.

    Spark orders NaN above every number and lets it poison max/avg, while the
    reference's tables only know one kind of missing value.
    """
    exprs = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{field.name}`")
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(field.dataType)).otherwise(c).alias(field.name))
        else:
            exprs.append(F.col(f"`{field.name}`"))
    return df.select(*exprs)


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        if fmt not in SUPPORTED_FORMATS.values():
            raise ValueError(f"no reader for format {fmt!r}")
        return fmt
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in SUPPORTED_FORMATS:
        raise ValueError(f"no reader for files ending in {ext!r}; there are readers for {', '.join(sorted(SUPPORTED_FORMATS))}")
    return SUPPORTED_FORMATS[ext]


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read a client table by extension (or explicit format).

    CSV has a header; with no schema given, types are inferred (a fallback —
    pass a schema in production). Names are trimmed and NaN becomes NULL.
    A missing path raises ``FileNotFoundError``.
    """
    kind = _format_of(path, fmt)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    try:
        df = reader.format(kind).load(path)
        df.schema  # resolve now so a missing path fails here
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Dataset file not found: {path}") from exc
        raise
    return normalize_nan(trim_column_names(df))


def header_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """``schema`` in the order of a CSV file's header, with the header's own spelling of blanks.

    Reads the header only. A column of ``schema`` that the header lacks raises; one that ``schema`` lacks is text.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    absent = [name for name in known if name not in {h.strip() for h in header}]
    if absent:
        raise ValueError(f"the header of {path} lacks {', '.join(absent)}")
    return T.StructType([T.StructField(h, known[h.strip()].dataType if h.strip() in known else T.StringType()) for h in header])


def read_clients(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType = CLIENT_SCHEMA, report_bad: bool = False) -> DataFrame:
    """The client table with declared types, in one scan of the data.

    CSV columns are matched by header, not by place, and every file's header is held against the first one's. A row that
    doesn't fit the types fails the job; with ``report_bad`` it is kept instead, its text in
    ``_corrupt_record`` (null in sound rows): ``bad_rows`` and ``sound_rows`` part them. Other formats carry their types.
    """
    if _format_of(path, fmt) != "csv":
        return read_table(spark, path, fmt)
    try:
        typed = header_schema(spark, path, schema)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no client table at {path}") from exc
        raise
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if not report_bad:
        return normalize_nan(trim_column_names(reader.schema(typed).option("mode", "FAILFAST").csv(path)))
    marked = T.StructType([*typed.fields, T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return normalize_nan(trim_column_names(reader.csv(path)))


def bad_rows(clients: DataFrame) -> DataFrame:
    """The rows of ``read_clients(..., report_bad=True)`` that don't fit the types."""
    return clients.where(F.col(CORRUPT).isNotNull())


def sound_rows(clients: DataFrame) -> DataFrame:
    return clients.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_client_file(spark: SparkSession, path: str, use_frozen: bool = True, fmt: str | None = None) -> DataFrame:
    """Read a frozen (or raw) client table; tell which step makes it if absent."""
    try:
        return read_table(spark, path, fmt)
    except FileNotFoundError as exc:
        step = "freeze" if use_frozen else "feature build"
        raise FileNotFoundError(f"{exc}. Run the data preparation ({step}) first.") from exc


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


MAX_LOCAL_ROWS = 10_000


def write_json_rows(df: DataFrame, path: str, local_copy: str | None = None) -> str:
    """Write a report as JSON lines; optionally also one small driver-side file.

    The local copy is meant for small metric reports: more than ``MAX_LOCAL_ROWS``
    rows raise before anything is written.
    """
    if local_copy and df.limit(MAX_LOCAL_ROWS + 1).count() > MAX_LOCAL_ROWS:
        raise ValueError(f"a local copy holds at most {MAX_LOCAL_ROWS} rows; read {path} instead")
    df.write.mode("overwrite").json(path)
    if local_copy:
        rows = [r.asDict(recursive=True) for r in df.collect()]
        os.makedirs(os.path.dirname(os.path.abspath(local_copy)), exist_ok=True)
        with open(local_copy, "w") as fh:
            json.dump(rows[0] if len(rows) == 1 else rows, fh, indent=2)
    return path


class ClientLoader:
    """Idempotent, cached load of the frozen (or raw) client table.

    The cache is keyed by (path, use_frozen), so asking for the other source
    reads it instead of returning the first one.
    """

    def __init__(self, spark: SparkSession, frozen_path: str, raw_path: str | None = None, fmt: str | None = None):
        self.spark = spark
        self.paths = {True: frozen_path, False: raw_path}
        self.fmt = fmt
        self._cache: dict = {}

    def load(self, use_frozen: bool = True) -> DataFrame:
        key = (self.paths[use_frozen], use_frozen)
        if key not in self._cache:
            if key[0] is None:
                raise FileNotFoundError("No raw table path configured.")
            self._cache[key] = read_client_file(self.spark, key[0], use_frozen, self.fmt).persist()
        return self._cache[key]

    def clear(self) -> None:
        for df in self._cache.values():
            df.unpersist()
        self._cache.clear()
