"""Raw envelope I/O and the one-pass payload flatten."""

from __future__ import annotations

import fnmatch
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.functions.casts import parse_rfc3339, safe_bool, safe_int
from commitlake.functions.jsonpath import scalar_leaf
from commitlake.session import free_shuffles
from commitlake.sources.schemas import ENVELOPE, SDC_COLUMNS, STREAM_FIELDS, payload_schema


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a landed raw stream with the fixed envelope schema (no inference)."""
    return spark.read.schema(ENVELOPE).format(fmt).load(path)


def land_envelope(records: DataFrame, payload: list[Column] | Column, extracted_at: Column,
                  received_at: Column | None = None, batched_at: Column | None = None,
                  deleted_at: Column | None = None, sequence: Column | None = None,
                  table_version: Column | None = None) -> DataFrame:
    """Pack typed records into the fixed envelope: ``data`` = JSON text of ``payload``.

    ``payload`` is a struct column (or a list of named columns). NULL fields are
    omitted from the JSON, which readers treat like an explicit ``null``.
    """
    body = payload if isinstance(payload, Column) else F.struct(*payload)
    ts_null = F.lit(None).cast("timestamp")
    return records.select(
        F.to_json(body).alias("data"),
        extracted_at.cast("timestamp").alias("_sdc_extracted_at"),
        (received_at if received_at is not None else extracted_at).cast("timestamp").alias("_sdc_received_at"),
        (batched_at if batched_at is not None else extracted_at).cast("timestamp").alias("_sdc_batched_at"),
        (deleted_at if deleted_at is not None else ts_null).cast("timestamp").alias("_sdc_deleted_at"),
        (sequence if sequence is not None else F.lit(None)).cast("bigint").alias("_sdc_sequence"),
        (table_version if table_version is not None else F.lit(None)).cast("bigint").alias("_sdc_table_version"),
    )


def write_raw(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet landing of an envelope stream (plain-encoded payload text)."""
    from commitlake.operators.incremental import parquet_options
    raw.write.mode(mode).options(**parquet_options(raw.columns)).parquet(path)


LANDED = "landed_on"
UNDATED = "__HIVE_DEFAULT_PARTITION__"        # Spark's folder of rows without a date


class Landing:
    """A landed stream in parquet folders by the (UTC) date of ``_sdc_extracted_at``.

    A watermark on the extraction time becomes a choice of folders: one listing of the folder names under ``path``, then
    only folders of its day or later are listed and read. Rows without an extraction time have a folder of their own,
    which only whole reads take, as no watermark lets them pass. A date with a third of all rows is split over tasks and
    files. ``incremental_run`` takes a Landing in place of a DataFrame. A lost append may be repeated: it lands rows a
    second time, which keep-latest removes.
    """

    schema = ENVELOPE

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, raw: DataFrame) -> None:
        """Land ``raw``; columns outside the schema are left out."""
        from commitlake.operators.incremental import parquet_options
        dated = raw.select(*self.schema.names, F.to_date("_sdc_extracted_at").alias(LANDED))
        with free_shuffles(self.spark):
            dated.hint("rebalance", LANDED).write.mode("append").options(**parquet_options(dated.columns)).partitionBy(
                LANDED).parquet(self.path)

    def folders(self) -> list[str]:
        """The landing dates, ascending (one listing; their number is that of days)."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(place)] if fs.exists(place) else []
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{LANDED}="))

    def _dated(self, dates: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(LANDED, T.DateType())])
        if not dates:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(
            *[f"{self.path}/{LANDED}={d}" for d in dates])

    def read(self) -> DataFrame:
        return self._dated(self.folders()).drop(LANDED)

    def newer_than(self, column: str, bound) -> DataFrame:
        """Rows strictly above ``bound`` (timestamps as epoch microseconds), from the folders that can hold them."""
        from commitlake.operators.incremental import newer_than
        if column != "_sdc_extracted_at":
            return newer_than(self.read(), column, bound)
        day = (datetime(1970, 1, 1) + timedelta(microseconds=bound)).date()
        rows = self._dated([d for d in self.folders() if d != UNDATED and d >= day.isoformat()])
        return newer_than(rows.where(F.col(LANDED) >= F.lit(day)), column, bound).drop(LANDED)


def open_raw(spark: SparkSession, path: str) -> DataFrame | Landing:
    """A landed stream by its layout: folders by date, or a plain folder of parquet files."""
    landing = Landing(spark, path)
    return landing if landing.folders() else read_raw(spark, path)


def write_jsonl(raw: DataFrame, path: str, mode: str = "append") -> None:
    """JSON-lines landing (one envelope per line), the alternate loader format."""
    raw.select(*[f.name for f in ENVELOPE.fields]).write.mode(mode).json(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return read_raw(spark, path, fmt="json")


def _leaf(parsed: Column, path: str) -> Column:
    c = parsed
    for part in path.split("."):
        c = c.getField(part)
    return c


def _typed(text: Column, kind: str) -> Column:
    if kind == "i":
        return safe_int(text)
    if kind == "b":
        return safe_bool(text)
    if kind == "t":
        return parse_rfc3339(text)
    return text


def parse_payload(raw: DataFrame, fields, keep: list[str] | None = None, strict: bool = True,
                  data_col: str = "data") -> DataFrame:
    """Flatten the JSON payload into typed columns; each document is tokenised once.

    ``fields`` is a list of (column, path, cast kind) (see ``schemas``). Leaves
    are read as strings (the fast Jackson path). With ``strict=True`` the
    result equals scalar-only extraction (``JSON_VALUE``: objects and arrays
    give NULL): only for a leaf whose text starts with ``{`` or ``[`` the value
    is read again to tell a container from a string such as ``"[build] jar"``.
    """
    keep = [c for c in raw.columns if c != data_col] if keep is None else keep
    parsed = raw.select(*keep, F.col(data_col).alias("_raw"),
                        F.from_json(F.col(data_col), payload_schema(fields)).alias("_p"))
    parsed = parsed.select(*keep, "_raw", F.inline(F.array(F.struct("_p"))))
    out = []
    for name, path, kind in fields:
        text = _leaf(F.col("_p"), path)
        # Container text under an int/bool/timestamp leaf already fails its safe cast → NULL,
        # so only string leaves need the exact container check.
        if strict and kind == "s":
            text = scalar_leaf(text, F.col("_raw"), path)
        out.append(_typed(text, kind).alias(name))
    # Two generators: the first keeps the parse from being merged into each column that reads it, at the second stop
    # filters on the typed columns, which below it would be evaluated on the document again. The columns are made in the
    # projection between them, as Spark interprets expressions inside a generator and compiles those of a projection.
    # An array made in place, unlike a column, gives Spark no filter on its size to infer.
    return parsed.select(F.struct(*keep, *out).alias("_row")).select(F.inline(F.array("_row")))


def raw_view(spark: SparkSession, raw: DataFrame, stream: str, name: str | None = None,
             strict: bool = True) -> DataFrame:
    """Typed view over a raw stream (envelope + every payload column), registered as a temp view."""
    typed = parse_payload(raw, STREAM_FIELDS[stream], keep=SDC_COLUMNS, strict=strict)
    typed.createOrReplaceTempView(name or f"{stream}_view")
    return typed


def select_streams(catalog: dict[str, DataFrame], patterns: list[str]) -> dict[str, DataFrame]:
    """Apply ``stream.property`` selection patterns (``commits.*``) to a catalog of raw streams.

    A stream is kept when any pattern's stream part matches its name. With
    property parts other than ``*``, the payload keeps the top-level properties
    whose names match; the envelope columns always stay.
    """
    out: dict[str, DataFrame] = {}
    for stream, df in catalog.items():
        props = [p.split(".", 1)[1] if "." in p else "*" for p in patterns
                 if fnmatch.fnmatchcase(stream, p.split(".", 1)[0])]
        if not props:
            continue
        if "*" in props:
            out[stream] = df
        else:
            out[stream] = _with_properties(df, stream, props)
    return out


def _with_properties(raw: DataFrame, stream: str, patterns: list[str]) -> DataFrame:
    """``raw`` with its payload, and any typed columns beside it, cut down to the properties that match a pattern."""
    raw = raw.select(*[c for c in raw.columns if c.startswith("_sdc_") or c == "data"
                       or any(fnmatch.fnmatchcase(c, p) for p in patterns)])
    whole = payload_schema(STREAM_FIELDS[stream])
    kept = T.StructType([f for f in whole.fields if any(fnmatch.fnmatchcase(f.name, p) for p in patterns)])
    data = F.to_json(F.from_json("data", kept)) if kept.fields else F.lit("{}")
    return raw.withColumn("data", F.when(F.col("data").isNotNull(), data))
