"""Sources, sinks and type normalisation.

* S1 inventory scan: a partitioned JDBC read (``column/lower/upper/
  numPartitions``) so the scan is split across executors; ``fetchsize``
  bounds per-round-trip memory.  Filters written before any join are pushed
  into the source query by Spark.
* S4 graph tables are Parquet: ``vertices`` partitioned by ``ne_type``,
  ``edges`` by ``relation`` (the index hints of the source system become
  partition pruning).
* S5 / S6 exports are distributed writes (one file per task); nothing is
  collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import col_has_value


def read_inventory_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
                        lower: int, upper: int, num_partitions: int, properties: dict | None = None,
                        fetch_size: int = 1000) -> DataFrame:
    """Partitioned JDBC scan of an inventory table."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=props)


def normalise_types(df: DataFrame) -> DataFrame:
    """S2 (read side): decimals -> double, integral decimals that a long can
    hold (up to 18 digits) -> long; everything else unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            small = f.dataType.scale == 0 and f.dataType.precision <= 18
            c = c.cast("long") if small else c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def _since_epoch(unit: str, ts: Column) -> Column:
    """Whole units since 1970-01-01 00:00 of a local (NTZ) timestamp: pure
    local-time arithmetic, independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff(unit, epoch, ts.cast("timestamp_ntz"))


def iso_local_string(ts: Column) -> Column:
    """Discovery time as ISO local date-time text with a space instead of
    'T': seconds dropped when seconds and fraction are zero; fraction as 3
    or 6 digits."""
    micros = _since_epoch("MICROSECOND", ts) % 1_000_000
    sec = F.second(ts)
    base = F.date_format(ts, "yyyy-MM-dd HH:mm")
    with_s = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    frac3 = F.lpad((micros / 1000).cast("long").cast("string"), 3, "0")
    frac6 = F.lpad(micros.cast("string"), 6, "0")
    return (F.when(ts.isNull(), F.lit(None))
            .when((sec == 0) & (micros == 0), base)
            .when(micros == 0, with_s)
            .when(micros % 1000 == 0, F.concat(with_s, F.lit("."), frac3))
            .otherwise(F.concat(with_s, F.lit("."), frac6)))


def to_api_types(df: DataFrame, discovery_cols: list[str], modify_cols: list[str]) -> DataFrame:
    """S2 (output side): discovery times as ISO text, modify times as epoch
    milliseconds."""
    x = df
    for c in discovery_cols:
        x = x.withColumn(c, iso_local_string(F.col(c)))
    for c in modify_cols:
        x = x.withColumn(c, _since_epoch("MILLISECOND", F.col(c)))
    return x


def today_only(df: DataFrame, ts_col: str, run_date: str) -> DataFrame:
    """S3: rows discovered on ``run_date`` (a parameter, never the clock).
    Written as a range on the raw column so it pushes down to the scan."""
    start = F.lit(run_date).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(run_date).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts_col) >= start) & (F.col(ts_col) < end))


def load_graph(spark: SparkSession, path: str) -> DataFrame:
    """Stored graph table; single-element list properties unwrapped."""
    df = spark.read.parquet(path)
    drop = [c for c in ("id", "label", "IN", "OUT") if c in df.columns]
    df = df.drop(*drop)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.when(F.size(c) == 1, F.element_at(c, 1).cast("string")).otherwise(F.to_json(c))
        out.append(c.alias(f.name))
    return df.select(*out)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the graph: vertices partitioned by type, edges by relation."""
    vertices.write.mode(mode).partitionBy("ne_type").parquet(f"{path}/vertices")
    edges.write.mode(mode).partitionBy("relation").parquet(f"{path}/edges")


def export(vertices: DataFrame, edges: DataFrame, path: str, opmode: str = "both",
           fmt: str = "json") -> list[str]:
    """Full export, one dataset per element kind; vertices need
    coordinates.  CSV has a header, quotes everything, escapes quotes by
    doubling."""
    m = opmode.strip().lower()
    written = []
    parts = []
    if m in ("vertices", "vertex", "both"):
        v = vertices.filter(col_has_value("latitude") & col_has_value("longitude"))
        parts.append(("vertices", v))
    if m in ("edge", "edges", "both"):
        parts.append(("edges", edges))
    for name, df in parts:
        out = f"{path}/{name}"
        flat = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                           if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
                           else F.col(f.name) for f in df.schema.fields])
        if fmt == "csv":
            flat.write.mode("overwrite").option("header", True).option("quoteAll", True) \
                .option("escape", '"').csv(out)
        else:
            df.write.mode("overwrite").json(out)
        written.append(out)
    return written


def export_merge_result(classified: DataFrame, path: str, header: list[str],
                        error_col: str = "reject_reason") -> list[str]:
    """Three CSVs (new, updated, failed records) with a fixed header; the
    failed one adds the error text."""
    written = []
    for cls in ("new", "updated", "failed"):
        cols = header + ([error_col] if cls == "failed" and error_col in classified.columns else [])
        out = f"{path}/{cls}"
        (classified.filter(F.col("record_class") == cls).select(*cols)
         .write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(out))
        written.append(out)
    return written


def watermark(config: DataFrame, keys: list[str]) -> DataFrame:
    """The time every vendor has reached = min over the given per-vendor keys."""
    return (config.filter(F.col("config_key").isin(keys))
            .agg(F.min("config_value").alias("watermark")))


def config_codes(config: DataFrame, key: str, field: str = "codes") -> DataFrame:
    """JSON object with an array field of text or number codes -> one row
    per trimmed non-blank code."""
    row = config.filter(F.col("config_key") == key)
    arr = F.from_json("config_value", T.StructType([T.StructField(field, T.ArrayType(T.StringType()))]))
    return (row.select(F.explode(arr[field]).alias("value"))
            .select(F.trim("value").alias("value")).filter(F.col("value") != ""))
