"""Sources and sinks (S-1, S-2, S-6..S-10): CSV with declared schemas, parquet,
managed tables with a format argument, and JSON summaries.

Output folders are parameters; on a cluster they live on shared storage.
Nothing is funnelled through one task: no ``coalesce(1)`` on output.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Text tokens pandas and R read as missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
             "NULL", "NaN", "None", "n/a", "nan", "null")
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_csv(df: DataFrame, path: str, null_token: str = "") -> None:
    """Header CSV, one file per task, timestamps in one fixed text form, quotes doubled (S-7)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", null_token)
     .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
     .csv(path))


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType,
             na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Header CSV with a declared schema instead of inference (S-1, S-2).

    Spark maps only one ``nullValue`` token to null, so the file is read as
    text first and every missing-value token is normalised before the typed
    cast; text that does not parse becomes null (G-15, G-17).
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", True)
           .schema(StructType([StructField(f.name, StringType(), True) for f in schema.fields]))
           .csv(path))
    tokens = list(na_tokens)
    cols = []
    for f in schema.fields:
        c = F.when(F.trim(F.col(f.name)).isin(tokens), F.lit(None)).otherwise(F.col(f.name))
        t = f.dataType.simpleString()
        if t == "timestamp_ntz":
            c = F.try_to_timestamp(c, F.lit(TS_FORMAT)).cast("timestamp_ntz")
        elif t == "timestamp":
            c = F.try_to_timestamp(c, F.lit(TS_FORMAT))
        elif t == "boolean":
            low = F.lower(F.trim(c))
            c = F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)
        elif t in ("double", "float"):
            c = c.try_cast(f.dataType)
            c = F.when(~F.isnan(c), c)
        elif t != "string":
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Parquet, overwrite; ``partition_by`` enables partition pruning on read (S-8)."""
    w = df.write.mode("overwrite")
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def _commit_file(path: str) -> str:
    return f"{path.rstrip('/')}/COMMITTED"


def save_table(df: DataFrame, name: str, path: str, fmt: str = "parquet",
               checks: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """A table and a folder copy of the same rows, as the notebook writes them (S-9).

    Returns the table, the folder copy and the values of ``checks``: aggregates that
    ride on the folder's write, so that checking costs no scan.  ``fmt`` is a parameter
    (parquet by default; delta needs its jar on the classpath).

    Both places are written under a new version first: ``<path>/folder/v=<id>`` and
    ``<path>/table/v=<id>``.  One marker file then names the version, and the table is pointed
    at it.  A job that fails before the marker leaves the old pair; one that fails after it is
    finished by ``open_table``, which points the table where the marker says.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    folder, table = f"{path}/folder/v={version}", f"{path}/table/v={version}"
    seen = Observation()
    watched = df.observe(seen, *[c.alias(k) for k, c in checks.items()]) if checks else df
    watched.write.format(fmt).mode("error").save(folder)
    # the second place is a copy of the first, so the two cannot differ
    spark.read.format(fmt).schema(df.schema).load(folder).write.format(fmt).mode("error").save(table)
    _write_marker(spark, _commit_file(path), f"{version} {fmt}")
    return (*open_table(spark, name, path), {k: int(v or 0) for k, v in seen.get.items()} if checks else {})


def _write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written aside, then renamed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    aside, at = jvm.org.apache.hadoop.fs.Path(f"{path}.new"), jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(aside, at, options)


def open_table(spark: SparkSession, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The committed pair: table ``name`` and its folder copy; the table is pointed at the committed version."""
    version, fmt = spark.read.text(_commit_file(path)).first()[0].split(" ")
    folder, table = f"{path}/folder/v={version}", f"{path}/table/v={version}"
    schema = spark.read.format(fmt).load(table).schema
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
    spark.catalog.createTable(name, path=table, source=fmt, schema=schema)
    return spark.table(name), spark.read.format(fmt).schema(schema).load(folder)


def write_json(df: DataFrame, path: str) -> None:
    """Summary / KPI rows as JSON lines (S-10)."""
    df.write.mode("overwrite").json(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder and cast to a declared schema, failing on missing columns (S-6)."""
    return df.to(schema)
