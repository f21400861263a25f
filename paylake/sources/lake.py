"""Lake readers and writers.

* ``read_table`` - scan with an explicit schema (never inferred).
* ``read_day_slice`` / ``read_range`` - time slices written as ranges so the
  predicate reaches the Parquet scan (``DATE(col) = d`` would block it).
* ``read_since`` - high-water-mark read, tie-safe on ``(created_at, id)``.
* ``export_partition`` - date-partitioned export, ``year=/month=/day=``,
  dynamic partition overwrite: re-running a day replaces that day only.
* ``export_snapshot`` / ``read_snapshot`` - full snapshot to a new version
  folder; the pointer (a one-row table) is written last.
* ``insert_if_absent`` - ``INSERT ... ON CONFLICT DO NOTHING`` by key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paylake.session import children, path_exists


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Read a table; ``fmt`` may be ``jdbc`` with the usual partitioning options."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str, lower, upper,
                    num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Full read of a database table, split into ``num_partitions`` parallel range queries.

    Spark issues one query per stride of ``partition_column`` between
    ``lower`` and ``upper`` (rows outside go to the first/last partition), so
    no single task reads the whole table.  Needs the JDBC driver on the
    classpath; the export jobs take the resulting DataFrame like any other.
    """
    opts = {"url": url, "dbtable": table, "partitionColumn": partition_column,
            "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(num_partitions)}
    opts.update(properties or {})
    return spark.read.format("jdbc").options(**opts).load()


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns cast to their declared types, in the declared order; NaN becomes NULL, a value that does not fit is an error."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("timestamp_ntz")


def read_range(df: DataFrame, start, end, col: str = "created_at") -> DataFrame:
    """Rows with ``start <= col < end`` (sargable)."""
    return df.filter((F.col(col) >= _ts(start)) & (F.col(col) < _ts(end)))


def read_day_slice(df: DataFrame, day, col: str = "created_at") -> DataFrame:
    """Rows of one calendar day; ``day`` is a date string or a date column."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    start = d.cast("timestamp_ntz")
    return df.filter((F.col(col) >= start) & (F.col(col) < F.date_add(d, 1).cast("timestamp_ntz")))


def read_since(df: DataFrame, mark_ts, mark_id, until=None, lookback_seconds: int = 0,
               ts_col: str = "created_at", id_col: str = "id") -> DataFrame:
    """Rows after a high-water mark ``(ts, id)``, optionally up to ``until``.

    The mark is tie-safe: rows sharing the mark's timestamp with a larger id
    are not lost.  ``lookback_seconds`` re-reads a window before the mark
    (late commits); repeats are removed downstream by key.
    """
    ts, key = F.col(ts_col), F.col(id_col)
    m_ts = _ts(mark_ts)
    if lookback_seconds:
        cond = ts > m_ts - F.make_dt_interval(secs=F.lit(lookback_seconds))
    else:
        cond = (ts > m_ts) | ((ts == m_ts) & (key.isNotNull() if mark_id is None else key > F.lit(mark_id)))
    out = df.filter(cond)
    if until is not None:
        out = out.filter(ts <= _ts(until))
    return out


def next_mark(increment: DataFrame, ts_col: str = "created_at", id_col: str = "id") -> DataFrame:
    """The new mark: greatest ``(ts, id)`` of an increment, as one row."""
    best = F.max(F.struct(F.col(ts_col).alias("ts"), F.col(id_col).alias("id")))
    return increment.agg(best.alias("m")).select("m.ts", "m.id")


class Poller:
    """Incremental reads with a stored high-water mark; every row is delivered once.

    A poll reads the rows after the stored mark, and again those of the last
    ``lookback_seconds`` before it, as late commits may have come since; rows that an earlier
    poll delivered are left out by key.  The increment is written first, under the next
    number, then the mark: a poll that fails in between is repeated into the same folder.
    """

    def __init__(self, spark: SparkSession, root: str, lookback_seconds: int = 0,
                 ts_col: str = "created_at", id_col: str = "id"):
        self.spark, self.root, self.lookback = spark, root.rstrip("/"), lookback_seconds
        self.ts_col, self.id_col = ts_col, id_col

    def mark(self):
        """The newest mark (``seq``, ``ts``, ``id``), or None before the first poll."""
        if not path_exists(self.spark, f"{self.root}/mark"):
            return None
        return self.spark.read.parquet(f"{self.root}/mark").orderBy(F.col("seq").desc()).first()

    def poll(self, df: DataFrame, until=None) -> DataFrame:
        """Deliver the next increment; returns its rows as written.  Ids may be of any type; a NULL id is the smallest."""
        m = self.mark()
        new = df if m is None else read_since(df, m["ts"], m["id"], None, self.lookback, self.ts_col, self.id_col)
        if until is not None:
            new = new.filter(F.col(self.ts_col) <= _ts(until))
        if m is not None and self.lookback:
            since = F.lit(m["ts"]) - F.make_dt_interval(secs=F.lit(self.lookback))
            known = self.delivered().filter(F.col(self.ts_col) > since)
            known = known.select(F.col(self.id_col).alias("_id"), F.col(self.ts_col).alias("_ts"))
            # a row without an id is known by its time
            same = F.col(self.id_col).eqNullSafe(F.col("_id")) & (F.col("_id").isNotNull() | (F.col(self.ts_col) == F.col("_ts")))
            new = new.join(known, same, "left_anti").select(*df.columns)
        seq = m["seq"] + 1 if m is not None else 1
        path = f"{self.root}/delivered/seq={seq}"
        new.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        top = next_mark(out, self.ts_col, self.id_col).first()
        place = lambda r: (r["ts"], r["id"] is not None, r["id"])
        if m is not None and (top["ts"] is None or place(top)[:2] < place(m)[:2] or place(top) < place(m)):
            top = m
        if top["ts"] is not None:
            types = {c: df.schema[c].dataType for c in (self.ts_col, self.id_col)}
            schema = StructType([StructField("seq", LongType()), StructField("ts", types[self.ts_col]), StructField("id", types[self.id_col])])
            self.spark.createDataFrame([(seq, top["ts"], top["id"])], schema).write.mode("append").parquet(f"{self.root}/mark")
        return out

    def delivered(self) -> DataFrame:
        """All rows delivered so far (with their poll's number ``seq``)."""
        return self.spark.read.parquet(f"{self.root}/delivered")


def with_date_partitions(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Add zero-padded string partition columns year / month / day."""
    return df.withColumns({
        "year": F.date_format(col, "yyyy"),
        "month": F.date_format(col, "MM"),
        "day": F.date_format(col, "dd"),
    })


def export_run(df: DataFrame, path: str, run_date: str, fmt: str = "parquet") -> None:
    """Export a whole table under the date of the run; a second run of that date replaces it."""
    y, m, d = run_date.split("-")
    df.write.mode("overwrite").format(fmt).save(f"{path}/year={y}/month={m}/day={d}")


#: Bytes of input (by the plan's estimate, which is far too high above joins) a writer of day folders takes, and most writers.
WRITER_BYTES, MAX_WRITERS = 128 << 20, 1 << 14


def dealt_by_day(df: DataFrame, day: Column) -> DataFrame:
    """Rows in runs of days: a task writes few days, one after another, and a large or hot day
    is split over several by the rows' hash.  The count of tasks is explicit, as AQE would put a
    small table into one writer that opens every folder by itself."""
    spark = df.sparkSession
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism,
            min(-(-size // WRITER_BYTES), MAX_WRITERS))
    return df.repartitionByRange(n, day, F.xxhash64(*df.columns)).sortWithinPartitions(day)


def export_partition(df: DataFrame, path: str, start=None, end=None, col: str = "created_at",
                     fmt: str = "parquet") -> bool:
    """Export ``[start, end)`` (or everything) to ``path/year=/month=/day=``.

    Dynamic overwrite replaces only the days present in the slice; an empty slice writes nothing.
    Returns whether anything was written.
    """
    part = df if start is None else read_range(df, start, end, col)
    if part.isEmpty():
        return False
    (dealt_by_day(with_date_partitions(part, col), F.to_date(col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .format(fmt).save(path))
    return True


def read_partitions(spark: SparkSession, path: str, start_day: str | None = None,
                    end_day: str | None = None) -> DataFrame:
    """Read an exported table; a day range becomes partition filters (pruned)."""
    df = spark.read.parquet(path)
    # a predicate on partition columns only: it prunes folders, whatever type
    # the partition values were read as
    key = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    if start_day:
        df = df.filter(key >= F.lit(start_day).cast("date"))
    if end_day:
        df = df.filter(key < F.lit(end_day).cast("date"))
    return df


def export_snapshot(df: DataFrame, root: str, version: str) -> str:
    """Write a full snapshot to ``root/version=<v>``, then publish a new pointer.

    Pointers are numbered and only added, so there is always a whole one to read.
    """
    spark = df.sparkSession
    data = f"{root}/data/version={version}"
    if df.isEmpty():
        return ""
    df.write.mode("overwrite").parquet(data)
    last = _pointer(spark, root)
    (spark.createDataFrame([(last["seq"] + 1 if last else 1, version)], "seq bigint, version string")
     .write.mode("append").json(f"{root}/_current"))
    return data


def _pointer(spark: SparkSession, root: str):
    """The newest pointer (``seq``, ``version``), or None."""
    if not path_exists(spark, f"{root}/_current"):
        return None
    return spark.read.schema("seq bigint, version string").json(f"{root}/_current").orderBy(F.col("seq").desc()).first()


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Read the snapshot the pointer names (one tiny row read on the driver)."""
    return spark.read.parquet(f"{root}/data/version={_pointer(spark, root)['version']}")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str | list[str],
                     order: list[str] | None = None) -> DataFrame:
    """``existing`` plus the incoming rows whose key is new; of several the first in ``order`` wins.

    ``order`` names columns of ``incoming`` (default: all its columns), so the winner does not
    depend on the partitioning.  Existing rows are never changed; a NULL key is one key.  Both
    steps are partitioned on the key; nothing is collected.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.struct(*(order or []), *incoming.columns)
    new = incoming.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(F.struct(*incoming.columns), rank).alias("_row"))
    old = existing.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_k{i}").eqNullSafe(F.col(f"_e{i}"))
    new = new.join(old, same, "left_anti").select("_row.*")
    return existing.unionByName(new.select(*existing.columns))


def write_table(df: DataFrame, path: str, sort_by: list | None = None, small: bool = False,
                fmt: str = "parquet") -> None:
    """Create-or-replace a table (``CREATE OR REPLACE TABLE ... AS SELECT``).

    Row order in a table has no meaning; ``small=True`` writes a bounded result
    (a report, a pre-aggregate of a few thousand rows) as one sorted file for
    convenience.  Readers apply their own ORDER BY.
    """
    out = df
    if small:
        out = out.repartition(1)  # a stage of its own: what makes the rows stays parallel
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(path)


def write_clustered(df: DataFrame, path: str, by: list[str], descending: tuple[str, ...] = (), group_bytes: int = 16 << 20) -> None:
    """Create or replace a table stored in the order of ``by`` (``ORDER BY`` inside CREATE TABLE AS).

    Rows are range-partitioned and sorted, so that files and row groups hold narrow ranges and a
    range predicate skips the others by their statistics.  ``group_bytes``: size of a row group.
    """
    order = [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in by]
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("parquet.block.size", group_bytes).parquet(path))


#: The ORDER BY in which the pre-aggregates are stored (descending columns marked).
STAR_ORDER = {"agg_daily_revenue": (["date_key"], ("date_key",)), "agg_merchant_performance": (["total_volume"], ("total_volume",)),
              "agg_fraud_by_country": (["fraud_rate_pct"], ("fraud_rate_pct",))}


def write_star(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Create or replace the star schema: the fact in a folder a day, the aggregates in their order.

    Replacing is static: days that the new fact lacks are gone, whatever the session's overwrite mode.
    """
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        if name == "fact_transactions":
            (dealt_by_day(df, F.col("date_key")).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("date_key").parquet(path))
        elif name in STAR_ORDER:
            write_clustered(df, path, *STAR_ORDER[name])
        else:
            write_table(df, path)
        paths[name] = path
    return paths


def newest_day(spark: SparkSession, path: str, col: str = "date_key") -> str | None:
    """The newest value of a day partition, from the folder names alone."""
    days = [n.split("=", 1)[1] for n in children(spark, path) if re.fullmatch(rf"{col}=\d{{4}}-\d{{2}}-\d{{2}}", n)]
    return max(days, default=None)


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Store a table bucketed and sorted by ``key`` and read it back through the catalog.

    Tables bucketed alike join on the key without a shuffle.  The catalog entry belongs to the
    session; the files stay below ``path``.
    """
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)
