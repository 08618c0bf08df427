"""What the operators share: tables, the shared folder, and a few SQL pieces."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and tab to carriage return, of ASCII alone.
SPACE = r"[ \t-\r]+"

#: Rows of a batch for Python.
BATCH_ROWS = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor sees.

    Only where that is unset (a local session, as in tests) one is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidewell-{uuid.uuid4().hex}"


#: Folders of the tables that ``written`` made and ``drop`` hasn't removed.
WRITTEN: list[str] = []


def written(df: DataFrame, narrow: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts the lineage and outlives a lost executor.

    ``narrow``: the rows of a shuffle that are a few numbers each; a dozen of its partitions share a file.
    """
    path, spark = shared_dir(df.sparkSession), df.sparkSession
    if narrow:
        files = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 12)
        df.coalesce(files).write.parquet(path)
    else:
        df.write.parquet(path)
    WRITTEN.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


#: By folder, the names of the tables that ``bucketed`` made.
BUCKETED: dict[str, str] = {}


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``: joins on it move the other side's rows alone.

    The session's catalog holds which buckets there are, the shared folder the rows.
    """
    path, spark, name = shared_dir(df.sparkSession), df.sparkSession, f"tidewell_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name, format="parquet")
    WRITTEN.append(path)
    BUCKETED[path] = name
    out = spark.table(name)
    out.written_path = path
    return out


#: Rows of 64 bits that ``apart_by_bits`` broadcasts, at most.
BIT_ROWS = 1 << 18


def apart_by_bits(df: DataFrame, key: str, some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` is surely no value of ``some`` (a table of one column), and those whose may be one.

    The second are all that are and others by chance, so that only they need move for a join with ``some``. Each value sets
    one bit by its hash, in a table of BIT_ROWS rows at most, which is broadcast: the fuller it is, the more rows may be.
    """
    at, own = (f"bits_{uuid.uuid4().hex}" for _ in range(2))  # names of no column of df
    place, bit = f"CAST(pmod(xxhash64(`{{0}}`), {BIT_ROWS}) AS INT)", f"CAST(pmod(xxhash64(`{{0}}`) DIV {BIT_ROWS}, 64) AS INT)"
    name = some.columns[0]
    bits = some.where(f"`{name}` IS NOT NULL").groupBy(F.expr(place.format(name)).alias(at)).agg(F.expr(f"bit_or(shiftleft(1L, {bit.format(name)}))").alias(own))
    marked = df.join(F.broadcast(written(bits, True)), F.expr(place.format(key)) == F.col(at), "left")
    may = F.coalesce(F.expr(f"getbit({own}, {bit.format(key)}) = 1") & F.col(f"`{key}`").isNotNull(), F.lit(False))
    return tuple(marked.where(w).select(*(F.col(f"`{c}`") for c in df.columns)) for w in (~may, may))


def done_with(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, once all that reads them is itself written."""
    drop(tables[0].sparkSession, [t.written_path for t in tables])


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables that no DataFrame still in use reads."""
    for p in paths:
        if p in BUCKETED:
            spark.sql(f"DROP TABLE IF EXISTS {BUCKETED.pop(p)}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    WRITTEN[:] = [p for p in WRITTEN if p not in paths]


def settled(df: DataFrame, before: int) -> DataFrame:
    """``df`` written; the tables written since there were ``before`` of them, which it was made from, are removed."""
    out = written(df)
    drop(df.sparkSession, WRITTEN[before:-1])
    return out


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session now sending few whole texts at a time to Python, so that batches of long ones fit."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def rest(spark: SparkSession) -> None:
    """Have the driver and the executors collect their garbage, so that what one stage left there isn't held through the next.

    A heap that has grown stays so until a full collection; then it shrinks to what is in use. The driver's collection also
    lets Spark remove the shuffle files of plans that are gone.
    """
    rest_driver(spark)
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).collect()  # a row for each core


def rest_driver(spark: SparkSession) -> None:
    """Have the driver collect its garbage (the plans of many jobs, and with them their shuffle files) and give memory back."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    jvm.System.gc()
    give_back()
    # What the JVM freed outside its heap, mostly in compiling generated code, stays with its C library until it is told.
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        arguments = gateway.new_array(jvm.java.lang.Object, 4)
        arguments[0], arguments[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(server, arguments)
    except (Py4JError, StopIteration):  # a JVM without that command
        pass


def mapped(df: DataFrame, function: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """``df.mapInArrow(function, schema)``, whose workers give back the memory that they no longer use when a task ends."""

    def trimmed(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(trimmed, schema)


def give_back() -> None:
    """Free memory of this process to the system, where its C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def let(value: Column, body) -> Column:
    """``body(x)`` with x bound to ``value``, computed once for each row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of ``text``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; no other letter changes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sql_list(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
