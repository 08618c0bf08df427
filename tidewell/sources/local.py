"""Tables of a folder of Parquet, read natively, and the splits of a query over them."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..plans.predicates import quoted

SPLIT_BYTES = 128 << 20

#: Splits that are planned for a table, besides one for each of its files at least. Parquet can't be entered at a row, so a
#: split's query reads its file from the start, but for row groups that a key rules out: ever more splits of one file would
#: read it ever more often.
MOST_SPLITS = 16


def tables(spark: SparkSession, folder: str) -> list[str]:
    """The names of the tables in ``folder``, wherever Spark can read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(s.getPath().getName()[: -len(".parquet")] for s in found if s.getPath().getName().endswith(".parquet"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """``sql`` over the folder's tables, which become temporary views of the session."""
    for name in tables(spark, folder):
        table(spark, folder, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def size_bytes(df: DataFrame) -> int:
    """What Spark's statistics say of the files read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def split_count(df: DataFrame, split_size: int | None) -> int:
    return max(1, math.ceil(size_bytes(df) / (split_size if split_size and split_size > 0 else SPLIT_BYTES)))


def split_rows(df: DataFrame, splits: int) -> int:
    """Rows of a split, so that there are about ``splits``: counting reads the files' footers alone."""
    return max(1, math.ceil(df.count() / splits))


def with_split(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with ``split_id``: ranges of ``rows`` rows of each file, so that each row is in one split.

    All splits are read in one pass: skipping rows by number saves no reading, so a scan for each would
    read everything each time.
    """
    return df.select("*", F.concat_ws("#", "_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows).cast("string")).alias("split_id"))


def split_queries(df: DataFrame, most: int) -> list[str]:
    """A query for each split of a table: ranges of rows of its files, some ``most`` or one for each file.

    Where rows are stored more or less by their first column of whole numbers, a range's query also says between which of
    its values the rows are, by which Parquet skips row groups; Spark makes the row numbers of the others alone.
    """
    path = "_metadata.file_path"
    first = df.select(path).head()
    if first is None:
        return []
    file = (F.lit(first[0]) if len(df.inputFiles()) == 1 else F.col(path)).alias("file")
    sizes = {r.file: r.n for r in df.groupBy(file).agg(F.count("*").alias("n")).collect()}
    rows = max(1, math.ceil(sum(sizes.values()) / most))
    large = [f for f, n in sizes.items() if n > rows]  # fewer than ``most``
    key = next((quoted(f.name, "`") for f in df.schema if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType))), None)
    between: dict[tuple[str, int], str] = {}
    if key and large:
        part = F.expr(f"_metadata.row_index div {rows}").alias("k")
        aggs = F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.isnull(key)).alias("nulls")
        found = df.where(F.col(path).isin(large)).groupBy(file, part).agg(*aggs).where("nulls = 0").collect()
        ends = {f: [x for r in found if r.file == f for x in (r.low, r.high)] for f in large}
        for r in found:
            if 2 * (r.high - r.low) < max(ends[r.file]) - min(ends[r.file]):  # else most row groups would be read all the same
                between[r.file, r.k] = f" AND {key} BETWEEN {r.low} AND {r.high}"
    out = []
    for f, n in sizes.items():
        own = f"SELECT * FROM parquet.{quoted(f, '`')}"
        ranges = [f" WHERE _metadata.row_index >= {k * rows} AND _metadata.row_index < {(k + 1) * rows}{between.get((f, k), '')}" for k in range(math.ceil(n / rows))]
        out += [own + r for r in ranges] if len(ranges) > 1 else [own]
    return out


def plan_splits(spark: SparkSession, folder: str, text: str, df: DataFrame, split_size: int | None, whole_table: bool) -> DataFrame:
    """The splits as rows, each with a query of its own, which ``spark.sql`` runs as it is.

    A table's are ranges of rows of its files, larger than ``split_size`` where there would be more than MOST_SPLITS. Any
    other query is one split: its rows have no place in a file.
    """
    size = int(split_size or SPLIT_BYTES)
    producer = hashlib.md5(f"{folder}\0{text}\0{size}".encode()).hexdigest()
    found = split_queries(df, min(split_count(df, split_size), MOST_SPLITS)) if whole_table else [text]
    out = spark.createDataFrame([(q,) for q in found], "query string")
    digest = F.md5(F.col("query"))
    return out.select(
        F.array(F.lit(folder)).alias("endpoints"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("query_id"), "query",
        F.lit(producer).alias("producer_id"), F.lit(size).cast("long").alias("split_size"), digest.alias("query_checksum"),
    )
