"""Co-partitioned storage: tables bucketed and sorted on the key they are joined by.

A bucketed table is shuffled once, when it is stored, and then joined and
grouped on its key without an exchange. The store is plain Parquet under one
root plus a catalog entry that names the buckets, so another session
(:func:`open_buckets`) reads the same files.

A key that holds a large share of a table would fill one bucket, and
no run-time skew split applies to a bucketed scan. Such tables are stored without
buckets (:func:`store_family`): their joins shuffle, and AQE splits the hot
partition. The cost tables have a layout that keeps buckets even then
(``operators.cost_layout``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_dropped

#: Key of each large table, as its joins use it. Tables not named here are dimensions.
BUCKET_KEYS: dict[str, list[str]] = {
    "tbl_airwaybill": ["fk_orderno"], "tbl_airwaybilldesc": ["fk_airwaybillno"], "tbl_shipmentapar": ["fk_orderno", "seqno"],
    "tbl_shipmentheader": ["pk_orderno"], "tbl_shipmentdesc": ["fk_orderno"],
    "jobshipment": ["js_pk"], "jobheader": ["jh_pk", "jh_gc"], "jobcharge": ["jr_jh", "jr_gc"],
    "jobconsol": ["jk_pk"], "jobconshiplink": ["jn_jk"], "jobconsoltransport": ["jw_parentguid"],
    "acctransactionlines": ["al_pk", "al_gc"], "acctransactionheader": ["ah_pk", "ah_gc"],
}

#: Stored bytes of the source tables that ask for one more bucket.
BUCKET_BYTES = 8 << 20

#: A key is hot when it holds more than this many buckets' even share of the rows.
HOT_BUCKETS = 2.0


def bucket_count(spark: SparkSession, stored_bytes: int = 0) -> int:
    """Buckets that joins with shuffled sides keep: the session's shuffle partitions
    (on a default session, whose 200 suit no stored size, twice the parallelism), and more
    where ``stored_bytes`` of source tables ask for it: the sorts of one bucket stay in memory."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(n if n != 200 else 2 * spark.sparkContext.defaultParallelism, -(-stored_bytes // BUCKET_BYTES))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been completed."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def _table_name(path: str) -> str:
    return "cargofeed_" + hashlib.sha1(path.encode()).hexdigest()[:20]


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` under ``path`` in ``buckets`` files sorted by ``keys`` and read it back.

    One hash shuffle; the rows of a bucket come from one task, so there is one file a bucket.
    """
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    with shuffles_dropped(df.sparkSession):
        (dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet")
         .mode("overwrite").saveAsTable(_table_name(path)))
    return df.sparkSession.table(_table_name(path))


def open_buckets(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """Read a table of :func:`write_buckets`; the catalog entry is made where the session lacks it."""
    name, cols = _table_name(path), ", ".join(f"`{k}`" for k in keys)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY ({cols}) SORTED BY ({cols}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def heavy_bins(df: DataFrame, columns: Sequence[Column], bins: int, more_than: float) -> DataFrame:
    """``(__column, __bin)``: hash bins that hold more than ``more_than`` rows, by each of ``columns`` (numbered from 0).

    One scan with map-side counts. A value that occurs in more than ``more_than`` rows lies in such a bin, so where
    there is none, no value does; the rows of those that there are remain to be counted by value.
    """
    at = F.array(*[F.struct(F.lit(i).alias("c"), F.pmod(F.xxhash64(c), F.lit(bins)).alias("b")) for i, c in enumerate(columns)])
    return (df.select(F.explode(at).alias("__at")).groupBy("__at.c", "__at.b").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > F.lit(float(more_than))).select(F.col("c").alias("__column"), F.col("b").alias("__bin")))


#: Hash bins of one share of the rows.
BINS = 4


def is_hot(df: DataFrame, keys: Sequence[str], buckets: int, hot: float = HOT_BUCKETS) -> bool:
    """Whether one value of ``keys`` (NULL included) holds more than ``hot`` even shares of the rows.

    Counts of hash bins decide where none holds so many; else the values in those that do are counted.
    """
    share = hot / buckets
    if share >= 1:
        return False
    most = share * df.count()
    bins = BINS * buckets
    found = [r["__bin"] for r in heavy_bins(df, [F.struct(*keys)], bins, most).collect()]  # < buckets / hot
    if not found:
        return False
    inside = df.filter(F.pmod(F.xxhash64(F.struct(*keys)), F.lit(bins)).isin(found))
    return not inside.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > F.lit(most)).isEmpty()


def store_family(tables: Mapping[str, DataFrame], root: str, buckets: int, plain_files: int | None = None) -> dict[str, DataFrame]:
    """Store (or open, where already stored) every table under ``root``, bucketed where its key allows it."""
    out = {}
    for name, df in tables.items():
        spark, keys = df.sparkSession, BUCKET_KEYS.get(name)
        bucketed, plain = f"{root}/buckets-{buckets}/{name}", f"{root}/{name}"
        if keys and exists(spark, bucketed):
            out[name] = open_buckets(spark, bucketed, df.schema, keys, buckets)
        elif exists(spark, plain):
            out[name] = spark.read.schema(df.schema).parquet(plain)
        elif keys and not is_hot(df, keys, buckets):
            out[name] = write_buckets(df, bucketed, keys, buckets)
        else:
            with shuffles_dropped(spark):
                df.repartition(plain_files or spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(plain)
            out[name] = spark.read.schema(df.schema).parquet(plain)
    return out
