"""A store bucketed on the lookup's join key, so that enrichment never moves counters.

Above the broadcast bound a join with the lookup shuffles every counter row each time
the lookup changes. Here counters are dealt once, when they are written, into buckets by
(OSS, cell); a join then exchanges the lookup alone, into the same number of buckets.

A bucket is read by one task, and neither AQE nor more machines can split it, so
keys with more than ``hot_rows`` rows in a batch are dealt under several salted keys, and
the lookup's row is repeated for each of them. Records without an OSS or a cell match
nothing and are dealt by the hash of the row. How many salts a key has
lies beside the store, a part for each batch; a key's largest number counts.

Bucketing is known to Spark by table only, so :func:`open_copartitioned` declares a table
over the folder in the present session from the layout that the folder holds.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.functions.scalars import UNASSIGNED, oss_key
from cellkpi.operators.enrich import prepare_lookup
from cellkpi.operators.joins import composite_key, small_side
from cellkpi.session import scratch_path, write_text_file

KEY = "_deal_key"
HOT_DIR, LAYOUT_FILE = "_hot", "_layout/layout.json"      # hidden from reads of the store
HOT_ROWS = 2_000_000


def _salted(key: Column, salt: Column) -> Column:
    # a key starts with the length of its OSS, so the text of a row without one is no key
    return F.concat(F.coalesce(key, F.lit("-")), F.lit("#"), salt.cast("string"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _layout(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/{LAYOUT_FILE}", wholetext=True).first()[0])


def _declare(spark: SparkSession, path: str) -> tuple[str, dict]:
    layout = _layout(spark, path)
    name = "copartitioned_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"DROP TABLE IF EXISTS {name}")                    # external: its files stay
    fields = T.StructType.fromJson(layout["schema"]).fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parted = f"PARTITIONED BY ({', '.join(layout['partition_by'])})" if layout["partition_by"] else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') {parted} "
              f"CLUSTERED BY ({KEY}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    if layout["partition_by"]:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name, layout


def write_copartitioned(rows: DataFrame, path: str, batch: str, *, oss_col: str, cell_col: str, buckets: int = 512,
                        partition_by: Sequence[str] = ("pk_ft", "pk_date"), hot_rows: int = HOT_ROWS) -> None:
    """Add a batch. The first one fixes key columns, columns, buckets and folders; later
    ones need the same columns. ``batch`` names its part of the list of hot keys. Rows show when
    the write's job commits; a batch written twice is in the store twice."""
    spark, path = rows.sparkSession, path.rstrip("/")
    if KEY in rows.columns:
        raise ValueError(f"a counter may not be called {KEY}")
    key = composite_key(oss_key(oss_col), F.col(f"`{cell_col}`").cast("string"))
    salts = F.ceil(F.col("n") / hot_rows).cast("int")
    many = rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    many.select("_key", salts.alias("_salts")).write.mode("overwrite").parquet(f"{path}/{HOT_DIR}/batch={batch}")
    hot = spark.read.parquet(f"{path}/{HOT_DIR}/batch={batch}")
    keyed = rows.withColumn("_key", key)
    joined = keyed.join(small_side(hot), keyed["_key"].eqNullSafe(hot["_key"]), "left").drop(hot["_key"])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if not isinstance(rows.schema[c].dataType, T.MapType)])
    salt = F.pmod(row_hash, F.coalesce("_salts", F.lit(1))).cast("int")
    dealt = joined.withColumn(KEY, _salted(F.col("_key"), salt)).drop("_key", "_salts")
    parts = list(partition_by)
    dealt = dealt.select(*[f"`{c}`" for c in dealt.columns if c not in parts], *parts)
    if not _exists(spark, f"{path}/{LAYOUT_FILE}"):
        write_text_file(spark, f"{path}/{LAYOUT_FILE}", json.dumps(dict(
            schema=json.loads(dealt.schema.json()), buckets=buckets, partition_by=parts, oss_col=oss_col, cell_col=cell_col)))
    name, layout = _declare(spark, path)
    if [layout["oss_col"], layout["cell_col"]] != [oss_col, cell_col]:
        raise ValueError("the store is dealt by other key columns")
    want = [f.name for f in T.StructType.fromJson(layout["schema"]).fields]
    spread = dealt.select(*[f"`{c}`" for c in want]).repartition(layout["buckets"], KEY).sortWithinPartitions(*layout["partition_by"], KEY)
    spread.write.mode("append").insertInto(name)


def open_copartitioned(spark: SparkSession, path: str) -> DataFrame:
    """The store as a bucketed table, with its dealing key as the column ``KEY``."""
    return spark.table(_declare(spark, path.rstrip("/"))[0])


def enrich_copartitioned(spark: SparkSession, path: str, lookup: DataFrame, *, lookup_cell_col: str, attrs: Mapping[str, str],
                         where: Column | None = None, dedup_lookup: bool = True) -> DataFrame:
    """Counters of the store (those of ``where``) with the lookup's attributes, as
    ``operators.enrich.enrich`` gives them: unmatched ones are 'unassigned'. The counters are
    joined where they lie; only the lookup, with a row a salt of a hot key, is exchanged."""
    path = path.rstrip("/")
    counters, layout = open_copartitioned(spark, path), _layout(spark, path)
    if where is not None:
        counters = counters.where(where)
    hot = spark.read.parquet(f"{path}/{HOT_DIR}").groupBy("_key").agg(F.max("_salts").alias("_salts"))
    kept = scratch_path(spark, "hot-keys")
    hot.write.parquet(kept)
    lk = prepare_lookup(lookup, lookup_cell_col, attrs, dedup=dedup_lookup)
    lk = lk.withColumn("_key", composite_key(F.col("_lkey_oss"), F.col("_lkey_cell"))).where("_key IS NOT NULL")
    lk = lk.join(small_side(spark.read.parquet(kept)), "_key", "left")
    lk = lk.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    lk = lk.select(_salted(F.col("_key"), F.col("_salt")).alias("_lkey"), *[f"_lk_{a}" for a in dict.fromkeys(attrs.values())])
    lk = lk.repartition(layout["buckets"], "_lkey")
    out = [counters[c] for c in counters.columns if c != KEY and c not in attrs]
    return counters.join(lk.hint("merge"), counters[KEY] == lk["_lkey"], "left").select(
        *out, *[F.coalesce(lk[f"_lk_{src}"], F.lit(UNASSIGNED)).alias(name) for name, src in attrs.items()])
