"""CSV export: one file per key, merged hours newest first, empty keys absent."""

import glob
import os

from cellkpi.functions.scalars import export_key, run_id, run_uuid
from cellkpi.sources.export import export_csv, hour_merge_order, read_export
from pyspark.sql import functions as F


def _report(spark):
    return spark.createDataFrame(
        [("2024-01-05", "NEW YORK", "07", "lte_cell_avail", "c1", 1.0),
         ("2024-01-05", "NEW YORK", "09", "lte_cell_avail", "c1", 2.0),
         ("2024-01-05", "NEW YORK", "08", "lte_cell_avail", "c2", 3.0),
         ("2024-01-05", "LONG ISLAND", "09", "lte_cell_avail", "c3", 4.0)],
        "pk_date string, pk_market string, pk_hr string, pk_ft string, cell string, v double")


def test_export_key_format(spark):
    df = _report(spark).withColumn("suffix", F.lit("NYC"))
    k = df.select(export_key("kpiagg", F.col("pk_date"), F.col("suffix"), F.col("pk_market"),
                             hour=F.col("pk_hr"), family=F.col("pk_ft")).alias("k")).first().k
    assert k == "kpiagg_2024-01-05_nyc_NEW-YORK_07_lte-cell-avail"
    r = df.select(run_id(F.lit("7"), run_uuid("run", F.col("pk_market"))).alias("r")).first().r
    assert r.startswith("07-") and len(r) == 3 + 36


def test_one_file_per_key(spark, tmp):
    df = _report(spark).withColumn("export_key", F.concat_ws("_", "pk_date", "pk_market", "pk_hr"))
    p = export_csv(df, os.path.join(tmp, "out"))
    dirs = sorted(os.path.basename(d) for d in glob.glob(f"{p}/export_key=*"))
    assert len(dirs) == 4
    for d in glob.glob(f"{p}/export_key=*"):
        assert len(glob.glob(f"{d}/*.csv")) == 1
    back = read_export(spark, p)
    assert back.count() == 4 and "cell" in back.columns


def test_hour_merge_newest_first(spark, tmp):
    p = export_csv(_report(spark), os.path.join(tmp, "merged"), keys=("pk_date", "pk_market", "pk_ft"),
                   order=hour_merge_order())
    files = glob.glob(f"{p}/pk_date=2024-01-05/pk_market=NEW YORK/pk_ft=lte_cell_avail/*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0].startswith("pk_hr") and [ln.split(",")[0] for ln in lines[1:]] == ["09", "08", "07"]
