"""Month shards with day folders and with numbers stored as different types."""

from datetime import date

from pyspark.sql import functions as F

from adloom.sinks.load import stage
from adloom.sources import shards
from adloom.sources.shards import alike, read_shard_files

SHARD = "co_table_platform_mkt_main_campaign_m012024"


def test_types_and_layouts_of_shards(spark, tmp_path):
    def put(shard, kind, day=None, rows=((1, "c"),), drop=(), mode="append"):
        df = spark.createDataFrame(list(rows), "result int, campaign_id string")
        df = df.withColumns({"result": F.col("result").cast(kind), "clicks": F.lit(1).cast("bigint"), "extra": F.lit("x")})
        df = df if day else df.withColumn("date", F.lit("2024-01-09").cast("timestamp"))
        df.drop(*drop).coalesce(1).write.mode(mode).parquet(str(tmp_path / shard / (f"date={day}" if day else "")))

    put(SHARD, "bigint", "2024-01-01")
    put(SHARD, "double", "2024-01-02", rows=[(2, "c"), (None, "d")])
    put(SHARD, "bigint", "2024-01-03", rows=[(3, "c")], drop=["clicks"])
    other = SHARD.replace("main", "alt")
    put(other, "bigint", rows=[(4, "e")])
    put(other, "double", rows=[(5, "e")])
    (tmp_path / SHARD.replace("main", "none")).mkdir()
    assert len(alike(spark, [str(tmp_path / other)])) == 2

    def found(**bounds):
        rows = read_shard_files(spark, str(tmp_path), "co_table_platform_", "campaign", **bounds)
        return sorted((r["account"], str(r["date"]), r["result"], r["clicks"]) for r in rows.collect() if r["result"])

    assert found() == [
        ("alt", "2024-01-09", 4.0, 1), ("alt", "2024-01-09", 5.0, 1),
        ("main", "2024-01-01", 1.0, 1), ("main", "2024-01-02", 2.0, 1), ("main", "2024-01-03", 3.0, None),
    ]
    assert found(lo=date(2024, 1, 2), hi=date(2024, 1, 3)) == found()[3:]
    assert found(lo=date(2024, 2, 1)) == []


def test_footers_are_read_once_per_group(spark, tmp_path, monkeypatch):
    """Two files that disagree take three looks: the shard, then each file."""
    for kind in ("bigint", "double"):
        row = spark.range(1).select(F.col("id").cast(kind).alias("result"))
        row.coalesce(1).write.mode("append").parquet(str(tmp_path / SHARD))
    looks = []
    stored = shards._stored_schema
    monkeypatch.setattr(shards, "_stored_schema", lambda spark, paths: looks.append(paths) or stored(spark, paths))
    groups = alike(spark, [str(tmp_path / SHARD)])
    assert sorted(s["result"].dataType.simpleString() for s, _ in groups) == ["bigint", "double"]
    assert len(looks) == 3


def test_staged_partitions_need_no_further_shuffle(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 2 as odd", "concat('s', id % 7) as shard")
    staged = stage(rows, partition=("odd", "shard"), path=str(tmp_path / "rows"))
    assert staged.schema.names == rows.columns
    assert sorted(tuple(r) for r in staged.collect()) == sorted(tuple(r) for r in rows.collect())
    # each folder is one file, as rows were gathered, and half of the folders are read
    assert len(staged.inputFiles()) == 14
    half = staged.where("odd = 1").drop("odd")
    files = {r[0] for r in half.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 7 and all("/odd=1/" in f for f in files)
    half.write.partitionBy("shard").parquet(str(tmp_path / "half"))
    assert len(list((tmp_path / "half").rglob("*.parquet"))) <= 7 * spark.sparkContext.defaultParallelism
    assert "Exchange" not in half._jdf.queryExecution().executedPlan().toString()
