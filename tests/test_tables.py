"""Joins, upserts, sinks and sources on small frames."""

import re
from datetime import date
from hashlib import sha256
from itertools import product

import pytest
from pyspark.sql import functions as F

from adloom.operators import dimensions as joins
from adloom.operators.dimensions import Dimension, all_small, grid_sides, join_dimensions, measured
from adloom.operators.sizes import broadcast_if_small, measured_bytes
from adloom.operators.upsert import key_set, matching_count, matching_keys, upsert
from adloom.operators.worklists import (
    coverage,
    distinct_ids,
    failed_ids,
    fetched,
    fetched_in_attempts,
    missing_days,
)
from adloom.schemas import TABLES
from adloom.session import work_folder
from adloom.sinks.load import Audit, _near, laid_out, load, load_table, register_tables, stage
from adloom.sources.shards import discover_shards, read_shard_files, union_shards
from adloom.sources.tables import read_path, read_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Dimensions -----------------------------------------------------------------------

FACTS = [(a, c, i) for i, (a, c) in enumerate(product(["1", "2", None], ["x", "y", None]))] * 2
DIM_A = [("1", "one"), ("1", "uno"), ("2", "two"), (None, "none"), ("9", "nine")]
DIM_A2 = [("1", "I"), ("3", "III"), (None, "-"), ("2", "II"), ("2", "ii")]
DIM_C = [("x", "ex"), ("x", "iks"), (None, "none")]


def dimensions(spark):
    return measured(
        Dimension(spark.createDataFrame(DIM_A, "a string, name string"), ("a",)),
        Dimension(spark.createDataFrame(DIM_C, "c string, title string"), ("c",)),
        Dimension(spark.createDataFrame(DIM_A2, "a string, roman string"), ("a",)),
    )


def looked_up(key, table):
    """All values of a key, one null where there is none: a left join by brute force."""
    return [v for k, v in table if k == key and key is not None] or [None]


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_every_join_strategy_keeps_all_matches(spark, rows, limit):
    facts = spark.createDataFrame(FACTS, "a string, c string, n int")
    joined = join_dimensions(facts, dimensions(spark), limit)
    expected = [
        (a, c, n, name, title, roman)
        for a, c, n in FACTS
        for name in looked_up(a, DIM_A)
        for title in looked_up(c, DIM_C)
        for roman in looked_up(a, DIM_A2)
    ]
    assert rows(joined, "a", "c", "n", "name", "title", "roman") == sorted(expected, key=repr)


def test_join_with_one_large_dimension(spark, rows):
    facts = spark.createDataFrame(FACTS, "a string, c string, n int")
    by_a, by_c = dimensions(spark)
    assert by_a.size > by_c.size
    mixed = join_dimensions(facts, [by_a, by_c], limit=by_c.size)
    assert rows(mixed) == rows(join_dimensions(facts, [by_a, by_c]))


def test_broadcast_only_within_the_limit(spark):
    facts = spark.createDataFrame(FACTS, "a string, c string, n int")
    dims = dimensions(spark)
    assert all_small(dims) and not all_small(dims, limit=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(join_dimensions(facts, dims)).count("BroadcastHashJoin") == 2
        assert "BroadcastHashJoin" not in plan(join_dimensions(facts, dims, limit=-1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_read_once_and_meet_the_largest_dimension_last(spark):
    facts = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 7).alias("c"), F.col("id").alias("n"))
    by_a = Dimension(spark.range(0, 100, 2).select(F.col("id").alias("a"), F.col("id").alias("wide")), ("a",), 2000)
    by_c = Dimension(spark.range(7).select(F.col("id").alias("c"), F.col("id").alias("narrow")), ("c",), 1000)
    joined = join_dimensions(facts, [by_a, by_c], limit=-1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = joined._jdf.queryExecution().optimizedPlan().toString()
        assert shown.count("Range (0, 100, step=1") == 1 and "Aggregate" not in shown
        last, first = re.findall(r"Join LeftOuter, .*", shown)  # a plan is shown from its end
        assert "_right_a" in last and "_right_c" in first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.where("wide is null").count() == 50 and joined.where("narrow is null").count() == 0


def test_large_dimensions_are_joined_by_one_shuffle_of_the_facts(spark, rows, monkeypatch):
    text = [F.col("id").cast("string"), (F.col("id") % 7).cast("string"), (F.col("id") % 3).cast("string")]
    keys = [F.when(F.col("id") % 5 != n, key).alias(name) for n, (key, name) in enumerate(zip(text, "abc"))]
    facts = spark.range(400).select(*keys, (F.col("id") % 50).alias("n"))
    dims = [
        Dimension(facts.select(name).distinct().withColumn(f"of_{name}", F.upper(name)), (name,), size)
        for name, size in (("a", 3000), ("b", 200), ("c", 100))
    ]
    dims[1] = Dimension(dims[1].frame.unionAll(dims[1].frame), ("b",), 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimensions(facts, dims, limit=-1)
        assert plan(joined).count("shufflepartitionidpassthrough") == 4  # of facts and dimensions
        assert "hashpartitioning(coalesce" not in plan(joined) and plan(joined).count("SortMergeJoin") == 3
        monkeypatch.setattr(joins, "MOST_CELLS", 1)
        one_by_one = join_dimensions(facts, dims, limit=-1)
        assert "passthrough" not in plan(one_by_one)
        names = ("a", "b", "c", "n", "of_a", "of_b", "of_c")
        keyed = [r for r in rows(one_by_one, *names) if None not in r[:3]]
        got = rows(joined, *names)
        assert [r for r in got if None not in r[:3]] == keyed
        # a fact without a key is there too, and matches nothing
        assert all((r[k] is None) == (r[k + 4] is None) for r in got for k in range(3))
        assert len(got) == sum(1 if i % 5 == 1 else 2 for i in range(400))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_grids_cut_the_largest_dimension_most():
    assert grid_sides([100, 100], 200) == [14, 14]
    assert grid_sides([1, 1000], 8) == [1, 8]
    assert grid_sides([5, 5, 5], 1) == [1, 1, 1]


def test_sizes_grow_with_rows_and_text(spark):
    short, long = spark.range(10), spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    sizes = measured_bytes(short, long, short.limit(0), short.union(short))
    assert sizes[1] > 10_000 > sizes[0] > 0 == sizes[2] and sizes[3] == 2 * sizes[0]
    assert "broadcast" in broadcast_if_small(short)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(short, 1)._jdf.queryExecution().logical().toString()


def test_hot_fact_key_is_split(spark):
    """A campaign with a third of the rows: adaptive execution splits its partition."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        facts = spark.range(0, 90_000, 1, 8).select(key.alias("a"), F.col("id").alias("n"))
        names = facts.select("a").distinct().withColumn("name", F.upper("a"))
        dims = [Dimension(names, ("a",), size=1 << 40)]
        joined = join_dimensions(facts, dims)
        joined.write.format("noop").mode("overwrite").save()
        counted = joined.groupBy("name").count()
        assert counted.where("name = 'HOT'").first()["count"] == 30_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in options:
            spark.conf.unset(key)


# Upserts --------------------------------------------------------------------------

OLD = [("1", "a", 1), ("1", "a", 2), ("1", "b", 3), ("2", "a", 4), (None, "a", 5), ("1", None, 6)]
NEW = [("1", "a", 7), ("1", "a", 7), (None, "a", 8), ("3", "c", 9), ("2", None, 10)]
KEYED = "k string, j string, v int"


def by_brute_force(old, new):
    gone = {(k, j) for k, j, _ in new if k is not None and j is not None}
    return sorted([r for r in old if r[:2] not in gone] + new, key=repr)


def test_upsert_deletes_then_appends(spark, rows):
    old, new = (spark.createDataFrame(data, KEYED) for data in (OLD, NEW))
    assert rows(upsert(old, new, ["k", "j"]), "k", "j", "v") == by_brute_force(OLD, NEW)
    assert rows(key_set(new, ["k", "j"]), "k", "j") == [("1", "a"), ("3", "c")]
    assert matching_count(old, new, ["k", "j"]).first()["matched"] == 2
    assert rows(matching_keys(old, new, ["j"])) == [("a",)]


def test_upsert_twice_changes_nothing_without_null_keys(spark, rows):
    old = spark.createDataFrame(OLD, KEYED)
    new = spark.createDataFrame([r for r in NEW if r[0] and r[1]], KEYED)
    once = upsert(old, new, ["k", "j"])
    assert rows(upsert(once, new, ["k", "j"])) == rows(once)


@pytest.mark.parametrize("partition", [[], ["k"], ["v"], ["k", "j"]])
def test_load_upserts_like_the_pure_function(spark, rows, partition):
    """Whole-table rewrite, partition rewrite, key outside the partition, key = partition."""
    path = work_folder(spark, "t")
    old, new = (stage(spark.createDataFrame(data, KEYED)) for data in (OLD, NEW))
    first = load(old, path, "upsert", ["k", "j"], partition, ["j"])
    assert first == Audit(path, "upsert", 6, 0, 6)
    second = load(new, path, "upsert", ["k", "j"], partition, ["j"])
    assert second == Audit(path, "upsert", 5, 2, 5)
    expected = by_brute_force(OLD, NEW)
    assert rows(read_path(spark, path, old.schema), "k", "j", "v") == expected
    load(new, path, "upsert", ["k", "j"], partition, ["j"])
    again = by_brute_force(expected, NEW)
    assert rows(read_path(spark, path, old.schema), "k", "j", "v") == again


def test_load_checks_before_writing(spark):
    path = work_folder(spark, "t")
    df = spark.createDataFrame(OLD, KEYED)
    with pytest.raises(ValueError, match="mode"):
        load(df, path, "merge", ["k"])
    assert read_path(spark, path, df.schema).count() == 0
    load(df.limit(0), path, "upsert", ["k"])
    assert load(df, path, "upsert").rows_written == 6  # the first load needs no keys
    with pytest.raises(ValueError, match="keys"):
        load(df, path, "upsert")
    with pytest.raises(ValueError, match="missing"):
        load(df, path, "upsert", ["missing"])
    assert load(df.limit(0), path, "upsert", ["k"]) == Audit(path, "upsert")
    assert load(df, path, "insert").rows_written == 6
    assert read_path(spark, path, df.schema).count() == 12


def test_only_near_partitions_are_read(spark, rows, tmp_path):
    data = [("a", 1), ("b", 2), ("c", 3), (None, 4)]
    table = spark.createDataFrame(data, "p string, v int")
    load(table, str(tmp_path / "t"), "insert", partition=["p"])
    target = read_path(spark, str(tmp_path / "t"), table.schema)
    near = _near(target, table.where("p in ('b', 'c')"), ["p"])
    assert rows(near, "p", "v") == sorted((r for r in data[1:] if r[0]), key=repr)
    # rows without a partition are near where the new rows have some too
    near = _near(target, table.where("p in ('b', 'c') or p is null"), ["p"])
    assert rows(near, "p", "v") == sorted(data[1:], key=repr)
    assert "PartitionFilters: [(isnull(p" in plan(near)
    assert rows(_near(target, table.where("p is null"), ["p"]), "p", "v") == [(None, 4)]


def fact(account, day, campaign, clicks, shard="main"):
    return (account, campaign, 1, clicks, 0.5, 0.0, "unknown", 0, 0, 2024, "2024-01", "mkt", shard, day)


def fact_frame(spark, *data):
    return spark.createDataFrame(list(data), TABLES["campaign_insights"].schema)


def test_facts_are_replaced_by_day_within_their_shard(spark, rows, tmp_path):
    warehouse = str(tmp_path)
    one, two, three = (date(2024, 1, n) for n in (1, 2, 3))
    load_table(
        fact_frame(
            spark, fact("1", one, "a", 1), fact("1", two, "a", 1), fact("1", two, "b", 1),
            fact("2", two, "a", 1, "other"), fact("1", None, "a", 1),
        ),
        warehouse, "campaign_insights",
    )
    audit = load_table(
        fact_frame(
            spark, fact("1", two, "a", 2), fact("1", two, "a", 2), fact("1", three, "c", 2),
            fact("1", None, "a", 2),
        ),
        warehouse, "campaign_insights",
    )
    assert (audit.rows_in, audit.rows_deleted, audit.rows_written) == (4, 2, 4)
    table = read_table(spark, warehouse, "campaign_insights")
    assert rows(table, "account", "date", "campaign_id", "clicks") == sorted(
        [
            ("main", one, "a", 1), ("main", two, "a", 2), ("main", two, "a", 2),
            ("main", three, "c", 2), ("other", two, "a", 1), ("main", None, "a", 1),
            ("main", None, "a", 2),
        ],
        key=repr,
    )
    day = table.where((F.col("account") == "main") & (F.col("date") == two))
    assert "PartitionFilters: [isnotnull(account" in plan(day)

    assert register_tables(spark, warehouse, "ads_test") == ["campaign_insights"]
    assert register_tables(spark, warehouse, "ads_test") == ["campaign_insights"]
    assert spark.table("ads_test.campaign_insights").count() == 7


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """Most rows on one day: rebalancing splits them over files, sorted inside each."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        days = F.when(F.col("id") % 10 == 0, date(2024, 1, 1)).otherwise(date(2024, 1, 2))
        df = spark.range(0, 40_000, 1, 8).select(
            F.xxhash64("id").cast("string").alias("ad_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("t"), days.alias("date")
        )
        path = str(tmp_path / "hot")
        assert load(df, path, "insert", partition=["date"], cluster=["ad_id"]).rows_written == 40_000
        hot = spark.read.parquet(path).where("date = '2024-01-02'")
        files = [r[0] for r in hot.select(F.input_file_name()).distinct().collect()]
        assert hot.count() == 36_000 and len(files) > 1
        first = [r[0] for r in spark.read.parquet(files[0]).select("ad_id").collect()]
        assert first == sorted(first)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_lookup_of_an_id_reads_few_files(spark, tmp_path):
    """Every file of a split day spans all ids; the filters in them leave out the others."""
    wide = spark.range(0, 160_000, 1, 24).select(
        F.sha2(F.col("id").cast("string"), 256).alias("ad_id"),
        F.col("id").alias("clicks"),
        F.lit(date(2024, 1, 1)).alias("date"),
    )

    def read(path, ad_id):
        found = spark.read.parquet(path).where(F.col("ad_id") == ad_id)
        clicks = [r["clicks"] for r in found.collect()]
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return clicks, scan.metrics().get("numOutputRows").get().value()

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        path, bare = str(tmp_path / "filtered"), str(tmp_path / "bare")
        load(wide, path, "insert", partition=["date"], cluster=["ad_id"])
        laid_out(wide, ["date"], ["ad_id"]).write.partitionBy("date").parquet(bare)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("ad_id").alias("lo"), F.max("ad_id").alias("hi"))
    kept = files.agg(F.count(F.lit(1)), F.max("lo"), F.min("hi")).first()
    assert kept[0] >= 12
    for k in (5, 77_777, 159_999):
        ad_id = sha256(str(k).encode()).hexdigest()
        assert kept[1] < ad_id < kept[2]
        clicks, rows_read = read(path, ad_id)
        assert clicks == [k] and rows_read < 16_000
        assert read(bare, ad_id)[1] == 160_000
    assert read(path, "7" * 64) == ([], 0)


# Work lists -----------------------------------------------------------------------


def test_fetches(spark, rows):
    requested = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    received = spark.createDataFrame(
        [("1", 1, "a"), ("2", 2, "b"), ("2", 3, "late"), ("3", 4, "fourth"), ("9", 1, "other")],
        "id string, attempt int, name string",
    )
    assert rows(fetched_in_attempts(requested, received, ["id"]), "id", "attempt", "name") == sorted(
        [
            ("1", 1, "a"), ("2", 1, None), ("2", 2, "b"),
            *((i, n, None) for i in "34" for n in (1, 2, 3)), ("3", 4, "fourth"),
        ],
        key=repr,
    )
    first = received.where("attempt = 1").drop("attempt")
    assert rows(fetched(requested, first, ["id"]), "id", "name") == [
        ("1", "a"), ("2", None), ("3", None), ("4", None),
    ]
    assert rows(failed_ids(requested, first, ["id"])) == [("2",), ("3",), ("4",)]
    assert tuple(coverage(requested, received, ["id"]).first()) == (4, 3)


def test_distinct_ids_and_missing_days(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(distinct_ids(df, "id")) == [("a",)]
    assert rows(distinct_ids(df, "id", keep_null=True)) == [("a",), (None,)]
    days = spark.createDataFrame([(date(2024, 1, n),) for n in (1, 2, 3)], "date date")
    assert rows(missing_days(days, days.where("date <> '2024-01-02'"), ["date"])) == [
        (date(2024, 1, 2),),
    ]


# Shards ---------------------------------------------------------------------------


def test_shard_names():
    names = [
        "co_table_platform_mkt_main_ad_m012024", "co_table_platform_mkt_main_ad_metadata",
        "co_table_platform_mkt_main_campaign_m012024", "xx_table_platform_mkt_main_ad_m012024",
        "co_table_platform_mkt_main_ad_m0120240",
    ]
    assert discover_shards(names, "co_table_platform_", "ad") == names[:1]
    assert discover_shards(names, "co_table_platform_", "campaign") == names[2:3]


def test_no_shards_give_the_typed_empty_relation(spark, tmp_path):
    for level, width in (("ad", 16), ("campaign", 14)):
        empty = union_shards(spark, "no_such_", level)
        assert empty.count() == 0 and len(empty.columns) == width
        assert read_shard_files(spark, str(tmp_path), "no_such_", level).schema == empty.schema
