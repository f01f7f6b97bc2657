"""Tables by name, versions of marts, counted loads, and runs of landed answers."""

import json
import time
from datetime import date, timedelta
from pathlib import Path

import pytest

from adloom.plans import marts
from adloom.plans.marts import day_steps, write_mart
from adloom.plans.pipelines import Job, run_campaign
from adloom.schemas import TABLES
from adloom.sinks import load as loading
from adloom.sinks.load import load_table
from adloom.sources.landing import ad_creatives, read_accounts, read_entity, read_insights
from adloom.sources.tables import read_table

FIRST = date(2023, 1, 1)


def campaign_rows(spark, days, clicks=1, account="main"):
    names = TABLES["campaign_insights"].schema.names
    rows = [
        tuple(
            {"campaign_id": f"c{i % 3}", "clicks": clicks, "department": "mkt", "account": account, "date": d}.get(n)
            for n in names
        )
        for i, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, TABLES["campaign_insights"].schema)


def files_listed(spark, action):
    counter = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = counter.getCount()
    result = action()
    return counter.getCount() - before, result


@pytest.fixture
def database(spark, request):
    name = f"db_{abs(hash(request.node.name)) % 10**9}"
    yield name
    spark.sql(f"drop database if exists {name} cascade")


def test_a_day_is_found_among_many_without_listing_them(spark, tmp_path, database):
    warehouse = str(tmp_path / "w")
    days = [FIRST + timedelta(n) for n in range(400)]
    load_table(campaign_rows(spark, [*days, None]), warehouse, "campaign_insights", database=database)
    listed, audit = files_listed(
        spark,
        lambda: load_table(campaign_rows(spark, [days[7]], 9), warehouse, "campaign_insights", database=database),
    )
    assert (audit.rows_in, audit.rows_deleted, audit.rows_written) == (1, 1, 1) and listed <= 1
    table = spark.table(f"{database}.campaign_insights")
    listed, clicks = files_listed(spark, lambda: table.where(table["date"] == days[7]).select("clicks").collect())
    assert listed == 1 and [r[0] for r in clicks] == [9]
    assert table.count() == 401 and table.where("date is null").count() == 1
    # a new shard shows in the table at once
    load_table(campaign_rows(spark, days[:2], account="it's"), warehouse, "campaign_insights", database=database)
    assert read_table(spark, warehouse, "campaign_insights", database).where("account <> 'main'").count() == 2


def test_tables_loaded_by_path_are_taken_over(spark, tmp_path, database):
    warehouse = str(tmp_path / "w")
    load_table(campaign_rows(spark, [FIRST]), warehouse, "campaign_insights")
    load_table(campaign_rows(spark, [FIRST + timedelta(1)]), warehouse, "campaign_insights", database=database)
    assert spark.table(f"{database}.campaign_insights").count() == 2


def mart_frame(spark, n, fail=False):
    date_of = "case when id = 3 then cast(raise_error('down') as date) else date '2024-01-01' end" if fail else "date '2024-01-01'"
    return spark.range(n).selectExpr("'a' as account_id", "cast(id as string) as campaign_id", f"{date_of} as date")


@pytest.mark.parametrize("by_name", [True, False])
def test_a_failed_rebuild_leaves_the_mart(spark, tmp_path, database, by_name):
    warehouse, name = str(tmp_path / "w"), database if by_name else None

    def shown():
        if by_name:
            return spark.table(f"{database}.campaign_performance").count()
        return spark.read.parquet(f"{warehouse}/campaign_performance").count()

    write_mart(mart_frame(spark, 5), warehouse, "campaign", name)
    with pytest.raises(Exception, match="down"):
        write_mart(mart_frame(spark, 9, fail=True), warehouse, "campaign", name)
    assert shown() == 5
    write_mart(mart_frame(spark, 2), warehouse, "campaign", name)
    assert shown() == 2
    write_mart(mart_frame(spark, 3), warehouse, "campaign", name)
    assert shown() == 3
    assert len(list((tmp_path / "w").iterdir())) == (2 if by_name else 1)


def days_of(spark, *counts):
    """So many rows on each day from 2024-01-01, the first count without a date."""
    days = [None, *(date(2024, 1, n) for n in range(1, len(counts)))]
    data = [(d, "a", str(i)) for d, n in zip(days, counts) for i in range(n)]
    return spark.createDataFrame(data, "date date, account_id string, campaign_id string")


def test_a_large_mart_is_written_by_runs_of_days(spark, tmp_path, monkeypatch):
    rows = days_of(spark, 2, 3, 4, 1, 5, 2)
    assert day_steps(rows) == [] == day_steps(rows.limit(0))
    monkeypatch.setattr(marts, "STEP_ROWS", 5)
    parts = [rows.where(step) for step in day_steps(rows)]
    assert [part.count() for part in parts] == [5, 5, 5, 2]
    writes, written = [], loading.write
    monkeypatch.setattr(loading, "write", lambda *args: writes.append(written(*args)) or writes[-1])
    assert write_mart(rows, str(tmp_path), "campaign", days=rows) == 17 and writes == [5, 5, 5, 2]
    read = spark.read.parquet(str(tmp_path / "campaign_performance"))
    assert sorted(map(str, read.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    monkeypatch.setattr(marts, "MOST_STEPS", 2)
    assert [rows.where(step).count() for step in day_steps(rows)] == [9, 8]
    assert [n.name for n in tmp_path.iterdir()] == ["campaign_performance"]


def test_shuffle_files_and_staged_rows_go_once_used(spark, tmp_path):
    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.name for local in disk.localDirsString() for f in Path(local).rglob("shuffle_*.data")}

    before = shuffled()
    with loading.staged_for(days_of(spark, 1, 2).groupBy("date").count(), "t") as staged:
        files = staged.inputFiles()
        assert staged.count() == 2 and files
    for _ in range(100):  # files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and not Path(files[0].removeprefix("file:")).exists()


def test_rows_that_get_lost_fail_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loading, "write", lambda *args: 1)
    with pytest.raises(RuntimeError, match="2 rows in"):
        load_table(campaign_rows(spark, [FIRST, FIRST]), str(tmp_path), "campaign_insights")


def put(root, folder, *rows):
    (root / folder).mkdir(parents=True, exist_ok=True)
    (root / folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))


SHARD = "department=mkt/account=main"


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    put(root, f"campaigns/{SHARD}/attempt=1", {"id": "c0", "name": "bare"})
    for run, name in (("r1", "one"), ("r2", "two")):
        put(root, f"campaigns/{SHARD}/run={run}/attempt=1", {"id": "c1", "name": name, "status": "ACTIVE"})
        put(root, f"accounts/{SHARD}/run={run}", {"id": "act_7", "name": f"Shop {name}"})
        put(root, f"ad_creatives/{SHARD}/run={run}/attempt=1", {"id": "a1", "creative": {"id": "k"}})
        put(root, f"creatives/{SHARD}/run={run}", {"id": "k", "thumbnail_url": name})
    put(root, f"campaigns/{SHARD}/run=r1/attempt=2", {"id": "c2", "name": "once", "status": "PAUSED"})
    for n in range(3):
        day = f"2024-01-0{n + 1}"
        row = {"account_id": "act_7", "campaign_id": f"c{n}", "date_start": day, "date_stop": day}
        put(root, f"campaign_insights/{SHARD}/day={day}", row)
    return root


def test_answers_by_run(spark, landing):
    def names(**where):
        rows = read_entity(spark, str(landing), "campaigns", **where).collect()
        return sorted((r["run"], r["name"]) for r in rows if r["run"]) + [r["name"] for r in rows if not r["run"]]

    assert names(run="r2") == [("r2", "two")]
    assert names(as_of="r1") == [("r1", "once"), ("r1", "one"), "bare"]
    assert len(names()) == 4 and names(run="r9") == []
    account = {"department": "mkt", "account": "main"}
    assert [r["account_name"] for r in read_accounts(spark, str(landing), **account).collect()] == ["Shop two"]
    assert [r["account_name"] for r in read_accounts(spark, str(landing), as_of="r1").collect()] == ["Shop one"]
    links, creatives = (read_entity(spark, str(landing), e) for e in ("ad_creatives", "creatives"))
    found = sorted((r["run"], r["thumbnail_url"]) for r in ad_creatives(links, creatives).collect())
    assert found == [("r1", "one"), ("r2", "two")]


def test_runs_decide_what_tables_hold(spark, landing, tmp_path):
    def built(**where):
        job = Job(str(landing), str(tmp_path / "-".join(where.values() or ["all"])), "mkt", "main", **where)
        run_campaign(spark, job, date(2024, 1, 1), date(2024, 1, 3))
        rows = read_table(spark, job.warehouse, "campaign_metadata").collect()
        return sorted((r["campaign_id"], r["campaign_name"] or "-", r["account_name"]) for r in rows)

    # an id without an answer in its run leaves three placeholders, whatever was known before
    assert built(run="r2") == [("c0", "-", "Shop two")] * 3 + [("c1", "two", "Shop two")] + [("c2", "-", "Shop two")] * 3
    assert built() == [("c0", "bare", "Shop two"), ("c1", "two", "Shop two"), ("c2", "-", "Shop two"), ("c2", "once", "Shop two")]
    assert ("c1", "one", "Shop one") in built(as_of="r1")


def test_days_out_of_range_are_not_listed(spark, landing):
    listed, rows = files_listed(
        spark, lambda: read_insights(spark, str(landing), "campaign", date(2024, 1, 2), date(2024, 1, 2)).collect()
    )
    assert listed == 1 and [r["campaign_id"] for r in rows] == ["c1"]


def test_pipeline_by_name(spark, landing, tmp_path, database):
    job = Job(str(landing), str(tmp_path / "w"), "mkt", "main", run="r2", database=database)
    report = run_campaign(spark, job, date(2024, 1, 1), date(2024, 1, 3))
    mart = spark.table(f"{database}.campaign_performance")
    assert mart.count() == report.mart_rows == 7
    assert sorted(t.name.split("__")[0] for t in spark.catalog.listTables(database)) == [
        "campaign_insights", "campaign_metadata", "campaign_performance", "campaign_performance",
    ]
