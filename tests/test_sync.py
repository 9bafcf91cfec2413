"""Stored tables, incremental and full syncs, and streams over landed files."""

import json
import os
import random
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyloom.sinks.buckets import BucketedTable
from tallyloom.plans import quality
from tallyloom.sinks.log import Action, Conflict, put_if_absent
from tallyloom.sinks.store import ENTITIES, Store, latest_version, seed_history
from tallyloom.sinks.tables import Table
from tallyloom.sources.landing import Landing
from tallyloom.sources.pages import list_or_envelope
from tallyloom.streaming import feed, sync


def customer(number, created, **more):
    return {"id": f"c{number}", "created": created, "email": f"e{number}", **more}


@pytest.fixture
def store(spark, scratch):
    return Store(spark, scratch)


def ids(df, column="customer_id"):
    return sorted(r[0] for r in df.select(column).collect())


def audit(store):
    rows = store.history.read().orderBy("sync_completed_at", "status").collect()
    return [(r["entity_type"], r["records_synced"], r["status"], None if r["last_sync_timestamp"] is None
             else str(r["last_sync_timestamp"])) for r in rows]


# -- tables


@pytest.fixture
def table(spark, scratch):
    return Table(spark, scratch, "k string, v int, ingested_at int", keys=["k"])


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int, ingested_at int")


def test_a_batch_that_runs_twice_counts_once(spark, table):
    for _ in range(2):
        table.append(batch(spark, ("a", 1, 1), ("b", 1, 1)), 1)
    assert table.read().count() == 2 and table.current().count() == 2


def test_newest_row_wins_before_and_after_compaction(spark, table):
    table.append(batch(spark, ("a", 1, 1), ("b", 1, 1), (None, 1, 1)), 1)
    table.append(batch(spark, ("a", 2, 2), (None, 2, 2)), 2)
    expected = [("a", 2), ("b", 1), (None, 2)]
    for _ in range(2):
        assert sorted((tuple(r) for r in table.current().select("k", "v").collect()), key=str) == expected
        table.compact()
    table.append(batch(spark, ("b", 3, 3), ("a", 0, 0), ("d", 3, 3), (None, 3, 3)), 3)
    found = sorted((tuple(r) for r in table.current().select("k", "v").collect()), key=str)
    assert found == [("a", 2), ("b", 3), ("d", 3), (None, 3)]
    assert table.last_batch() == 3


def test_superseded_folders_can_go(spark, table):
    for n in (1, 2):
        table.append(batch(spark, ("a", n, n)), n)
        table.compact()
    table.append(batch(spark, ("b", 3, 3)), 3)
    assert table.drop_superseded() == 3
    assert sorted(tuple(r) for r in table.current().select("k", "v").collect()) == [("a", 2), ("b", 3)]


def test_writes_without_a_commit_are_not_read(spark, table):
    table.replace(batch(spark, ("a", 1, 1)), 1)
    with pytest.raises(RuntimeError), table.log.transaction():
        table.replace(batch(spark, ("b", 1, 1)), 2)
        assert ids(table.read(), "k") == ["b"]
        raise RuntimeError
    assert ids(table.read(), "k") == ["a"] == ids(Table(spark, table.folder, table.schema).read(), "k")
    assert sum(name.startswith("_write=base-") for name in os.listdir(table.folder)) == 2


def test_a_batch_replaces_itself_after_it_was_folded(spark, scratch):
    log = Table(spark, scratch, "k string, v int, ingested_at int")
    for n in (1, 2, 3):
        log.append(batch(spark, ("a", n, n), ("b", n, n)), n)
    log.compact()
    assert log.read(below=2).count() == 2 and log.read(below=3).count() == 4
    log.append(batch(spark, ("c", 9, 9)), 2)
    for _ in range(2):
        assert sorted(tuple(r) for r in log.read().select("k", "v").collect()) == [("a", 1), ("a", 3), ("b", 1), ("b", 3), ("c", 9)]
        assert ids(log.read(below=3), "k") == ["a", "b", "c"]
        log.compact()


def test_versions_stay_readable_until_they_are_dropped(spark, table):
    table.append(batch(spark, ("a", 1, 1)), 1)
    table.append(batch(spark, ("a", 2, 2)), 2)
    table.compact()
    table.replace(batch(spark, ("z", 1, 1)), 9)
    assert [ids(table.at(v).current(), "k") for v in (1, 3, 4)] == [["a"], ["a"], ["z"]]
    assert [r["v"] for v in (1, 2, 3) for r in table.at(v).current().collect()] == [1, 2, 2]
    assert table.log.as_table().count() == table.log.version == 4
    assert table.drop_superseded() == 3 and ids(table.current(), "k") == ["z"]


def test_only_one_of_two_writers_wins(spark, table):
    other = Table(spark, table.folder, table.schema, keys=["k"])
    table.append(batch(spark, ("a", 1, 1)), 1)
    # Both see version 1; the second one to commit takes the next number.
    with other.log.transaction():
        other.append(batch(spark, ("b", 2, 2)), 2)
        table.append(batch(spark, ("c", 3, 3)), 3)
    assert other.log.version == 3 and ids(other.read(), "k") == ["a", "b", "c"]
    with pytest.raises(Conflict), other.log.transaction():
        other.append(batch(spark, ("x", 4, 4)), 4)
        table.log.refresh()
        table.append(batch(spark, ("y", 4, 4)), 4)
    assert ids(other.read(), "k") == ["a", "b", "c", "y"]
    with pytest.raises(Conflict), other.log.transaction():
        other.compact()
        table.append(batch(spark, ("late", 1, 1)), 1)
    # A batch on top of what was folded is no conflict.
    with other.log.transaction():
        other.compact()
        table.append(batch(spark, ("new", 5, 5)), 5)
    assert ids(other.current(), "k") == ["b", "c", "late", "new", "y"]


def test_a_file_is_put_only_if_absent(spark, scratch):
    assert put_if_absent(spark, f"{scratch}/x.json", "one") and not put_if_absent(spark, f"{scratch}/x.json", "two")
    assert os.listdir(scratch) == ["x.json"] and open(f"{scratch}/x.json").read() == "one"


# -- bucketed tables


@pytest.fixture
def bucketed(spark, scratch):
    return BucketedTable(spark, scratch, "k string, l int, v int, ingested_at int", keys=["k", "l"], buckets=16)


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, l int, v int, ingested_at int")


def test_bucketed_rows_are_those_of_a_plain_table(spark, scratch, bucketed):
    plain = Table(spark, f"{scratch}-plain", bucketed.schema, keys=bucketed.keys)
    chance = random.Random(3)
    keys = [("a|b", 1), ("a", None), (None, 1), (None, None), ("a\\", 1), ("=", 0), ("", 1), ("-", 1), *((f"k{n}", n % 3) for n in range(60))]

    def rows(n):
        return [(*k, n, chance.randrange(6)) for k in chance.choices(keys, k=50)]

    for n in range(1, 8):
        new = pairs(spark, *rows(n))
        for table in (plain, bucketed):
            table.append(new, min(n, 6))
            if n in (3, 5):
                table.compact()
        assert same(plain.current(), bucketed.current())
    bucketed.compact()
    assert same(plain.current(), bucketed.read()) and bucketed.compact() == []
    bucketed.replace(pairs(spark, ("x", 1, 1, 1), ("x", 1, 2, 2)), 9)
    assert [tuple(r) for r in bucketed.current().collect()] == [("x", 1, 2, 2)]
    bucketed.replace(pairs(spark), 10)
    assert bucketed.current().count() == 0 == bucketed.read().count()


def same(a, b):
    return sorted(map(tuple, a.select(sorted(a.columns)).collect()), key=repr) == sorted(map(tuple, b.select(sorted(a.columns)).collect()), key=repr)


def test_a_merge_rewrites_the_buckets_it_touches(spark, bucketed):
    bucketed.append(pairs(spark, *((f"k{n}", n, 0, 0) for n in range(200))), 1)
    assert bucketed.compact() == list(range(16))
    before = dict(bucketed.contents.buckets)
    bucketed.append(pairs(spark, ("k7", 7, 1, 1)), 2)
    touched = bucketed.compact()
    after = bucketed.contents.buckets
    assert len(touched) == 1 and [b for b in after if after[b] != before[b]] == touched
    assert bucketed.current().count() == 200 and bucketed.current().where("v = 1").count() == 1
    assert not bucketed._bucketed(touched).where("k = 'k7' and v = 0").count()


def test_the_base_is_not_shuffled(spark, bucketed):
    bucketed.append(pairs(spark, *((f"k{n}", n, 0, 0) for n in range(200))), 1)
    bucketed.compact()
    bucketed.append(pairs(spark, ("k7", 7, 1, 1)), 2)
    plan = bucketed.current()._jdf.queryExecution().executedPlan().toString()
    base = plan[: plan.index("Bucketed: true")]
    # Above the base's scan, which comes first in the plan, there is the join and no exchange.
    assert "FullOuter" in base and "Exchange" not in base and plan.count("Bucketed: true") == 1


def test_folding_empty_batches_keeps_the_base(spark, bucketed):
    bucketed.append(pairs(spark, ("a", 1, 1, 1), ("b", 2, 1, 1)), 1)
    bucketed.compact()
    bucketed.append(pairs(spark), 2)
    assert bucketed.compact() == [] and bucketed.size() == 2
    assert bucketed.current().count() == 2 and not bucketed.contents.batches


# -- metrics


def lines(table):
    return [tuple(r) for r in table.metrics().collect()]


def test_what_batches_brought_is_in_the_log(spark, scratch):
    log = Table(spark, scratch, "k string, v int, ingested_at int")
    assert lines(log) == [] and log.size() == 0
    assert log.append(batch(spark, ("a", 1, 7), ("b", 1, 5)), 1) == 2
    assert log.append(batch(spark), 2) == 0
    assert log.append(batch(spark, ("c", 1, None)), 3) == 1
    log.compact()
    assert lines(log) == [(1, 2, "7"), (2, 0, None), (3, 1, None)] and log.size() == log.read().count() == 3
    log.append(batch(spark, ("a", 1, 9)), 1)
    assert lines(log)[0] == (1, 1, "9") and log.size() == log.read().count() == 2
    assert lines(log.at(1)) == [(1, 2, "7")] and log.at(4).size() == 3
    log.replace(batch(spark, *[("z", n, n) for n in range(5)]), 4)
    assert lines(Table(spark, scratch, log.schema)) == [(4, 5, "4")] and log.size() == 5


@pytest.mark.parametrize("kind", [Table, BucketedTable])
def test_the_size_of_a_table_with_keys_is_known_once_it_is_folded(spark, scratch, kind):
    table = kind(spark, scratch, "k string, v int, ingested_at int", keys=["k"])
    rows = batch(spark, ("a", 1, 1), ("a", 2, 2), (None, 1, 1))
    assert table.size() == 0
    assert table.append(rows, 1) == 3 and table.size() is None
    table.compact()
    assert table.size() == table.current().count() == 2 and lines(table) == [(1, 3, "2")]
    assert table.replace(rows.where("v = 2"), 2) == 1 and table.size() == 1 and lines(table) == [(2, 1, "2")]


def test_what_was_written_before_metrics_has_none(spark, scratch):
    table = Table(spark, scratch, "k string, ingested_at timestamp_ntz", keys=["k"])
    table.append(spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-01-01' AS ingested_at"), 1)
    table.log._commit([Action("table", "add", 2, table.contents.batches[1])])
    assert lines(table) == [(1, 1, "2024-01-01 00:00:00"), (2, None, None)]
    counted = quality.observed_freshness({"t": table}, "2024-01-01").first()
    assert counted["records"] is None and counted["last_ingested"] is None
    assert quality.observed_row_counts({"t": table}).first()["row_count"] == 1


def test_rows_are_counted_once_where_tasks_run_again(spark, scratch):
    """The metrics lie behind the write's last shuffle, so none of its shuffled stages is counted."""
    clustered = Table(spark, scratch, "k string, v int", cluster=["v"], partition=("part", "CAST(NULL AS DATE)"))
    rows, seen = clustered._observed(spark.range(100).selectExpr("'a' AS k", "CAST(id AS int) AS v").repartitionByRange(4, "v"))
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange") and plan.count("Exchange") == 1
    assert clustered.append(spark.range(100).selectExpr("'a' AS k", "CAST(id AS int) AS v"), 1) == 100


def test_reports_from_metrics_equal_those_from_data(store, records):
    for n in (1, 2, 3):
        sync.sync_entity(store, "customers", records(*(customer(k, k * 100) for k in range(1, n * 4))), n,
                         now=f"2024-01-0{n} 00:00:00", lookback=150)
    raw, processed = store.raw["customers"], store.billing["customers"]
    for fold in (False, True):
        if fold:
            sync.compact(store, after=1)
        assert quality.observed_raw_against_processed({"c": (raw, processed)}).collect() == (
            quality.raw_against_processed({"c": (raw.read(), processed.current())}).collect())
        assert quality.observed_row_counts({"raw": raw, "p": processed}).collect() == (
            quality.row_counts({"raw": raw.read(), "p": processed.current()}).collect())
        assert quality.observed_freshness({"raw": raw}, "2024-02-01").collect() == quality.freshness({"raw": raw.read()}, "2024-02-01").collect()


def test_counts_of_folded_tables_read_no_data(store, records):
    sync.sync_entity(store, "customers", records(customer(1, 100)), 1)
    sync.compact(store, after=1)
    plan = quality.observed_raw_against_processed({"c": (store.raw["customers"], store.billing["customers"])})
    assert "FileScan" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_sync_reads_its_records_once(spark, store, scratch, records):
    reads = spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    landed = records(customer(1, 100), customer(2, 200), "{broken").select("json_data").mapInArrow(seen, "json_data string")
    assert sync.sync_entity(store, "customers", landed, 1, allowed_bad=0.5).rows == 2
    assert reads.value == 3


def test_replacing_with_nothing_empties_the_table(spark, table):
    table.replace(batch(spark, ("a", 1, 1)), 1)
    table.replace(batch(spark), 2)
    assert table.read().count() == 0 and table.current().count() == 0


def test_an_empty_folder_is_an_empty_table(table):
    assert table.read().count() == 0 and table.current().columns == ["k", "v", "ingested_at"]


def test_seeds_are_added_once(spark, store):
    once = seed_history(store.history.read().drop("completed_month"), list(ENTITIES))
    assert seed_history(once, list(ENTITIES)).count() == once.count() == 2


# -- billing syncs


def test_two_increments_equal_one_load(spark, store, scratch, records):
    first, rest = [customer(i, i * 100) for i in range(1, 6)], [customer(i, i * 100) for i in range(6, 9)]
    assert sync.sync_entity(store, "customers", records(*first), 1).rows == 5
    assert sync.sync_entity(store, "customers", records(*first, *rest), 2).rows == 3
    whole = Store(spark, f"{scratch}-whole")
    sync.sync_entity(whole, "customers", records(*first, *rest), 1)
    columns = ["customer_id", "email", "created"]
    found = [sorted(map(tuple, s.billing["customers"].current().select(columns).collect())) for s in (store, whole)]
    assert found[0] == found[1]
    assert store.raw["customers"].read().count() == 8


def test_nothing_new_repeats_the_watermark(store, records):
    rows = records(customer(1, 100))
    for n in (1, 2):
        sync.sync_entity(store, "customers", rows, n, now=f"2024-01-0{n} 00:00:00")
    assert audit(store) == [
        ("customers", 1, "success", "1970-01-01 00:01:40"), ("customers", 0, "success", "1970-01-01 00:01:40")]


def test_a_failed_run_does_not_move_the_watermark(store, records):
    sync.sync_entity(store, "customers", records(customer(1, 100)), 1, now="2024-01-01 00:00:00")
    outcome = sync.sync_entity(store, "customers", records(customer(2, 200), "{broken"), 2, now="2024-01-02 00:00:00")
    assert outcome.status == "failed" and "could not be read" in outcome.error
    assert ids(store.billing["customers"].current()) == ["c1"]
    assert sync.watermark(store, "customers") == 100
    assert sync.sync_entity(store, "customers", records(customer(1, 100), customer(2, 200)), 3, now="2024-01-03 00:00:00").rows == 1
    assert [r[2] for r in audit(store)] == ["success", "failed", "success"]


def test_some_unreadable_records_can_be_allowed(spark, store, records):
    outcome = sync.sync_entity(store, "customers", records(customer(1, 1), "{broken", {"email": "x"}), 1, allowed_bad=0.7)
    assert (outcome.status, outcome.rows) == ("success", 1)
    assert store.quarantine["customers"].read().count() == 2


def test_late_records_need_a_lookback(store, records):
    sync.sync_entity(store, "customers", records(customer(1, 1000)), 1)
    late = records(customer(1, 1000), customer(2, 900))
    assert sync.sync_entity(store, "customers", late, 2).rows == 0
    assert sync.sync_entity(store, "customers", late, 3, lookback=200).rows == 2
    assert ids(store.billing["customers"].current()) == ["c1", "c2"]
    assert sync.watermark(store, "customers") == 1000


def test_a_lookback_to_second_0_takes_records_without_creation_time(store, records):
    timeless = records(customer(1, 1000), {"id": "c2", "email": "e2"})
    assert [sync.sync_entity(store, "customers", timeless, n, lookback=back).rows for n, back in ((1, 0), (2, 900), (3, 1001))] == [2, 1, 2]
    assert [tuple(r) for r in store.raw["customers"].metrics().select("batch", "rows").collect()] == [(1, 2), (2, 1), (3, 2)]


def test_an_update_replaces_the_older_row(store, records):
    sync.sync_entity(store, "customers", records(customer(1, 100)), 1, now="2024-01-01 00:00:00")
    changed = records(customer(1, 100, email="new"))
    sync.sync_entity(store, "customers", changed, 2, now="2024-01-02 00:00:00", lookback=1)
    assert [tuple(r) for r in store.billing["customers"].current().select("customer_id", "email").collect()] == [("c1", "new")]


def test_failing_to_send_contacts_adds_a_failed_row(store, records):
    sent = []
    assert sync.sync_entity(store, "customers", records(customer(1, 1)), 1, now="2024-01-01 00:00:00",
                            send=lambda bodies: sent.extend(bodies.collect())).status == "success"
    assert json.loads(sent[0]["body"])["customers"] == [{"customer_id": "c1", "email": "e1"}]

    def refuse(_bodies):
        raise OSError("no answer")

    outcome = sync.sync_entity(store, "customers", records(customer(2, 2)), 2, now="2024-01-02 00:00:00", send=refuse)
    assert (outcome.status, outcome.rows) == ("failed", 1)
    assert [r[2] for r in audit(store)] == ["success", "failed", "success"]
    assert sync.watermark(store, "customers") == 2


def test_unknown_entities_are_refused(store, records):
    with pytest.raises(ValueError):
        sync.sync_entity(store, "refunds", records({"id": "x"}), 1)


# -- clustered tables


@pytest.fixture
def many_files(spark):
    settings = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_lookup_opens_few_files(spark, scratch, many_files):
    rows = spark.range(6000).selectExpr("lpad(id, 5, '0') AS k", "CAST(id % 7 AS int) AS v", "make_date(2024, CAST(1 + id % 3 AS int), 5) AS day")
    table = Table(spark, scratch, "k string, v int, day date", partition=("month", "trunc(day, 'month')"), cluster=["k"])
    table.replace(rows, 1)
    table.append(rows.where("k < '00010'"), 2)
    assert sorted(r["k"] for r in table.find("k", "00020", "00022").collect()) == ["00020", "00021", "00022"]
    assert table.find("k", "00003", "00003").count() == 2 and table.find("k", "9", "9").count() == 0
    base = [f for f in table.files("k", None, None) if "base-" in f]
    assert len(base) > 60 and 0 < len(table.files("k", "03000", "03000")) < 0.1 * len(base)
    assert table.find("k", None, "00001").count() == 4 and table.find("v", 3, 3).count() == rows.where("v = 3").count() + 1
    table.append(rows.where("k = '05000'"), 1)
    assert table.find("k", "00020", "00022").count() == 0 and table.find("k", "05000", "05000").count() == 1


def test_bounds_go_with_their_folders(spark, scratch):
    table = Table(spark, scratch, "k string, v int", cluster=["k"])
    assert table.find("k", "a", "z").count() == 0
    table.replace(spark.createDataFrame([("b", 1), (None, 2)], "k string, v int"), 1)
    table.replace(spark.createDataFrame([], "k string, v int"), 2)
    assert table.find("k", "a", "z").count() == 0 and [tuple(r) for r in table.at(1).find("k", "a", "z").collect()] == [("b", 1)]
    assert table.drop_superseded() == 1 and len([x for x in os.listdir(f"{scratch}/_bounds") if not x.startswith(".")]) == 1


# -- landing folders


def land_file(folder, name, *values, body=None):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(json.dumps({"page": 1, "body": body or json.dumps({"data": values})}) + "\n")


@pytest.fixture
def landing(spark, scratch):
    return Landing(spark, f"{scratch}-landing")


@pytest.fixture
def opened(monkeypatch):
    """The files each sync opens, by name."""
    seen = []
    contents = Landing.contents

    def noted(self, files):
        seen.append(sorted(unquote(f.rsplit("/", 1)[1]) for f in files))
        return contents(self, files)

    monkeypatch.setattr(Landing, "contents", noted)
    return seen


def test_a_sync_opens_new_files_only(store, landing, opened):
    for n in range(1, 4):
        land_file(landing.folder, f"{n} [a] {{b}}.json", customer(n, n * 100), customer(10 + n, n * 100 + 50))
        assert sync.sync_entity(store, "customers", landing, n).rows == 2
    for n in range(4, 21):
        if n == 10:
            sync.compact(store, after=1)
        assert sync.sync_entity(store, "customers", landing, n).rows == 0
    assert opened == [[f"{n} [a] {{b}}.json"] for n in (1, 2, 3)] + [[]] * 17
    assert ids(store.billing["customers"].current()) == ["c1", "c11", "c12", "c13", "c2", "c3"]


def test_a_failed_sync_leaves_its_files_to_the_next(store, landing, opened):
    land_file(landing.folder, "a.json", customer(1, 100), {"email": "nobody"})
    assert sync.sync_entity(store, "customers", landing, 1).status == "failed"
    land_file(landing.folder, "b.json", customer(2, 200))
    assert sync.sync_entity(store, "customers", landing, 2).rows == 2
    assert opened == [["a.json"], ["a.json", "b.json"]]


def test_a_batch_that_runs_again_reads_its_files_and_not_those_of_others(store, landing, opened):
    land_file(landing.folder, "a.json", customer(1, 100))
    sync.sync_entity(store, "customers", landing, 1)
    land_file(landing.folder, "b.json", customer(2, 200))
    sync.sync_entity(store, "customers", landing, 2)
    for fold in (False, True):
        if fold:
            sync.compact(store, after=1)
        for n in (1, 2):
            assert sync.sync_entity(store, "customers", landing, n).rows == 1
    assert opened == [["a.json"], ["b.json"]] * 3
    assert store.raw["customers"].read().count() == 2


def test_late_files_are_read_again_if_a_lookback_reaches_them(store, landing, opened):
    for n, second in ((1, 1000), (2, 900), (3, 100)):
        land_file(landing.folder, f"{n} %.json", customer(n, second))
        sync.sync_entity(store, "customers", landing, n)
    assert ids(store.billing["customers"].current()) == ["c1"]
    assert sync.sync_entity(store, "customers", landing, 4, lookback=200).rows == 2
    assert opened[-1] == ["1 %.json", "2 %.json"] and ids(store.billing["customers"].current()) == ["c1", "c2"]


def test_a_file_written_anew_is_a_new_file(store, landing, opened):
    land_file(landing.folder, "a.json", customer(1, 100))
    sync.sync_entity(store, "customers", landing, 1)
    land_file(landing.folder, "a.json", customer(1, 100), customer(2, 200))
    assert sync.sync_entity(store, "customers", landing, 2).rows == 1 and len(opened[1]) == 1


def test_pages_that_cannot_be_read_count_as_records_that_cannot(store, landing):
    land_file(landing.folder, "a.json", customer(1, 100))
    land_file(landing.folder, "b.json", body=json.dumps(customer(7, 700)))
    land_file(landing.folder, "c.json", body=json.dumps({"data": []}))
    assert sync.sync_entity(store, "customers", landing, 1).status == "failed"
    outcome = sync.sync_entity(store, "customers", landing, 2, allowed_bad=0.5)
    assert (outcome.status, outcome.rows) == ("success", 1)
    assert [r["reason"] for r in store.quarantine["customers"].read().collect()] == ["no list of records"]
    assert sync.watermark(store, "customers") == 100


def test_a_folder_that_is_not_there_fails_the_sync(store, landing):
    assert sync.sync_entity(store, "customers", landing, 1).status == "failed"
    os.makedirs(landing.folder)
    assert sync.sync_entity(store, "customers", landing, 1).status == "success"


# -- membership and whole runs


TIERS = ({"id": "p", "name": "Gold", "metadata": {"productKey": "g", "order": "1"}}, {"id": "q", "metadata": None})
LINKED = (
    {"clientId": "m1", "billingID": "c1", "firstName": "A", "subscriptions": [{"id": "s1", "status": "active", "productId": "p"}],
     "cars": [{"_id": "a1", "brand": "B"}], "latestSession": {"sessionId": "v1", "sessionDate": "2024-01-01T10:00:00"}},
    {"clientId": "m2", "billingID": "c9"},
)


def test_no_linked_customers_leaves_the_tables_alone(spark, store, records):
    sync.refresh_membership(store, records(*TIERS), records(*LINKED), ["place"], 1, now="2024-01-01 00:00:00")
    empty = records(*LINKED).where("place < 0")
    outcome = sync.refresh_membership(store, records(*TIERS), empty, ["place"], 2, now="2024-01-02 00:00:00")
    assert (outcome.status, outcome.rows) == ("success", 0)
    assert ids(store.membership["customers"].read(), "client_id") == ["m1", "m2"]
    assert audit(store)[-1][0:3] in (("linked_customers", 0, "success"), ("tiers", 2, "success"))


def test_sessions_are_kept_and_the_rest_is_replaced(store, records):
    sync.refresh_membership(store, records(*TIERS), records(*LINKED), ["place"], 1, now="2024-01-01 00:00:00")
    later = {"clientId": "m1", "billingID": "c1", "latestSession": {"sessionId": "v2", "sessionDate": "2024-02-01T10:00:00"}}
    sync.refresh_membership(store, records(*TIERS), records(later), ["place"], 2, now="2024-02-02 00:00:00")
    assert ids(store.membership["sessions"].current(), "session_id") == ["v1", "v2"]
    assert ids(store.membership["customers"].current(), "client_id") == ["m1"]
    assert store.membership["assets"].current().count() == 0


def test_a_whole_run(spark, store, records):
    billing = {"customers": records(customer(1, 100), customer(2, 200)),
               "subscriptions": records({"id": "s", "customer": "c1", "status": "active", "created": 5})}
    steps = sync.run_all(store, 1, billing, records(*TIERS), records(*LINKED), ["place"], now="2024-01-01 00:00:00")
    assert [tuple(r)[:3] for r in steps.collect()] == [
        ("membership", "success", 2), ("subscriptions", "success", 1), ("customers", "success", 2),
        ("unified_customers", "success", 1), ("bi_snapshot", "success", 1), ("run", "success", 0)]
    row = latest_version(spark, store.snapshot_path, store.log).first()
    assert (row["client_id"], row["customer_status"], row["current_tier_name"], row["total_assets"], row["total_sessions"]) == (
        "m1", "Active", "Gold", 1, 1)


def test_one_failed_step_does_not_stop_the_others(store, records):
    billing = {"customers": records("{broken"), "subscriptions": records({"id": "s", "created": 5})}
    steps = sync.run_all(store, 1, billing, skip_membership=True, now="2024-01-01 00:00:00")
    assert [tuple(r)[:2] for r in steps.collect()] == [
        ("membership", "skipped"), ("subscriptions", "success"), ("customers", "failed"),
        ("unified_customers", "success"), ("bi_snapshot", "success"), ("run", "failed")]


def test_a_run_for_chosen_entities(store, records):
    steps = sync.run_all(store, 1, {"subscriptions": records({"id": "s", "created": 5})}, skip_membership=True, entities=["subscriptions"])
    assert [r["step"] for r in steps.collect()] == ["membership", "subscriptions", "unified_customers", "bi_snapshot", "run"]


# -- streams


def land(folder, number, *values):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-{number}.json", "w") as out:
        out.write(json.dumps({"page": number, "body": json.dumps({"data": list(values)})}) + "\n")
    os.utime(f"{folder}/part-{number}.json", (1_700_000_000 + number, 1_700_000_000 + number))


def test_pages_arrive_in_batches_and_a_restart_goes_on(spark, scratch):
    landing, table = f"{scratch}/in", Table(spark, f"{scratch}/out", "json_data string")
    sink = feed.append_pages(table, lambda rows: rows.select("json_data"))
    for n in (1, 2, 3):
        land(landing, n, {"n": n}, {"n": -n})
    assert len(feed.drain(feed.stream_pages(spark, landing), f"{scratch}/progress", sink)) == 3
    assert table.read().count() == 6
    land(landing, 4, {"n": 4})
    assert len(feed.drain(feed.stream_pages(spark, landing), f"{scratch}/progress", sink)) == 1
    assert table.read().count() == 7


def firsts(spark, landing, progress, table):
    rows = list_or_envelope(feed.stream_pages(spark, landing)).select(
        F.get_json_object("json_data", "$.k").alias("k"), F.get_json_object("json_data", "$.v").cast("int").alias("v"), "page", "place")
    return feed.drain(feed.first_arrivals(rows, ["k"], ["page", "place"]), progress, feed.append_rows(table), changes=True)


def test_copies_are_recognised_however_late(spark, scratch):
    landing = f"{scratch}/in"
    table = Table(spark, f"{scratch}/out", "k string, v int, page long, place int")
    land(landing, 1, {"k": "a", "v": 1}, {"k": "a", "v": 2}, {"k": "b", "v": 1}, {"v": 5})
    land(landing, 2, {"k": "c", "v": 1}, {"v": 6})
    land(landing, 3, {"k": "a", "v": 3}, {"k": "d", "v": 1}, {"k": "b", "v": 9})
    firsts(spark, landing, f"{scratch}/progress", table)
    assert sorted(((r["k"], r["v"]) for r in table.read().collect()), key=str) == [("a", 1), ("b", 1), ("c", 1), ("d", 1), (None, 5)]
    # A restart goes on with what it knows; a page with a smaller number that comes later is later.
    land(landing, 4, {"k": "d", "v": 7}, {"k": "e", "v": 1})
    with open(f"{landing}/part-0.json", "w") as out:
        out.write(json.dumps({"page": 0, "body": json.dumps([{"k": "a", "v": 0}])}) + "\n")
    firsts(spark, landing, f"{scratch}/progress", table)
    assert sorted((r["k"], r["v"]) for r in table.read().collect() if r["k"]) == [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]


def test_a_late_batch_reads_no_more_than_an_early_one(spark, scratch, monkeypatch):
    landing, table = f"{scratch}/in", Table(spark, f"{scratch}/out", "k string, v int, page long, place int")
    for n in range(30):
        land(landing, n, {"k": f"k{n}"}, {"k": "hot"}, {"k": f"k{n // 2}"})
    # Nothing that was stored before is read.
    for name in ("_scan", "read", "read_batches"):
        monkeypatch.setattr(Table, name, None)
    seen = firsts(spark, landing, f"{scratch}/progress", table)
    monkeypatch.undo()
    assert len(seen) == 30 and {p["numInputRows"] for p in seen} == {1}
    assert seen[-1]["stateOperators"][0]["numRowsTotal"] == 31
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in seen) <= 3
    assert sorted(r["k"] for r in table.read().collect()) == sorted(["hot", *(f"k{n}" for n in range(30))])


def test_a_repeated_batch_replaces_its_rows(spark, scratch):
    table = Table(spark, f"{scratch}/out", "json_data string")
    aside = Table(spark, f"{scratch}/aside", "page long, body string, reason string", log=table.log, name="aside")
    pages = spark.createDataFrame([(1, '{"data":[{"k":"a"}]}'), (2, "{}")], "page long, body string")
    sink = feed.append_pages(table, lambda rows: rows.select("json_data"), aside)
    for _ in range(2):
        sink(pages, 0)
    assert table.read().count() == 1 and [r["page"] for r in aside.read().collect()] == [2] and table.log.version == 2


# -- syncs that run again


def content(store):
    """All that a billing sync leaves behind."""
    parts = (store.raw["customers"].read(), store.billing["customers"].read(), store.quarantine["customers"].read())
    return [sorted(map(str, p.drop("ingested_at", "updated_at").collect())) for p in parts]


def test_the_same_batch_again_leaves_the_same_tables(store, records):
    for _ in range(3):
        sync.sync_entity(store, "customers", records(customer(1, 100), customer(2, 200)), 1, now="2024-01-01 00:00:00")
        if _ == 0:
            first = content(store), audit(store)
    assert (content(store), audit(store)) == first
    assert len(first[0][0]) == len(first[0][1]) == 2 and first[1] == [("customers", 2, "success", "1970-01-01 00:03:20")]


def test_a_failed_batch_adds_nothing_and_its_retry_all(spark, store, scratch, records):
    mixed = (customer(1, 100), "{broken", customer(2, 200))
    assert sync.sync_entity(store, "customers", records(*mixed), 1).status == "failed"
    assert store.raw["customers"].read().count() == 0 == store.billing["customers"].read().count()
    assert sync.sync_entity(store, "customers", records(*mixed), 1, allowed_bad=0.5).rows == 2
    once = Store(spark, f"{scratch}-once")
    sync.sync_entity(once, "customers", records(*mixed), 1, allowed_bad=0.5)
    assert content(store) == content(once)


def test_a_record_set_aside_does_not_fail_later_batches(store, records):
    assert sync.sync_entity(store, "customers", records(customer(1, 100), "{broken"), 1, allowed_bad=0.5).rows == 1
    outcome = sync.sync_entity(store, "customers", records(customer(1, 100), "{broken", customer(2, 200)), 2)
    assert (outcome.status, outcome.rows) == ("success", 1)
    assert store.quarantine["customers"].read().count() == 1


def test_many_small_batches_are_folded(store, records, monkeypatch):
    monkeypatch.setattr(sync, "COMPACT_AFTER", 2)
    table = store.billing["customers"]
    for n in (1, 2, 3):
        for name in ("customers", "subscriptions"):
            sync.sync_entity(store, name, records(customer(n, n * 100)), n)
        sync.compact(store)
        assert len(table.contents.batches) < 2 > len(store.history.contents.batches)
    assert ids(table.current()) == ["c1", "c2", "c3"]
    assert sync.watermark(store, "customers") == 300


def test_contacts_of_a_run_name_the_products_of_the_run(store, records):
    bought = {"id": "s1", "customer": "c1", "created": 5, "items": {"data": [{"price": {"product": "p1"}}]}}
    sent = []
    billing = {"customers": records(customer(1, 100)), "subscriptions": records(bought)}
    sync.run_all(store, 1, billing, skip_membership=True, send=lambda chunks: sent.extend(json.loads(r["body"]) for r in chunks.collect()))
    assert [(x["customer_id"], x["product_id"]) for body in sent for x in body["customers"]] == [("c1", "p1")]


def test_rows_without_a_key_stay_and_strangers_stay_apart(spark, store, records):
    def member(client, billing, subscription, session):
        return {"clientId": client, "billingID": billing, "email": f"{billing}@x", "subscriptions": [{"id": subscription, "status": "active"}],
                "latestSession": {"sessionId": session, "sessionDate": "2024-01-01T10:00:00+02:00"}}

    feed = records(member(None, "c1", None, "x1"), member("", "c2", None, "x2"), member("k", "c3", "s", "x3"))
    billing = {"customers": records(*(customer(k, 5) for k in (1, 2, 3))), "subscriptions": records()}
    sync.run_all(store, 1, billing, records(), feed, ["place"]).collect()
    assert store.membership["subscriptions"].read().count() == 3
    assert [str(r[0]) for r in store.membership["sessions"].read().select("session_date").distinct().collect()] == ["2024-01-01 08:00:00"]
    found = latest_version(spark, store.unified_path, store.log)
    assert {r["billing_id"]: [s["session_id"] for s in r["sessions"]] for r in found.collect()} == {"c1": [], "c2": [], "c3": ["x3"]}


def test_a_batch_that_runs_again_after_a_fold_loses_nothing(store, records):
    everything = [customer(n, n * 100) for n in range(1, 17)]
    for n in range(1, 9):
        sync.sync_entity(store, "customers", records(*everything[: 2 * n]), n, now=f"2024-01-0{n} 00:00:00")
    sync.compact(store)
    first = content(store), audit(store)
    assert sync.sync_entity(store, "customers", records(*everything), 8, now="2024-01-08 00:00:00").rows == 2
    assert (content(store), audit(store)) == first and store.raw["customers"].read().count() == 16
    assert sync.sync_entity(store, "customers", records(*everything), 3, now="2024-01-03 00:00:00").rows == 12
    assert ids(store.billing["customers"].current()) == sorted(f"c{n}" for n in range(1, 17))


class Killed(BaseException):
    pass


@pytest.mark.parametrize("writes", range(1, 5))
def test_killed_after_a_write_a_sync_leaves_all_as_it_was(spark, store, records, monkeypatch, writes):
    sync.sync_entity(store, "customers", records(customer(1, 100)), 1, now="2024-01-01 00:00:00")
    first, plain, done = (content(store), audit(store)), Table._write, []

    def write(*arguments):
        done.append(plain(*arguments))
        if len(done) == writes:
            raise Killed
        return done[-1]

    with monkeypatch.context() as patch:
        patch.setattr(Table, "_write", write)
        with pytest.raises(Killed):
            sync.sync_entity(store, "customers", records(customer(1, 100), "{broken", customer(2, 200)), 2, now="2024-01-02 00:00:00", allowed_bad=0.9)
    after = Store(spark, store.folder)
    assert (content(after), audit(after)) == first == (content(store), audit(store))


def test_killed_at_any_write_a_refresh_leaves_all_as_it_was(spark, store, records, monkeypatch):
    sync.refresh_membership(store, records(*TIERS), records(*LINKED), ["place"], 1, now="2024-01-01 00:00:00")

    def state(s):
        return [sorted(map(str, table.current().drop("ingested_at", "updated_at").collect())) for table in s.membership.values()], audit(s)

    first, plain = state(store), Table._write
    later = {"clientId": "m9", "billingID": "c1", "subscriptions": [{"id": "s9", "status": "active"}]}
    for writes in (1, 4, 8, 9):
        done = []

        def write(*arguments):
            done.append(plain(*arguments))
            if len(done) == writes:
                raise Killed
            return done[-1]

        with monkeypatch.context() as patch:
            patch.setattr(Table, "_write", write)
            with pytest.raises(Killed):
                sync.refresh_membership(store, records(*TIERS), records(later), ["place"], 2, now="2024-01-02 00:00:00")
        assert state(Store(spark, store.folder)) == first
    sync.refresh_membership(store, records(*TIERS), records(later), ["place"], 2, now="2024-01-02 00:00:00")
    assert state(Store(spark, store.folder)) != first and len(done) == 9


def test_landing_files_are_compressed_and_bounded(tables, spark, monkeypatch):
    monkeypatch.setattr(registry, "LANDED_RECORDS", 1000)
    landed_rows = registry._landed_feed(tables)
    files = [f for f in landed_rows.inputFiles()]
    assert all(f.endswith(".json.gz") for f in files) and len(files) >= landed_rows.count() / 1000
    assert landed_rows.exceptAll(registry._linked(tables)).isEmpty() and landed_rows.count() == registry._linked(tables).count()


def test_parts_of_a_stream_land_in_many_files(tables, spark, monkeypatch):
    monkeypatch.setattr(registry, "LANDED_PAGES", 2)
    path, files = registry._land(tables, spark.range(40).selectExpr("id AS page", "'[]' AS body"), "landing")
    landed_pages = spark.read.schema("page bigint, body string").json(path)
    assert files == 5 and len(landed_pages.inputFiles()) == 20
    assert sorted(r["page"] for r in landed_pages.collect()) == list(range(40))


def test_a_first_merge_has_nothing_to_join(spark, scratch, monkeypatch):
    joins = []
    monkeypatch.setattr(BucketedTable, "_merged", lambda self, *both, own=BucketedTable._merged: joins.append(1) or own(self, *both))
    table = BucketedTable(spark, scratch, "id string, v int, ingested_at int", keys=["id"], buckets=4)
    rows = [(f"k{i % 30}", i, i) for i in range(60)] + [(None, 1, 1), (None, 2, 0)]
    wanted = sorted([(f"k{i % 30}", i, i) for i in range(30, 60)] + [(None, 1, 1)], key=repr)
    table.append(spark.createDataFrame(rows, table.schema), 1)
    table.compact()
    assert not joins and sorted(map(tuple, table.current().collect()), key=repr) == wanted
    table.append(spark.createDataFrame([("k3", 99, 99), ("k4", -1, -1)], table.schema), 2)
    table.compact()
    wanted = sorted([r if r[0] != "k3" else ("k3", 99, 99) for r in wanted], key=repr)
    assert len(joins) == 1 and sorted(map(tuple, table.current().collect()), key=repr) == wanted
    folder = table.contents.buckets
    # Each bucket is one folder of rows dealt as Spark deals them, so that a later merge does not shuffle it.
    assert sum(spark.read.parquet(f"{scratch}/{p}").where(F.pmod(F.hash("_key"), F.lit(4)) == b).count() for b, p in folder.items()) == 31


def test_what_only_one_step_reads_goes_with_it(store, records):
    billing = {"customers": records(customer(1, 100), "no record"), "subscriptions": records({"id": "s", "customer": "c1", "created": 5})}
    steps = sync.run_all(store, 1, billing, records(*TIERS), records(*LINKED), ["place"], now="2024-01-01 00:00:00")
    assert [tuple(r)[:2] for r in steps.collect()][:3] == [("membership", "success"), ("subscriptions", "success"), ("customers", "failed")]
    assert not [f for f in (Path(store.folder) / "staging").rglob("*") if f.is_file()]


def test_rows_without_their_whole_key_all_stay(store, records):
    cars = [{"_id": "a1", "brand": "old"}, {"_id": "a1", "brand": "old"}, {"_id": "a2", "brand": "B"}]
    subs = [{"id": "s1", "status": "active"}, {"id": "s1", "status": "active"}, {"id": "", "status": "x"}, {"id": "", "status": "x"}]
    linked = records({"clientId": "m1", "billingID": "c1", "subscriptions": subs, "cars": cars}, {"email": "e", "cars": cars})
    sync.refresh_membership(store, records(*TIERS), linked, ["place"], 1, now="2024-01-01 00:00:00")
    assert ids(store.membership["subscriptions"].current(), "subscription_id") == ["", "", "s1"]
    kept = store.membership["assets"].current().select("client_id", "asset_id").collect()
    assert sorted(map(tuple, kept)) == [("", "a1"), ("", "a1"), ("", "a2"), ("m1", "a1"), ("m1", "a2")]
