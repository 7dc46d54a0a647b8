import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tabspark.operators import ledger as le
from tabspark.operators import registry as rg
from tabspark.sources import io as sio


def test_run_duration_and_latest(spark, tmp_dir):
    t0 = datetime(2024, 1, 1, 0, 0, 0)
    rec = le.run_record(spark, "raw/monthly/a.parquet", "cleaning", le.STATUS_RUNNING, "r1", t0, t0 + timedelta(seconds=10))
    assert rec.first()["duration_seconds"] == 10.0
    path = f"{tmp_dir}/ledger"
    le.append_runs(rec, path)
    le.append_runs(le.run_record(spark, "raw/monthly/a.parquet", "cleaning", le.STATUS_COMPLETED, "r2"), path)
    runs = le.read_runs(spark, path)
    latest = le.latest_runs(runs).first()
    assert latest["status"] == le.STATUS_COMPLETED
    inputs = spark.createDataFrame([("raw/monthly/a.parquet",), ("raw/monthly/b.parquet",)], "raw_blob_name string")
    assert [r[0] for r in le.pending_inputs(inputs, runs, "cleaning").collect()] == ["raw/monthly/b.parquet"]
    assert le.read_runs(spark, f"{tmp_dir}/absent").count() == 0


def test_foreign_json_ledger(spark):
    docs = spark.createDataFrame([('{"raw_blob_name": "x", "status": "COMPLETED"}',), ("",), ("not json",)], "value string")
    out = le.parse_ledger_json(docs).collect()
    assert out[0]["status"] == "COMPLETED" and out[1]["status"] is None and out[2]["status"] is None


def test_registry_resolution(spark):
    t = datetime(2024, 1, 1)
    src = spark.createDataFrame([("m", f"run{i}" if i != 2 else "", t + timedelta(hours=i)) for i in range(5)],
                                "model_name string, run_id string, created_at timestamp")
    versions = rg.register_versions(src)
    assert sorted(r["version"] for r in versions.collect()) == [1, 2, 3, 4, 5]
    more = rg.register_versions(spark.createDataFrame([("m", "run9", t + timedelta(days=1))],
                                                      "model_name string, run_id string, created_at timestamp"), versions)
    assert more.first()["version"] == 6
    aliases = spark.createDataFrame([("m", "production", 3, t), ("m", "production", 4, t + timedelta(hours=1)),
                                     ("m", "Staging", 9, t)], "model_name string, alias string, version long, set_at timestamp")
    req = spark.createDataFrame([("m", 5, "production"), ("m", None, "production"), ("m", None, "Staging"),
                                 ("m", 3, "x"), ("m", None, "none")], "model_name string, version long, alias string")
    out = {(r["alias"], r["version"]): r["status"] for r in rg.resolve(req, versions, aliases).collect()}
    assert out[("production", 5)] == "ok"          # explicit version wins
    assert out[("production", 4)] == "ok"          # alias -> newest assignment
    assert out[("Staging", 9)] == "missing_version"
    assert out[("x", 3)] == "no_run_id"            # version 3 has an empty run id
    assert out[("none", None)] == "no_alias"


def test_retention_keeps_newest_and_protected(spark):
    t = datetime(2024, 1, 1)
    items = spark.createDataFrame([("app", i, t + timedelta(minutes=i)) for i in range(6)],
                                  "model_name string, version long, created_at timestamp")
    protected = spark.createDataFrame([("app", 0)], "model_name string, version long")
    old = le.retention(items, "model_name", "created_at", "version", 2, protected)
    assert sorted(r["version"] for r in old.collect()) == [1, 2, 3]
    # protected versions leave before the newest are counted
    newest = spark.createDataFrame([("app", 4), ("app", 5)], "model_name string, version long")
    old = le.retention(items, "model_name", "created_at", "version", 3, newest)
    assert [r["version"] for r in old.collect()] == [0]


@pytest.mark.parametrize("raw,clean", [("raw/monthly/batch.parquet", "clean/monthly/batch.parquet"),
                                       ("batch.parquet", "clean/batch.parquet"),
                                       (" /raw/data.parquet ", "clean/data.parquet")])
def test_key_derivation(spark, raw, clean):
    r = spark.range(1).select(sio.clean_blob_name(F.lit(raw)).alias("c"),
                              sio.training_ledger_name(F.lit(raw)).alias("t")).first()
    assert r["c"] == clean
    assert r["t"].startswith("training/") and r["t"].endswith(".json") and ".parquet" not in r["t"]


def test_io_round_trip(spark, tmp_dir):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    path = sio.write_batch(df, tmp_dir, 100, ["id"])
    back = sio.read_raw(spark, path)
    assert back.count() == 100 and back.agg(F.max("id")).first()[0] == 99
    sio.write_clean(df, f"{tmp_dir}/clean", output_rows=1000)
    with pytest.raises(sio.EmptyInputError):
        sio.write_clean(df, f"{tmp_dir}/clean2", output_rows=0)
    df.limit(0).write.parquet(f"{tmp_dir}/empty")
    with pytest.raises(sio.EmptyInputError):
        sio.read_raw(spark, f"{tmp_dir}/empty")


def test_newest_file(spark, tmp_dir):
    from datetime import datetime, timedelta
    spark.range(3).write.parquet(f"{tmp_dir}/raw/monthly")
    now = datetime.now()
    r = sio.newest_file(spark, f"{tmp_dir}/raw", now + timedelta(minutes=1), 10).first()
    assert r["files"] >= 1 and r["recent"] is True
    old = sio.newest_file(spark, f"{tmp_dir}/raw", now + timedelta(days=1), 10).first()
    assert old["recent"] is False


def test_subset_by_keys(spark):
    from tabspark.operators.split import subset_by_keys
    df = spark.range(10).withColumnRenamed("id", "k")
    keys = spark.createDataFrame([(1,), (3,), (3,)], "k long")
    assert sorted(r["k"] for r in subset_by_keys(df, keys, ["k"]).collect()) == [1, 3]
    with pytest.raises(RuntimeError, match="unexpected number of rows"):
        subset_by_keys(df, spark.createDataFrame([(1,), (42,)], "k long"), ["k"])


def test_rank_within_hot_group(spark):
    from tabspark.operators.ranking import rank_within
    rows = [("hot", i % 997, i) for i in range(6000)] + [("cold", i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, t long, id long")
    out = rank_within(df, ["g"], ["t", "id"], partitions=8).collect()
    for g, n in (("hot", 6000), ("cold", 50)):
        got = sorted(((r["t"], r["id"]), r["rank"]) for r in out if r["g"] == g)
        assert [rk for _, rk in got] == list(range(1, n + 1))
    desc = rank_within(df, ["g"], ["t", "id"], descending=True, partitions=8).where("g = 'cold'").orderBy("rank").first()
    assert desc["t"] == 49


def test_two_writers_get_two_versions(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    from datetime import datetime

    from tabspark.operators import registry as rg
    at = datetime(2024, 1, 1)
    assert rg.register(spark, tmp_dir, "m", "r0", at) == 1
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: rg.register(spark, tmp_dir, "m", f"r{k}", at), range(1, 5)))
    assert sorted(got) == [2, 3, 4, 5]
    rows = spark.read.parquet(f"{tmp_dir}/model_versions").collect()
    assert sorted((r["version"], r["run_id"]) for r in rows) == sorted([(1, "r0"), *((v, f"r{k}") for k, v in enumerate(got, 1))])
    assert rg.register(spark, tmp_dir, "a/b", "x", at) == 1 and rg.register(spark, tmp_dir, "m", "r9", at) == 6


def test_run_documents_of_both_shapes_and_damaged_ones(spark):
    from tabspark.operators import ledger as le
    training = '{"status": "COMPLETED", "pipeline_run_id": "p1", "raw_blob_name": "raw/a", "metrics": {"test": {"roc_auc": 0.5}}, "started_at": "2024-01-01T00:00:00", "model_version": "4"}'
    cleaning = '{"status": "COMPLETED", "raw_blob_name": "raw/a", "clean_blob_name": "clean/a", "transform_metrics": {"output_rows": 7}, "duration_seconds": "x"}'
    docs = [(1, training), (2, cleaning), (3, ""), (4, None), (5, "{"), (6, "[]"), (7, '{"status": "FAILED"}'), (8, training[:40])]
    out = le.read_documents(spark.createDataFrame(docs, "id long, value string"), keep=["id"])
    got = {r["id"]: r for r in out.collect()}
    assert (got[1].run_id, got[1].phase, got[1].test_roc_auc, got[1].model_version, got[1].output_rows, got[1].problem) == ("p1", "training", 0.5, "4", None, None)
    assert (got[2].run_id, got[2].phase, got[2].output_rows, got[2].clean_blob_name, got[2].duration_seconds, got[2].problem) == (None, "cleaning", 7, "clean/a", None, None)
    assert {k: got[k].problem for k in (3, 4, 5, 6, 7, 8)} == {**dict.fromkeys((3, 4, 5, 6, 8), "not a JSON object"), 7: "no raw_blob_name"}
    assert sorted(r["id"] for r in le.quarantined(out).collect()) == [3, 4, 5, 6, 7, 8] and got[8].payload == training[:40]


def test_digests(spark, tmp_dir):
    import hashlib

    from tabspark.operators import lineage as ln
    body = bytes(range(256)) * 5000
    with open(f"{tmp_dir}/model.bin", "wb") as f:
        f.write(body)
    assert ln.file_digest(spark, f"{tmp_dir}/model.bin") == hashlib.sha256(body).hexdigest()
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 1), (None, 2)], "x string, y int")
    one = ln.table_digest(df).first()
    assert one == ln.table_digest(df.repartition(3).orderBy("y")).first() and one["rows"] == 4
    other = [df.dropDuplicates(), df.limit(3), spark.createDataFrame([("a", 1), ("b", None), ("a", 1), ("-", 2)], "x string, y int")]
    assert len({one["sha256"], *(ln.table_digest(x).first()["sha256"] for x in other)}) == 4
    split = [spark.createDataFrame([r], "x string, y string") for r in (("a,1:b", "c"), ("a", "1:b,c"), ("a,1:b,1:c", None))]
    assert len({ln.table_digest(x).first()["sha256"] for x in split}) == 3
    assert ln.lineage(git_sha="abc")["git_sha"] == "abc" and ln.lineage()["container_image_digest"] is None


def test_published_versions(spark, tmp_dir):
    path, rows = f"{tmp_dir}/clean", lambda n: spark.range(n).withColumnRenamed("id", "k")
    assert sio.current_path(spark, path) == path   # nothing published: a plain folder
    assert [sio.publish(rows(n), path) for n in (3, 5, 7)] == [1, 2, 3]
    assert sio.versions(spark, path) == [2, 3] and sio.read_clean(spark, path).count() == 7
    before = sio.read_clean(spark, path)   # a reader that came before the next version
    with pytest.raises(sio.EmptyInputError):
        sio.publish(rows(0), path)
    assert sio.read_clean(spark, path).count() == 7   # an empty result publishes nothing, its number is gone
    assert sio.publish(rows(9), path) == 5 and before.count() == 7
    with pytest.raises(ValueError):
        sio.publish(rows(1), path, keep=0)


def test_publishers_at_a_time(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    path = f"{tmp_dir}/clean"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda n: sio.publish(spark.range(n), path, keep=4), (1, 2, 3, 4)))
    assert sorted(got) == [1, 2, 3, 4] == sio.versions(spark, path)
    assert sio.read_clean(spark, path).count() == got.index(4) + 1


def test_ledger_compaction(spark, tmp_dir):
    path = f"{tmp_dir}/ledger"
    assert le.compact_runs(spark, path) == 0
    for i in range(4):
        le.append_runs(le.run_record(spark, f"raw/{i % 2}", "cleaning", le.STATUS_COMPLETED, f"r{i}"), path)
    records = sorted(r.run_id for r in le.read_runs(spark, path).collect())
    latest = sorted(le.latest_runs(le.read_runs(spark, path)).collect())
    open(f"{path}/_compacting", "w").close()
    assert le.compact_runs(spark, path) == 0   # another one runs
    os.utime(f"{path}/_compacting", (0, 0))
    assert le.compact_runs(spark, path) == 4   # it died long ago
    assert len(glob.glob(f"{path}/*.parquet")) == 1 and not os.path.exists(f"{path}/_compacting")
    assert sorted(r.run_id for r in le.read_runs(spark, path).collect()) == records == ["r0", "r1", "r2", "r3"]
    assert sorted(le.latest_runs(le.read_runs(spark, path)).collect()) == latest
    # one that died after its rows came in leaves records twice until the next compaction
    le.append_runs(le.read_runs(spark, path), path)
    assert sorted(le.latest_runs(le.read_runs(spark, path)).collect()) == latest
    assert le.compact_runs(spark, path) == 2 and le.read_runs(spark, path).count() == 4
