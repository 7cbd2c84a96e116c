"""JSON experiment scan / flatten / rejects / ingest on hand-written fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from netscope.sources import experiments as E
from netscope.sources.ingest import ingest


def _w(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)
    return p


def _rec(**over):
    r = {"start": 1433498540, "proto": "udp", "exp_name": "e1", "duration": "300",
         "camp": {"region_snd": "eu-west-1", "region_rcv": "us-east-1", "size_snd": "a2.medium", "size_rcv": "a2.medium"},
         "info_snd": {"tool": "NUTTCP_S", "granularity": 0.1, "target_bwd": "2000000000", "ip_sender": "1.2.3.4",
                      "port": "18100", "start_time": 1433498540},
         "info_rcv": {"tool": "NUTTCP_R", "granularity": "1"},
         "results": {"tput": {"detailed": {"1433498541": 1.0, "1433498540": 3.0, "1433498542": 2.0},
                              "synt": {"mean": 2.0, "median": 2.0, "min": 1.0, "max": 3.0, "std": 0.816496580927726,
                                       "pctl5": 1.1, "pctl25": 1.5, "pctl75": 2.5, "pctl95": 2.9}},
                     "delay": {"detailed": None, "synt": {"mean": 120.5}},
                     "loss": {"detailed": [0.1, 0.2], "synt": {"mean": 0.15}}}}
    r.update(over)
    return r


@pytest.fixture()
def tree(workdir):
    root = os.path.join(workdir, "raw")
    _w(root, "Azure/a2.medium_tput_udp/Fig5/x_1433498540_results.json", json.dumps([_rec(), _rec(exp_name="e2")]))
    _w(root, "AWS/m3.xlarge_tput_tcp/US-EU/y_1426345644_results.json", json.dumps(_rec(exp_name="e3", proto="", protocol="tcp")))
    _w(root, "AWS/m3.xlarge_tput_tcp/US-EU/empty_1_results.json", "")
    _w(root, "AWS/m3.xlarge_tput_tcp/US-EU/bad_2_results.json", "{bad")
    _w(root, "AWS/m3.xlarge_tput_tcp/US-EU/scalar_3_results.json", "5")
    _w(root, "AWS/m3.xlarge_tput_tcp/US-EU/nores_4_results.json", json.dumps([_rec(exp_name="n1", results=None),
                                                                           _rec(exp_name="n2", results={})]))
    _w(root, "Azure/a2.medium_tput_udp/Fig5/dur_5_results.json", json.dumps(
        [_rec(exp_name="d1", duration=""), _rec(exp_name="d2", duration="abc"), _rec(exp_name="d3", duration=" 5 "),
         _rec(exp_name="r1", camp={"region_snd": "", "region_rcv": "x"})]))
    _w(root, "top_6_results.json", json.dumps(_rec(exp_name="top")))
    return root


def test_flatten_golden(spark, tree):
    raw = E.read_raw(spark, tree)
    exp = E.flatten(raw, tree)
    rows = {r["exp_name"]: r for r in exp.collect()}
    assert set(rows) == {"e1", "e2", "e3", "d1", "d2", "d3", "r1", "top"}
    e1 = rows["e1"]
    assert e1["provider"] == "Azure" and e1["region_pair"] == "eu-west-1->us-east-1"
    assert e1["tput_n"] == 3 and e1["loss_n"] == 2 and e1["delay_n"] is None
    assert e1["tput_mean"] == 2.0 and e1["delay_mean"] == 120.5
    assert e1["granularity_snd"] == 0.1 and e1["granularity_rcv"] == 1.0 and e1["target_bwd"] == 2e9
    assert str(e1["start_dt"]) == "2015-06-05 10:02:20"
    assert rows["e3"]["proto"] == "tcp" and rows["e3"]["provider"] == "AWS"
    assert rows["d1"]["duration_s"] is None and rows["d2"]["duration_s"] is None and rows["d3"]["duration_s"] == 5.0
    assert rows["r1"]["region_pair"] is None
    assert rows["top"]["provider"] == "Unknown"
    assert exp.columns[:20] == E.EXPERIMENT_IDS


def test_rejects(spark, tree):
    rej = {(os.path.basename(r["path"]), r["reason"]) for r in E.rejects(spark, tree).collect()}
    assert ("empty_1_results.json", "empty") in rej
    assert ("bad_2_results.json", "invalid_json") in rej
    assert ("scalar_3_results.json", "invalid_json") in rej
    assert ("nores_4_results.json", "no_results") in rej


def test_series_explode(spark, tree):
    s = E.explode_series(E.read_raw(spark, tree), tree)
    e1 = s.where((F.col("exp_name") == "e1") & (F.col("metric") == "tput")).orderBy("ts").collect()
    assert [r["value"] for r in e1] == [3.0, 1.0, 2.0]


def test_streaming_build(spark, tree, workdir):
    from netscope.streaming.ingest_stream import run_available
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    run_available(spark, tree, out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 8
    run_available(spark, tree, out, ck)  # nothing new: exactly-once per file
    assert spark.read.parquet(out).count() == 8


def test_ingest_tags_and_skips(spark, workdir):
    root = os.path.join(workdir, "blobs")
    _w(root, "AWS/m3.xlarge_tput_udp/US-EU/1426345644.json",
       json.dumps([{"protocol": "tcp", "exp_name": "a", "start_time": 1}, {"protocol": "udp", "exp_name": "b"}, 7]))
    _w(root, "Azure/a2.medium/EU/zone1/x.json", json.dumps({"protocol": "icmp", "provider": "overwritten"}))
    _w(root, "AWS/m3.xlarge_tput_udp/US-EU/readme.txt", "hello")
    _w(root, "AWS/short.json", json.dumps({"a": 1}))
    _w(root, "AWS/m3.xlarge_tput_udp/US-EU/empty.json", "")
    tagged, skipped = ingest(spark, root)
    rows = sorted((r["provider"], r["region"], r["az"], r["vm_size"], r["l4_protocol"], r["protocol"])
                  for r in tagged.collect())
    assert rows == [("AWS", "US-EU", None, "m3.xlarge", "tput_udp", "tcp"),
                    ("AWS", "US-EU", None, "m3.xlarge", "tput_udp", "udp"),
                    ("Azure", "EU", "zone1", "a2.medium", "UNKNOWN", "icmp")]
    reasons = sorted(r["reason"] for r in skipped.collect())
    assert reasons == ["empty", "not_json", "not_object", "short_path"]


def test_parquet_scan_pushdown_and_footers(spark, workdir):
    from netscope.sources.parquet import parquet_metadata, read_parquet, write_partitioned
    df = spark.range(100).select((F.col("id") % 3).alias("part"), F.col("id"), (F.col("id") * 2).alias("v"))
    path = os.path.join(workdir, "pq")
    write_partitioned(df, path, ["part"])
    out = read_parquet(spark, path, columns=["id"], filters=[("part", "=", 1), ("v", ">", 10)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: [IsNotNull(v), GreaterThan(v,10)]" in plan
    assert out.count() == len([i for i in range(100) if i % 3 == 1 and 2 * i > 10])
    with open(os.path.join(path, "junk.parquet"), "w") as f:
        f.write("not parquet")
    meta = parquet_metadata(spark, path).collect()
    junk = [r for r in meta if r["path"].endswith("junk.parquet")]
    assert len(junk) == 1 and junk[0]["valid"] is False and junk[0]["error"]
    good = [r for r in meta if r["valid"]]
    assert sum(r["num_rows"] for r in good) == 100


def test_csv_roundtrip(spark, workdir):
    from netscope.sinks import read_any, write_dataset
    df = spark.range(10).select("id", (F.col("id") / 2).alias("x"))
    p = write_dataset(df, os.path.join(workdir, "csvout"), "csv")
    back = read_any(spark, p)
    assert back.count() == 10 and set(back.columns) == {"id", "x"}


def test_generic_flatten_and_path_metadata(spark, workdir):
    from netscope.sources.generic_json import flatten_records, read_records
    root = os.path.join(workdir, "PaperDataset")
    _w(root, "AWS/m3.xlarge_tput_udp/US-EU/1426345644.json", json.dumps([
        {"protocol": "tcp", "exp_name": "t1", "start_time": 1426345644, "duration": "120", "granularity": "1",
         "hops": [1, 2, 3], "mixed": [1, "a"], "empty": [], "nested": {"a": 1, "deep": {"x": 1}}, "none": None},
        {"protocol": "udp", "exp_name": "t2", "granularity": 0.1}]))
    _w(root, "Azure/a2.medium_tput_tcp/Fig5/x.json", json.dumps({"tool": "HPING_S"}))
    _w(root, "Other/thing/y.json", "5")
    recs = read_records(spark, root)
    wide = {r["exp_name"] or r["tool"]: r for r in flatten_records(recs, root).collect()}
    t1 = wide["t1"]
    assert t1["provider"] == "AWS" and t1["vm_size"] == "XLarge" and t1["protocol"] == "tcp"
    assert t1["timestamp"] == 1426345644 and t1["hops_mean"] == "2.0" and t1["hops_count"] == "3"
    assert t1["nested_a"] == "1" and "nested_deep" not in wide["t1"].asDict() and "mixed_mean" not in t1.asDict()
    assert wide["t2"]["granularity"] == "0.1" and wide["t2"]["hops_mean"] is None
    hp = wide["HPING_S"]
    assert hp["provider"] == "Azure" and hp["vm_size"] == "Medium" and hp["protocol"] == "TCP_Throughput"
    assert len(wide) == 3


def test_generic_flatten_without_merge_and_prepare(spark, workdir):
    from netscope.operators.clean import prepare
    from netscope.sources.generic_json import flatten_records, read_records
    root = os.path.join(workdir, "PD")
    _w(root, "AWS/m3.xlarge_tput_udp/US-EU/1426345644.json", json.dumps(
        [{"protocol": "tcp", "Exp Name": "a", "duration": "120"}, {"protocol": "tcp", "Exp Name": "a", "duration": "120"},
         {"protocol": "udp", "Exp Name": "b"}]))
    wide = flatten_records(read_records(spark, root), root, merge=False)
    rows = wide.collect()
    assert {r["path_protocol"] for r in rows} == {"UDP_Throughput"} and {r["protocol"] for r in rows} == {"tcp", "udp"}
    typed = wide.drop("rec_id").withColumn("duration", F.col("duration").try_cast("double"))
    prep = prepare(typed).collect()  # names normalised, duplicates dropped, median / Unknown fills
    assert len(prep) == 2 and {r["exp_name"] for r in prep} == {"a", "b"}
    assert all(r["duration"] == 120.0 for r in prep)


def test_listing_by_tasks(spark, workdir):
    """Names, lengths and empty files come from one task per folder, however deep; hidden names are passed over."""
    from netscope.sinks import latest_file, write_objects
    from netscope.sources.listing import Reader, find_root, list_files
    root = os.path.join(workdir, "deep")
    names = [f"p{i % 3}/vm={i % 5}/a/b/c/f {i}.json" for i in range(40)] + ["top.json", "p0/e.txt", "p0/_tmp/x.json", "p0/.y.json"]
    rows = spark.createDataFrame([(n, "" if i % 7 == 0 else "{}") for i, n in enumerate(names)], "rel_path string, text string")
    assert write_objects(rows, root) == len(names)
    want = {("file:" + os.path.join(root, n), 0 if i % 7 == 0 else 2) for i, n in enumerate(names[:42])}
    for bound in (1, 2, 7, 4096):
        assert {(r["path"], r["length"]) for r in list_files(spark, root, "*", bound).collect()} == want
        folders = Reader(root, "*", bound).partitions()
        assert len({p.path for p in folders}) == len(folders) and len(folders) <= bound + 5
    assert list_files(spark, "file://" + root, "*.txt").count() == 1
    assert latest_file(spark, root, "*.txt").endswith("p0/e.txt")
    assert find_root(spark, [root + "-none", root]) == root
    with pytest.raises(FileNotFoundError):
        find_root(spark, [root + "-none"])
    with pytest.raises(Exception, match="no such folder"):
        list_files(spark, root + "-none").count()
