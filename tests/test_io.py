"""Sources and sinks: CSV readers, format dispatch, host-agent files, tables,
compaction, JSON report sink, chunk functions."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlens.operators import aggregations as A
from loadlens.operators import chunks as U
from loadlens.operators import filters as P
from loadlens.plans import reports as R
from loadlens.sources import readers as S
from loadlens.sources import sinks as SK
from loadlens.sources import tables as TB
from loadlens.sources.views import logs_view, metrics_view

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="loadlens-io-")


def test_metrics_csv_reference_layout(spark, tmp):
    path = os.path.join(tmp, "synthetic_metrics.csv")
    with open(path, "w") as f:     # the documented hand rows, pandas-style timestamps
        f.write("timestamp,server_id,cpu_usage,memory_usage,disk_io,network_traffic,request_count,error_rate,response_time_ms\n")
        f.write("2024-01-01 09:00:00,web01,45.2,67.8,120.5,45.3,1500,0.5,145.2\n")
        f.write("2024-01-01 09:00:00,api02,78.9,45.1,89.3,120.7,2300,2.1,89.5\n")
        f.write("2024-01-01 09:01:00,web01,NaN,,1,1,1,1,1\n")
    df = S.read_metrics_csv(spark, path)
    rows = df.orderBy("timestamp", "server_id").collect()
    assert len(rows) == 3 and rows[0].server_id == "api02" and rows[0].request_count == 2300
    assert rows[2].cpu_usage is None and rows[2].memory_usage is None   # NaN and empty -> NULL


def test_access_log_csv_and_text(spark, tmp):
    from fixtures import SAMPLE_LOG
    p = os.path.join(tmp, "access.log")
    with open(p, "w") as f:
        f.write("\n".join(SAMPLE_LOG + ["", "garbage"]) + "\n")
    logs = S.read_access_log_text(spark, p)
    assert logs.count() == 10
    errs = S.read_access_log_errors(spark, p).collect()
    assert len(errs) == 1 and errs[0].reason == "no_match" and errs[0].file_path.endswith("access.log")
    out = os.path.join(tmp, "parsed")
    SK.write_csv(logs, out)
    back = S.read_access_logs_csv(spark, out)
    assert back.exceptAll(logs).count() == 0 and logs.exceptAll(back).count() == 0


def test_load_dispatch(spark, tmp):
    assert S.load(spark, f"{SF}/region.parquet").count() == 5
    with pytest.raises(ValueError):
        S.load(spark, os.path.join(tmp, "x.xlsx"))


def test_host_metrics_files(spark, tmp):
    cols = ["timestamp", "server_id", "cpu_usage", "cpu_user", "cpu_system", "memory_usage", "memory_used_gb",
            "memory_available_gb", "swap_usage", "disk_usage", "disk_read_mb", "disk_write_mb",
            "network_sent_mb", "network_recv_mb", "load_average"]
    for server in ("alpha", "beta"):
        pd.DataFrame([["2024-01-01 00:00:00", server] + [1.0] * 13]).to_csv(
            os.path.join(tmp, f"real_metrics_{server}_20240101.csv"), header=cols, index=False)
    df = S.read_host_metrics(spark, os.path.join(tmp, "real_metrics_*.csv"))
    assert df.count() == 2 and df.select("source_file").distinct().count() == 2


def test_drifting_host_files(spark, tmp):
    from loadlens.schemas import HOST_METRICS
    files = {"real_metrics_a_1.csv": "timestamp,server_id,cpu_usage\n2024-01-01 00:00:00,a,1.5\n2024-01-01 00:01:00,a,NaN\n",
             "real_metrics_b_1.csv": "\ufeffCPU, Host ,extra,Time\n2,b,x,2024-01-01 00:00:00\nCPU, Host ,extra,Time\n3,\"b,2\",,2024-01-01 00:00:01.5\n\n",
             "real_metrics_c_1.csv": "timestamp,server_id,cpu_usage\nnever,c,1\n2024-01-01 00:00:00,c,1,7\n2024-01-01 00:00:00,c,high\n",
             "real_metrics_d_1.csv": "", "real_metrics_e_1.csv": "timestamp,server_id\n", "other.csv": "a,b\n1,2\n"}
    for name, text in files.items():
        with open(os.path.join(tmp, name), "w", encoding="utf-8") as f:
            f.write(text)
    path = os.path.join(tmp, "real_metrics_*.csv")
    rows = S.read_host_metrics(spark, path)
    got = sorted((r.server_id, r.cpu_usage, os.path.basename(r.source_file), str(r.timestamp)) for r in rows.na.fill(-1.0).collect())
    assert got == [("a", -1.0, "real_metrics_a_1.csv", "2024-01-01 00:01:00"), ("a", 1.5, "real_metrics_a_1.csv", "2024-01-01 00:00:00"),
                   ("b", 2.0, "real_metrics_b_1.csv", "2024-01-01 00:00:00"), ("b,2", 3.0, "real_metrics_b_1.csv", "2024-01-01 00:00:01.500000")]
    assert rows.where("file_time is null or swap_usage is not null").count() == 0 and rows.columns[:15] == HOST_METRICS.fieldNames()
    errors = sorted(r.reason for r in S.read_file_errors(spark, path, HOST_METRICS, S.HOST_ALIASES).collect())
    assert errors == ["bad cpu_usage", "bad timestamp", "wrong number of cells"]
    layouts = {os.path.basename(r.source_file): (len(r.missing), r.unknown) for r in S.file_layouts(spark, path, HOST_METRICS, S.HOST_ALIASES).collect()}
    assert layouts == {"real_metrics_a_1.csv": (12, []), "real_metrics_b_1.csv": (12, ["extra"]), "real_metrics_c_1.csv": (12, []), "real_metrics_e_1.csv": (13, [])}


def test_tables_and_idempotent_load(spark, tmp):
    names = SK.create_tables(spark, tmp, suffix="_test")
    m = metrics_view(spark, SF)
    for _ in range(2):     # the second load replaces the first
        SK.load_table(m, names["server_metrics"], "server_metrics")
        assert spark.table(names["server_metrics"]).count() == m.count()
    one = spark.table(names["server_metrics"]).where("month = date'1995-03-01'")
    assert one.count() == m.where("date_trunc('month', timestamp) = timestamp'1995-03-01'").count() > 0
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().toString()


def scanned(df):
    """Files that the scans of ``df`` open, and the partition filters of its plan."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        plan.execute().count()
        leaves = plan.collectLeaves()
        counts = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numFiles")]
        return counts, [x.split("]")[0] for x in plan.toString().split("PartitionFilters: [")[1:]]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_time_filters_read_only_their_partitions(spark, tmp):
    names = SK.create_tables(spark, tmp, suffix="_pruned")
    logs = logs_view(spark, SF)
    SK.load_table(logs, names["access_logs"], "access_logs")
    table = TB.open_table(spark, names["access_logs"])
    days = logs.select(F.to_date("timestamp")).distinct().count()
    files = scanned(table)[0][0]
    assert days >= 28 and files >= days
    between = dict(start="2024-01-05 10:00:00", end="2024-01-06 09:00:00", ordered=False)
    for plain, pruned, most in [(P.retention(logs, "2024-01-31 00:00:00", 7), P.retention(table, "2024-01-31 00:00:00", 7), 8),
                                (P.metrics_filter(logs, **between), P.metrics_filter(table, **between), 2)]:
        counts, filters = scanned(pruned)
        assert 0 < counts[0] <= most * files // days + 1 and "day" in filters[0]
        out = TB.data_columns(pruned)
        assert out.count() == plain.count() > 0 and out.exceptAll(plain).count() == 0
    stats = A.access_log_stats(table, "2024-01-10 00:00:00", 24)
    assert scanned(stats)[0][0] <= 3 and stats.collect() == A.access_log_stats(logs, "2024-01-10 00:00:00", 24).collect()


def test_months_bound_the_metrics_table(spark, tmp):
    names = SK.create_tables(spark, tmp, suffix="_months")
    m = metrics_view(spark, SF)
    SK.load_table(m, names["server_metrics"], "server_metrics")
    args = dict(server_id="server_7", start="1995-02-10", end="1995-04-03", ordered=False)
    hit = P.metrics_filter(TB.open_table(spark, names["server_metrics"]), **args)
    counts, filters = scanned(hit)
    assert counts[0] <= 4 and "month" in filters[0]
    assert sorted(TB.data_columns(hit).collect()) == sorted(P.metrics_filter(m, **args).collect())
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    assert "EqualTo(server_id,server_7)" in TB.data_columns(hit).select("*")._jdf.queryExecution().toString()    # the sorted files' row groups
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("most", [10 ** 6, 0])
def test_windows_prune_partitions_while_running(spark, tmp, monkeypatch, most):
    monkeypatch.setattr(TB, "MAX_BROADCAST_WINDOWS", most)
    names = SK.create_tables(spark, tmp, suffix=f"_windows{most}")
    logs = logs_view(spark, SF)
    SK.load_table(logs, names["access_logs"], "access_logs")
    rows = [("2024-01-03 22:00:00", "2024-01-04 02:00:00", "a"), ("2024-01-03 12:00:00", "2024-01-04 12:00:00", "b"), ("2024-01-20 00:00:00", "2024-01-21 00:00:00", "c"),
            ("2024-01-09 05:00:00", "2024-01-09 04:00:00", "reversed"), (None, "2024-01-09 04:00:00", "open"), ("2024-01-09 05:00:00", "2024-01-09 05:00:00", "empty")]
    windows = spark.createDataFrame(rows, "start string, end string, name string")\
        .select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "name")
    table = TB.open_table(spark, names["access_logs"])
    hits = TB.rows_in_windows(table, windows)
    want = logs.join(windows, (F.col("timestamp") >= F.col("start")) & (F.col("timestamp") < F.col("end")))
    assert sorted(TB.data_columns(hits).collect(), key=str) == sorted(want.select(*TB.data_columns(hits).columns).collect(), key=str)
    assert {r["name"] for r in hits.select("name").distinct().collect()} == {"a", "b", "c"}
    if most:
        counts, filters = scanned(hits)
        assert any("dynamicpruning" in f for f in filters) and max(counts) <= 6
    plain = TB.rows_in_windows(logs, windows)                # a frame without partitions: joined on computed days
    assert plain.count() == want.count()


def test_load_refuses_null_times(spark, tmp):
    names = SK.create_tables(spark, tmp, suffix="_nulls")
    m = metrics_view(spark, SF)
    bad = m.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="NULL in timestamp"):
        SK.load_table(m.unionByName(bad), names["server_metrics"], "server_metrics")


def test_compaction_keeps_every_row(spark, tmp):
    m = metrics_view(spark, SF)
    src = os.path.join(tmp, "parts")
    SK.write_parquet(m.repartition(5), src)
    out = SK.compact(spark, src, os.path.join(tmp, "compact"))
    assert out.count() == m.count() and len(out.inputFiles()) == 1


def test_compaction_packs_by_size(spark, tmp):
    """One large file and 400 small ones: every output within a fifth of the target."""
    src, dest = os.path.join(tmp, "mixed"), os.path.join(tmp, "packed")
    noise = lambda n, seed: spark.range(n).select("id", F.concat(*[F.sha2(F.concat("id", F.lit(seed + i)), 256) for i in range(8)]).alias("blob"))
    noise(8_000, 100).coalesce(1).write.option("parquet.block.size", 128 * 1024).parquet(src)              # about 4 MB in many row groups
    noise(16_000, 900).repartition(400).write.mode("append").parquet(src)
    listed = SK.folder_bytes(spark, src).first()
    assert listed.files == 401
    target = 1.7
    out = SK.compact(spark, src, dest, target_file_mb=target)
    sizes = [os.path.getsize(os.path.join(dest, f)) / 2 ** 20 for f in os.listdir(dest) if f.endswith(".parquet")]
    assert len(sizes) >= 4 and all(0.8 * target <= x <= 1.2 * target for x in sizes), sizes
    assert out.count() == 24_000 and out.agg(F.sum("id")).first()[0] == sum(range(8_000)) + sum(range(16_000))
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "0b"


def test_report_sink_and_footprint(spark, tmp):
    m = metrics_view(spark, SF)
    R.write_report(R.basic_report(m), os.path.join(tmp, "report"))
    assert spark.read.json(os.path.join(tmp, "report")).count() >= 3
    fp = {r.format: r for r in SK.storage_footprint(m, os.path.join(tmp, "fp")).collect()}
    assert fp["csv"].ratio == 1.0 and fp["parquet_snappy"].bytes < fp["csv"].bytes


def test_footprint_copies_do_not_lie_side_by_side(spark, tmp, monkeypatch):
    from collections import Counter
    rows = spark.range(0, 24_000, 1, 40).select(       # ids that come twice or are null, cells that need quotes
        F.when(F.col("id") % 50 > 0, F.col("id") % 16_000).alias("id"), F.sin("id").alias("cpu_usage"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "b", '), F.col("id") % 7)).alias("server_id"))
    base, held, written, ids = os.path.join(tmp, "foot print"), [], Counter(), {}

    def weight(path):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))

    def watched(write):
        def run(df, path, *args, **options):
            write(df, path, *args, **options)
            name = os.path.basename(path)
            held.append(weight(base))
            written[name] += weight(path)
            ids.setdefault(name, Counter()).update(r.id for r in df.select("id").collect())
        return run

    monkeypatch.setattr(SK, "SHARE_BYTES", 1, raising=False)
    for name in ("write_csv", "write_json", "write_parquet"):
        monkeypatch.setattr(SK, name, watched(getattr(SK, name)))
    found = {r.format: r for r in SK.storage_footprint(rows, base).collect()}
    assert max(held) < 0.5 * sum(written.values()) and weight(base) == 0
    every = Counter(r.id for r in rows.collect())
    assert set(found) == set(ids) == {"csv", "json", "parquet_gzip", "parquet_snappy"}
    for name, r in found.items():                       # all rows in every format, each once; all bytes weighed
        assert ids[name] == every and r.rows == 24_000 and r.bytes == written[name], name
        assert r.size_mb == pytest.approx(r.bytes / 2 ** 20, abs=0.006) and r.ratio == pytest.approx(written["csv"] / r.bytes, abs=0.006)
    none = {r.format: r for r in SK.storage_footprint(rows.where("cpu_usage > 2"), base).collect()}
    assert len(none) == 4 and all(r.rows == 0 for r in none.values()) and none["json"].ratio == 0.0


def test_chunks(spark):
    m = metrics_view(spark, SF)
    s = U.chunk_summary(m).first()
    ref = m.agg(F.count(F.lit(1)), F.avg("cpu_usage"), F.max("response_time_ms")).first()
    assert s.rows == ref[0] and abs(s.avg_cpu - ref[1]) < 1e-9 and s.max_response == ref[2]
    per = U.chunk_summaries(m)
    assert per.agg(F.sum("rows")).first()[0] == ref[0]
    assert U.chunk_summaries(m.select("server_id")).first().avg_cpu == 0.0   # absent column -> 0
    absent = U.chunk_summary(m.select("server_id")).first()
    assert (absent.rows, absent.avg_cpu, absent.max_response) == (ref[0], 0.0, 0.0)
    small = U.chunk_summaries(m.coalesce(1), 1000).collect()                # batches are cut and joined to the chunk size
    assert [r.rows for r in small[:-1]] == [1000] * (len(small) - 1) and sum(r.rows for r in small) == ref[0]
    assert U.chunk_summaries(m.coalesce(1), 100_000).count() == 1


def test_nan_is_missing_everywhere(spark, tmp):
    p = os.path.join(tmp, "x.parquet")
    spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "cpu_usage double").write.parquet(p)
    assert S.load(spark, p).where("cpu_usage is null").count() == 2


def test_checkpoint_folder_is_required_off_local(spark):
    from types import SimpleNamespace
    from loadlens.session import ensure_checkpoint_dir
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(far)


def test_csv_records_with_faults_are_set_aside(spark, tmp):
    from loadlens.schemas import METRICS
    header = "timestamp,server_id,cpu_usage,memory_usage,disk_io,network_traffic,request_count,error_rate,response_time_ms\n"
    good = "2024-01-01 09:00:00,web01,45.2,NaN,,1,2,0.5,145.2\n"
    bad = ["2024-01-01 09:00:00,web01,45.2\n", good.strip() + ",9\n", "2024-02-30 09:00:00,web01,1,1,1,1,1,1,1\n", ",web01,1,1,1,1,1,1,1\n", "2024-01-01 09:00:00,,1,1,1,1,1,1,1\n",
           "2024-01-01 09:00:00,web01,high,1,1,1,1.5,1,1\n", "2024-01-01,web01,1,1,1,1,1,1,1\n"]
    for i, lines in enumerate([bad[:3] + [good], [good] + bad[3:], [good]]):
        with open(os.path.join(tmp, f"m{i}.csv"), "w") as f:
            f.write(header + "".join(lines))
    rows = S.read_metrics_csv(spark, tmp)
    assert rows.count() == 3 and rows.select("server_id").count() == 3
    first = rows.first()
    assert first.memory_usage is None and first.disk_io is None and first.request_count == 2
    errors = S.read_csv_errors(spark, tmp, METRICS)
    by = sorted((r.reason, os.path.basename(r.file_path)) for r in errors.collect())
    assert len(by) == 7 == errors.count() and {f for _, f in by} == {"m0.csv", "m1.csv"}
    reasons = [r for r, _ in by]
    assert "bad cpu_usage, bad request_count" in reasons and "no timestamp" in reasons and "no server_id" in reasons and reasons.count("bad timestamp") == 2
    assert sum("wrong number of cells" in r for r in reasons) == 2
    assert errors.where("record like '%high%'").count() == 1
    assert S.read_csv_rows(spark, tmp, METRICS, "file").select("file").distinct().count() == 3
