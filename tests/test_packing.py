"""Stored compaction (K3), archive members packed by size (S3), messages in rows of bounded length (A10)."""

import os
import zipfile

from pyspark.sql import functions as F

from tenderlake.operators.metrics import joined_errors
from tenderlake.sinks import table
from tenderlake.sinks.table import compact_stored, compaction_plan, empty_entries, read_entries, table_files, write_entries
from tenderlake.sources.archives import list_archives, list_members, packed, read_archive_entries


def stored(spark, n, period):
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("public-tenders").alias("procurement_type"), F.lit(period).alias("period"))
    return empty_entries(spark).unionByName(rows, allowMissingColumns=True)


def test_only_partitions_of_small_files_are_rewritten(spark, tmp_root):
    out = f"{tmp_root}/t"
    write_entries(stored(spark, 50, "202301").coalesce(1), out, max_records_per_file=10)
    write_entries(stored(spark, 30, "202302").coalesce(1), out)
    files = {r.period: r.file for r in table_files(spark, out).where("period = '202302'").collect()}
    assert [(r.period, r.n_files, r.files_after) for r in compaction_plan(spark, out).collect()] == [("202301", 5, 1)]
    plan = compact_stored(spark, out).collect()
    assert [(r.period, r.n_files, r.files_after) for r in plan] == [("202301", 5, 1)]
    after = {}
    for r in table_files(spark, out).collect():
        after.setdefault(r.period, []).append(r.file)
    assert len(after["202301"]) == 1 and after["202302"] == [files["202302"]]
    assert sorted(int(r.id) for r in read_entries(spark, out).where("period = '202301'").collect()) == list(range(50))
    assert compact_stored(spark, out).count() == 0
    # a target below a partition's size gives it several files again
    size = table_files(spark, out).where("period = '202301'").first().bytes
    write_entries(read_entries(spark, out).where("period = '202301'").repartition(7), out)
    done = compact_stored(spark, out, target_bytes=4 * size).collect()
    assert all(1 < r.files_after < r.n_files for r in done)
    assert table_files(spark, out).where("period = '202301'").count() == [r.files_after for r in done if r.period == "202301"][0]
    assert read_entries(spark, out).where("period = '202301'").count() == 50


def tasks_of(spark, out, period):
    names = [os.path.basename(r.file) for r in table_files(spark, out).where(F.col("period") == period).collect()]
    return len(names), {n.split("-")[1] for n in names}


def test_small_files_are_written_by_many_tasks(spark, tmp_root, monkeypatch):
    """A rebalance by bytes leaves a few MB of rows, and all their files, to one or two tasks."""
    rows = stored(spark, 1200, "").withColumn("period", F.concat(F.lit("2023"), F.lpad((F.col("id").cast("int") % 40).cast("string"), 2, "0")))
    write_entries(rows, f"{tmp_root}/t", compact=True, max_records_per_file=8)
    found = [tasks_of(spark, f"{tmp_root}/t", f"2023{k:02d}") for k in range(40)]
    assert all(n == 4 and len(tasks) == 1 for n, tasks in found) and len({t for _, ts in found for t in ts}) > 4
    assert sorted(int(r.id) for r in read_entries(spark, f"{tmp_root}/t").collect()) == list(range(1200))
    # a hot partition, of equal rows too, is written in runs of whole files; null periods are a partition as well
    monkeypatch.setattr(table, "RUN_FILES", 2)
    hot = stored(spark, 95, "202301").withColumn("id", F.when(F.col("id").cast("int") < 60, "same").otherwise(F.col("id")))
    write_entries(hot.unionByName(stored(spark, 25, None)), f"{tmp_root}/hot", compact=True, max_records_per_file=10)
    n, tasks = tasks_of(spark, f"{tmp_root}/hot", "202301")
    assert n == 10 and len(tasks) > 1 and tasks_of(spark, f"{tmp_root}/hot", "__HIVE_DEFAULT_PARTITION__")[0] == 3
    assert dict(read_entries(spark, f"{tmp_root}/hot").groupBy("id").count().collect()) == {"same": 60} | {str(k): 1 for k in [*range(25), *range(60, 95)]}


def test_members_are_packed_by_size(spark, tmp_root):
    entry = "<entry><id>{}</id></entry>"
    os.makedirs(tmp_root, exist_ok=True)
    for k in range(3):
        with zipfile.ZipFile(f"{tmp_root}/20230{k + 1}.zip", "w") as zf:
            for i in range(40):
                zf.writestr(f"d/{i}.xml", "<feed>" + entry.format(i) * (1 + i % 3) + "</feed>")
            zf.writestr("big.xml" if k == 0 else "README", "<feed>" + entry.format("big") * 400 + "</feed>")
            zf.writestr("../out.xml", "<feed/>")
            zf.writestr("empty.xml", "")
    members = list_members(spark, list_archives(spark, tmp_root).select("uri"))
    assert members.count() == 3 * 41 + 1
    largest = members.agg(F.max("bytes")).first()[0]
    for tasks in (1, 4, 50):
        dealt, n = packed(members, tasks)
        loads = {r.task: r.b for r in dealt.groupBy("task").agg(F.sum("bytes").alias("b")).collect()}
        total = sum(loads.values())
        assert dealt.count() == 124 and all(0 <= t < n for t in loads) and n <= tasks + 1
        assert max(loads.values()) < max(-(-total // tasks), largest) + largest
    rows = read_archive_entries(spark, tmp_root, partitions=4)
    assert rows.count() == 400 + 3 * sum(1 + i % 3 for i in range(40))
    none, n = packed(members.limit(0), 4)
    assert none.count() == 0 and n == 1


def test_messages_in_parts(spark):
    rows = [("a", f"m{i % 7}" * (1 + i % 5)) for i in range(200)] + [("b", "only"), ("c", None)]
    items = spark.createDataFrame(rows, "g string, error string").repartition(6)
    for limit in (10, 64, 10_000):
        want, ordered, at = {}, sorted(m for g, m in rows if g == "a"), 0
        for m in ordered:
            want.setdefault(at // limit, []).append(m)
            at += len(m) + 2
        got = {(r.g, r.part): r.errors for r in joined_errors(items, "g", limit=limit).collect()}
        assert got == {("a", k): "; ".join(v) for k, v in want.items()} | {("b", 0): "only"}
