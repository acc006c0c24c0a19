"""Versions of stored datasets, cohorts tied to their inputs, and bucketed stores."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from chartloom.operators.reports import stored_report
from chartloom.plans import site_b
from chartloom.sources import sinks
from chartloom.sources.catalog import Catalog, table_sources
from chartloom.sources.files import facts, read_text, replace_text
from chartloom.sources.sinks import ParquetSink, TableSink

from plan_text import plan_of


def found(df):
    return sorted(tuple(r) for r in df.collect())


def folders(path):
    return sorted(f for f in os.listdir(path) if not f.startswith((".", "_")))


def jobs(spark, action):
    """Result of ``action`` and the number of jobs it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def broken(df):
    """Fails in the middle of the rows."""
    return df.repartition(3).withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))


@pytest.fixture(params=["files", "tables"])
def sink(request, spark, tmp_path):
    if request.param == "files":
        return ParquetSink(spark, str(tmp_path))
    return TableSink(spark, "versions_" + uuid.uuid4().hex[:8], root=str(tmp_path))


def test_a_stage_may_read_the_version_it_replaces(spark, sink):
    sink.publish("n", spark.range(10).toDF("n"))
    old = sink.find("n")
    new = sink.publish("n", old.where("n > 4").union(old.select(F.col("n") * 100)))
    assert found(new) == [(n,) for n in [0, 5, 6, 7, 8, 9, *range(100, 1000, 100)]] and found(old) == [(n,) for n in range(10)]
    assert sink.about("n")["rows"] == 15


def test_a_failure_in_mid_write_leaves_the_old_version(spark, sink):
    sink.publish("n", spark.range(10).toDF("n"))
    with pytest.raises(Exception, match="lost"):
        sink.publish("n", broken(sink.find("n")))
    assert found(sink.find("n")) == [(n,) for n in range(10)]
    if isinstance(sink, TableSink):
        assert found(spark.table(f"{sink.database}.n")) == [(n,) for n in range(10)]
    home = os.path.join(sink.root, sink.database, "n") if isinstance(sink, TableSink) else os.path.join(sink.root, "n")
    assert folders(home) == [sink.about("n")["version"]]


def test_a_refresh_may_change_the_columns_and_old_versions_go(spark, sink):
    for k in range(4):
        sink.publish("n", spark.range(k + 1).select(F.col("id").alias("n"), F.lit(f"v{k}").alias(f"c{k}")))
    assert sink.find("n").columns == ["n", "c3"] and sink.find("n").count() == 4
    home = os.path.join(sink.root, sink.database, "n") if isinstance(sink, TableSink) else os.path.join(sink.root, "n")
    assert len(folders(home)) == 2


def test_a_new_catalog_reads_published_tables(spark, tmp_path):
    layer = "layer_" + uuid.uuid4().hex[:8]
    stages = {f"{layer}.a": lambda cat: cat["base"].withColumn("m", F.col("n") + 1), f"{layer}.b": lambda cat: cat[f"{layer}.a"].where("m > 2")}
    Catalog(spark, {"base": lambda: spark.range(5).toDF("n")}, stages).refresh(TableSink(spark, root=str(tmp_path)), list(stages))
    assert found(Catalog(spark, table_sources(spark))[f"{layer}.b"]) == [(2, 3), (3, 4), (4, 5)]


def test_texts_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "note")
    assert read_text(spark, path) is None
    for text in ("one", "zwei é", ""):
        replace_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [f for f in os.listdir(tmp_path) if "note." in f and not f.endswith(".crc")] == []


STAGES = {
    "cohort": lambda cat: cat["orders"].where(F.col("n") >= cat.option("least", 3)),
    "named": lambda cat: cat["cohort"].join(cat["names"], "n", "left"),
    "other": lambda cat: cat["names"].where("n > 1"),
}


def cohort_catalog(spark, root, **options):
    sources = {t: (lambda t=t: spark.read.schema("n long" + (", name string" if t == "names" else "")).parquet(f"{root}/{t}")) for t in ("orders", "names")}
    return Catalog(spark, sources, STAGES, options=options, shared=["cohort", "named"], workspace=ParquetSink(spark, f"{root}/store"))


def test_cohorts_follow_their_inputs(spark, tmp_path):
    root = str(tmp_path)
    spark.range(6).toDF("n").write.parquet(f"{root}/orders")
    spark.createDataFrame([(4, "four")], "n long, name string").write.parquet(f"{root}/names")
    assert found(cohort_catalog(spark, root)["cohort"]) == [(3,), (4,), (5,)]

    cohort, started = jobs(spark, lambda: cohort_catalog(spark, root)["cohort"])
    assert started == 0 and found(cohort) == [(3,), (4,), (5,)]  # nothing changed: no job

    named = cohort_catalog(spark, root)["named"]
    assert sorted(map(tuple, named.fillna("").collect())) == [(3, ""), (4, "four"), (5, "")]
    spark.range(7, 9).toDF("n").write.mode("append").parquet(f"{root}/orders")
    assert found(cohort_catalog(spark, root)["cohort"]) == [(3,), (4,), (5,), (7,), (8,)]
    assert cohort_catalog(spark, root)["named"].count() == 5  # through the cohort it reads
    spark.createDataFrame([(4, "IV"), (5, "V")], "n long, name string").write.mode("overwrite").parquet(f"{root}/names")
    _, started = jobs(spark, lambda: cohort_catalog(spark, root)["cohort"])
    assert started == 0  # reads no names
    assert {r["name"] for r in cohort_catalog(spark, root)["named"].collect()} == {None, "IV", "V"}


def test_options_have_stores_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    spark.range(6).toDF("n").write.parquet(f"{root}/orders")
    assert cohort_catalog(spark, root)["cohort"].count() == 3 and cohort_catalog(spark, root, least=5)["cohort"].count() == 1
    for options, rows in (({}, 3), ({"least": 5}, 1)):
        cat, started = jobs(spark, lambda: (c := cohort_catalog(spark, root, **options), c["cohort"])[0])
        assert started == 0 and cat.rows("cohort") == rows


def test_rows_given_by_a_program_are_told_apart(spark, tmp_path):
    stages = {"twice": lambda cat: cat["given"].select((F.col("n") * 2).alias("n"))}

    def catalog(*rows):
        given = spark.createDataFrame([(r,) for r in rows], "n long")
        return Catalog(spark, {"given": lambda: given}, stages, shared=["twice"], workspace=ParquetSink(spark, str(tmp_path)))

    assert found(catalog(1, 2)["twice"]) == [(2,), (4,)] and found(catalog(5)["twice"]) == [(10,)]


def test_bucketed_stores_join_without_a_shuffle(spark, tmp_path):
    sink = ParquetSink(spark, str(tmp_path), bucket_by={"a": "k", "b": "k", "c": "k"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = [sink.publish(n, spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(n).alias(f"{n}_v"))) for n in "abc"]
        joined = sides[0].join(sides[1], "k", "left").join(sides[2], "k", "left").groupBy("k").agg(F.count("*").alias("n"))
        assert joined.count() == 200 and "Exchange" not in plan_of(joined)
        again = ParquetSink(spark, str(tmp_path), bucket_by=sink.bucket_by).find("a")
        assert again.count() == 200 and "Exchange" not in plan_of(again.join(sides[1], "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_facts(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    names = facts(spark, [str(tmp_path / "t")])
    assert any(n.endswith("_SUCCESS") for n, _, _ in names) and all(size >= 0 and when > 0 for _, size, when in names)


def test_stages_are_stored_at_the_same_time_and_once(spark, tmp_path):
    made = []

    def stage(name, *reads):
        def build(cat):
            made.append(name)
            rows = [cat[r] for r in reads] or [cat["base"]]
            return rows[0].select((F.col("n") + len(rows)).alias("n"))

        return build

    stages = {"a": stage("a"), "b": stage("b", "a"), "c": stage("c"), "d": stage("d", "a", "c"), "e": stage("e", "d", "b")}
    base = spark.range(4).toDF("n")
    cat = Catalog(spark, {"base": lambda: base}, stages, shared="abcde", workspace=ParquetSink(spark, str(tmp_path)))
    cat.keep("acbde")
    assert made == list("acbde") and found(cat["e"]) == [(n + 5,) for n in range(4)] and cat.rows("e") == 4
    again = Catalog(spark, {"base": lambda: base}, stages, shared="abcde", workspace=ParquetSink(spark, str(tmp_path)))
    _, started = jobs(spark, lambda: again.keep("edcba"))
    assert started == 0 and made == list("acbde")


def test_the_patient_model_joins_its_sides_without_a_shuffle(spark, tmp_path):
    """Every domain is read once from its buckets; nothing above the stored sides is shuffled."""

    def source(name):
        return spark.createDataFrame([], site_b.CONTRACTS[name]) if name in site_b.CONTRACTS else None

    sink = ParquetSink(spark, str(tmp_path), bucket_by=site_b.BUCKETS)
    cat = Catalog(spark, source, site_b.STAGES, site_b.CONTRACTS, shared=site_b.SHARED, workspace=sink)
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    try:
        plan = plan_of(cat.compose("analytics_b.cancer_combine_wo_dx_name"))
    finally:
        for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(setting)
    assert "Exchange" not in plan and plan.count("Scan parquet") == len(site_b.BUCKETS)


def test_compact_files_are_not_broadcast(spark, tmp_path):
    """Encoded columns are small in files only."""
    rows = spark.range(1_000_000).select(F.pmod(F.hash("id"), F.lit(5000)).alias("k"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/rows")
    assert "Broadcast" not in plan_of(spark.range(10**7).join(spark.read.parquet(f"{tmp_path}/rows"), F.col("id") == F.col("k")))


def test_scans_are_cut_finer_than_shuffles(spark):
    """Rows grow when they are read: a task's must fit the buffer of the shuffle's writer, or all of them spill."""
    from chartloom.session import SETTINGS

    size = {name: int(SETTINGS[name].removesuffix("m")) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    assert 4 * size["spark.sql.files.maxPartitionBytes"] <= size["spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def test_stored_rows_leave_no_shuffle_files(spark, tmp_path):
    """Else the disk holds the shuffles of every step at once."""

    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|")
        return {f for f in blocks.split("|") if "shuffle_" in f}

    before = spark.conf.get(sinks.SHUFFLES_GO)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    there = files()
    plain = ParquetSink(spark, str(tmp_path)).publish("plain", counted)
    dealt = sinks.stored_by(counted.repartition(3, "k"), "k", 3)
    assert files() <= there and spark.conf.get(sinks.SHUFFLES_GO) == before
    assert found(plain) == found(dealt) == [(k, 143 if k < 6 else 142) for k in range(7)]


def test_rows_dealt_by_the_caller_are_stored_in_buckets(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(200).select(F.col("id").cast("string").alias("k"), "id")
        sides = [sinks.stored_by(rows.withColumnRenamed("id", n).repartition(5, "k"), "k", 5) for n in "ab"]
        joined = sides[0].join(sides[1], "k", "left")
        assert joined.where("a = b").count() == 200 and "Exchange" not in plan_of(joined)
        assert len({f.rsplit("_", 1)[1] for f in sides[0].inputFiles()}) <= 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reported_datasets_are_stored_one_after_the_other(spark, tmp_path, monkeypatch):
    """The disk holds the shuffles of one dataset at a time."""
    running, most, publish = [], [], ParquetSink.publish

    def slow(self, name, df, *args):
        running.append(name)
        most.append(len(running))
        time.sleep(0.5)
        try:
            return publish(self, name, df, *args)
        finally:
            running.remove(name)

    monkeypatch.setattr(ParquetSink, "publish", slow)
    stages = {n: (lambda cat, k=k: cat["base"].where(F.col("n") < k)) for k, n in enumerate("abc")}
    base = spark.range(4).toDF("n")
    cat = Catalog(spark, {"base": lambda: base}, stages, shared="abc", workspace=ParquetSink(spark, str(tmp_path)))
    report = stored_report(cat, {"A": "a", "B": "b", "C": "c"}, distinct="n")
    assert [tuple(r) for r in report.collect()] == [("A", 0, 0), ("B", 1, 1), ("C", 2, 2)]
    assert len(most) == 3 and max(most) == 1


def test_dropped_rows_are_gone_and_others_stay(spark):
    one, two = sinks.stored(spark.range(3)), sinks.stored(spark.range(4))
    gone, left = (df.inputFiles()[0].removeprefix("file://") for df in (one, two))
    sinks.dropped(one)
    assert not os.path.exists(gone) and os.path.exists(left) and two.count() == 4
