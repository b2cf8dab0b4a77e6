import __spark_entry__
import corpus_pipeline
from cases import frame, prose, texts
from eventmere.llm import catalog


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    rows = texts() + [(100 + i, " ".join(prose(i, 70))) for i in range(40)]
    rows += [(300, rows[-1][1]), (301, " ".join(prose(901, 70)) + " a.b@example.org")]
    rows += [(302, " ".join(prose(900, 40) + prose(77, 30)))]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(prose(77, 30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), frame(spark).columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
    found = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 300 not in found and 139 in found and 302 not in found and 2 not in found
    assert found[301].endswith("[EMAIL]")
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in last.collect()} == set(found) and "text" not in last.columns


def test_all_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(catalog.oracle_sql()) <= set(names)


def test_a_stored_frame_leaves_the_driver_collected(spark):
    from eventmere.llm import shared

    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    count = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())
    before = count()
    shared.stored(spark.range(3).toDF("x"), "small")
    assert count() > before


def test_every_stage_bounds_what_workers_are_sent(spark):
    from eventmere.llm import shared

    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(shared.BATCH)
        try:
            stage(spark, None, "")
        except Exception:  # There are no documents; the limit comes first.
            pass
        assert int(spark.conf.get(shared.BATCH)) == shared.BATCH_BYTES, name
    spark.conf.set(shared.BATCH, "1000")
    shared.small_batches(spark)
    assert spark.conf.get(shared.BATCH).startswith("1000")
    spark.conf.unset(shared.BATCH)


def test_a_large_group_gives_its_memory_back(monkeypatch):
    import pyarrow as pa

    from eventmere.llm import shared

    given = []
    monkeypatch.setattr(shared, "release_memory", lambda: given.append(1))
    same = shared.group_given_back(lambda table: table)
    for size, times in ((10, 0), (shared.GROUP_BYTES, 1)):
        table = pa.table({"x": pa.array(range(size))})
        assert same(table).equals(table) and len(given) == times
    assert list(shared.given_back(iter)([1, 2])) == [1, 2] and len(given) == 2
