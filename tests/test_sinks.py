import os

import pytest

from querytrail.sinks import SinkConfig, WriteFailed, append_batches, read_batches, replace_each_batch, write_all, write_table


def test_write_table_overwrite_and_append(spark, scratch):
    sink = SinkConfig(root=scratch)
    df = spark.createDataFrame([(1,), (2,)], "x int")
    write_table(df, "t", sink)
    write_table(df, "t", sink)
    assert spark.read.parquet(os.path.join(scratch, "t")).count() == 2
    write_table(df, "t", sink, mode="append")
    assert spark.read.parquet(os.path.join(scratch, "t")).count() == 4
    with pytest.raises(ValueError):
        write_table(df, "t", sink, mode="upsert")


def test_write_all_attempts_every_output_then_raises(spark, scratch):
    sink = SinkConfig(root=scratch)
    good = spark.createDataFrame([(1,)], "x int")
    write_table(good, "exists", sink)
    with pytest.raises(WriteFailed) as err:
        write_all({"exists": good, "later": good}, sink, mode="error")
    assert set(err.value.failures) == {"exists"}
    assert spark.read.parquet(os.path.join(scratch, "later")).count() == 1  # next output still written
    status = write_all({"exists": good}, sink, mode="error", raise_on_failure=False)
    assert status["exists"] != "ok"


def test_sink_options_for():
    mongo = SinkConfig(fmt="mongodb", uri="mongodb://h:27017", database="db", options={"ordered": "false"})
    assert mongo.options_for("top_10") == {
        "ordered": "false",
        "connection.uri": "mongodb://h:27017",
        "database": "db",
        "collection": "top_10",
    }
    assert SinkConfig(fmt="jdbc", name_option="dbtable", options={"url": "jdbc:x"}).options_for("t") == {"url": "jdbc:x", "dbtable": "t"}
    assert SinkConfig(root="/r").options_for("t") == {} and SinkConfig(root="/r").path("t") == "/r/t"


def test_document_store_options(spark):
    sink = SinkConfig(fmt="mongodb", uri="mongodb://h:27017", database="db")
    df = spark.createDataFrame([(1,)], "x int")
    writer, path = sink.writer(df, "coll", "overwrite")
    assert path is None
    # the connector jar is not on this classpath: the write must fail loudly
    with pytest.raises(Exception, match="(?i)mongodb"):
        write_table(df, "coll", sink)


def test_file_sink_needs_root():
    with pytest.raises(ValueError):
        SinkConfig().path("x")


def test_append_batches_is_idempotent_on_replay(spark, scratch):
    sink = SinkConfig(root=scratch)
    fn = append_batches("hits", sink)
    df = spark.createDataFrame([(1,), (2,)], "x int")
    fn(df, 0)
    fn(df, 1)
    fn(df, 1)  # replay of batch 1 after a failure
    out = read_batches(spark, "hits", sink, keep_batch_id=True)
    assert sorted((r.x, r.batch_id) for r in out.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    assert read_batches(spark, "hits", sink).columns == ["x"]


def test_append_batches_refuses_own_batch_column(spark, scratch):
    fn = append_batches("hits", SinkConfig(root=scratch))
    with pytest.raises(ValueError):
        fn(spark.createDataFrame([(1,)], "batch_id int"), 0)


def test_append_batches_skips_empty(spark, scratch):
    sink = SinkConfig(root=scratch)
    append_batches("hits", sink)(spark.createDataFrame([], "x int"), 0)
    append_batches("hits", sink, log_count=False)(spark.createDataFrame([], "x int"), 1)
    assert not os.path.exists(os.path.join(scratch, "hits"))


@pytest.mark.parametrize("snapshots", [False, True])
def test_append_batches_computes_a_batch_once(spark, scratch, snapshots):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return (x,)

    sink = SinkConfig(root=scratch, snapshots=snapshots)
    write = append_batches("t", sink, log_count=False, owner="ck")
    for batch, n in enumerate((40, 0, 40)):
        write(spark.createDataFrame(spark.sparkContext.range(n, numSlices=4).map(counted), "x long"), batch)
    assert seen.value == 80  # a look for the first row would have computed a part of each batch again
    assert read_batches(spark, "t", sink).count() == 80
    if snapshots:
        assert len(sink.table(spark, "t").current().folders) == 2  # the empty batch left none


def test_replace_each_batch(spark, scratch):
    sink = SinkConfig(root=scratch)
    fn = replace_each_batch("t", sink)
    fn(spark.createDataFrame([(1,)], "x int"), 0)
    fn(spark.createDataFrame([(1,), (2,)], "x int"), 1)
    assert read_batches(spark, "t", sink).count() == 2
