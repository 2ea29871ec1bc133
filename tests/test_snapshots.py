"""Snapshot tables, safe replaces and exactly-once appends under failures."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from querytrail.sinks import (
    BatchInDoubt,
    BatchLedger,
    CommitFailed,
    OutputOwnedElsewhere,
    SchemaChanged,
    SinkConfig,
    SnapshotTable,
    Store,
    append_batches,
    claim_output,
    read_batches,
    read_table,
    replace_each_batch,
    stream_tag,
    write_all,
    write_table,
)
from querytrail.streaming import run_to_end, start


def _df(spark, values, schema="x int"):
    return spark.createDataFrame([(v,) for v in values], schema)


def _bad(spark):
    """Rows whose last ones fail while they are written."""
    x = F.when(F.col("id") < 3000, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("lost")).cast("int"))
    return spark.range(0, 4000, 1, 4).select(x.alias("x"))


def _values(df):
    return sorted(r[0] for r in df.collect())


# --- files ------------------------------------------------------------------


def test_only_one_writer_gets_a_name(spark, scratch):
    stores = [Store(spark, os.path.join(scratch, "s")) for _ in range(8)]
    won = []
    barrier = threading.Barrier(8)

    def go(i):
        barrier.wait()
        if stores[i].put_new("log/one", f"writer {i}"):
            won.append(i)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and stores[0].read_text("log/one") == f"writer {won[0]}"
    assert [e.name for e in stores[0].entries("log")] == ["one"]
    assert stores[0].entries("nowhere") == [] and not stores[0].exists("nowhere")
    with pytest.raises(OSError):
        stores[0].rename("nowhere", "else")


# --- replace ----------------------------------------------------------------


@pytest.mark.parametrize("snapshots", [False, True])
def test_a_failed_replace_leaves_the_rows(spark, scratch, snapshots):
    sink = SinkConfig(root=scratch, snapshots=snapshots)
    write_table(_df(spark, [1, 2]), "t", sink)
    with pytest.raises(Exception, match="lost"):
        write_table(_bad(spark), "t", sink)
    assert _values(read_table(spark, "t", sink)) == [1, 2]
    write_table(_df(spark, [3]), "t", sink)
    assert _values(read_table(spark, "t", sink)) == [3]
    if not snapshots:
        assert os.listdir(scratch) == ["t"]  # nothing is left beside it


@pytest.mark.parametrize("snapshots", [False, True])
def test_a_table_may_be_made_from_itself(spark, scratch, snapshots):
    sink = SinkConfig(root=scratch, snapshots=snapshots)
    write_table(_df(spark, [1, 2]), "t", sink)
    write_table(read_table(spark, "t", sink).selectExpr("x + 10 AS x"), "t", sink)
    assert _values(read_table(spark, "t", sink)) == [11, 12]


def test_a_swap_cut_short_is_undone(spark, scratch, monkeypatch):
    sink = SinkConfig(root=scratch)
    write_table(_df(spark, [1]), "t", sink)
    rename = Store.rename

    def failing(self, old, new):
        if old.startswith(".new-"):
            raise OSError("store is gone")
        rename(self, old, new)

    monkeypatch.setattr(Store, "rename", failing)
    with pytest.raises(OSError, match="gone"):
        write_table(_df(spark, [2]), "t", sink)
    assert _values(read_table(spark, "t", sink)) == [1]


def test_modes_of_a_snapshot_table(spark, scratch):
    sink = SinkConfig(root=scratch, snapshots=True)
    with pytest.raises(LookupError):
        read_table(spark, "t", sink)
    assert read_table(spark, "t", sink, _df(spark, []).schema).count() == 0
    write_table(_df(spark, [1]), "t", sink, mode="append")
    write_table(_df(spark, [2]), "t", sink, mode="append")
    write_table(_df(spark, [9]), "t", sink, mode="ignore")
    assert _values(read_table(spark, "t", sink)) == [1, 2]
    status = write_all({"t": _df(spark, [5]), "u": _df(spark, [6])}, sink, mode="error", raise_on_failure=False)
    assert status["u"] == "ok" and status["t"].startswith("FileExistsError")
    write_table(_df(spark, []), "t", sink)
    assert read_table(spark, "t", sink).columns == ["x"] and read_table(spark, "t", sink).count() == 0
    with pytest.raises(ValueError):
        SinkConfig(fmt="jdbc", snapshots=True).table(spark, "t")


def test_other_formats(spark, scratch):
    for fmt, options in (("json", {}), ("csv", {"header": "true"}), ("orc", {})):
        sink = SinkConfig(fmt=fmt, root=scratch, options=options, snapshots=True)
        write_table(_df(spark, [1, 2]), fmt, sink)
        write_table(_df(spark, [3]), fmt, sink, mode="append")
        assert _values(read_table(spark, fmt, sink)) == [1, 2, 3]


def test_readers_keep_their_snapshot_and_old_ones_expire(spark, scratch):
    table = SnapshotTable(spark, os.path.join(scratch, "t"))
    for i in range(4):
        table.replace(_df(spark, [i]))
    held = table.read()
    assert [_values(table.read(n)) for n in table.numbers()] == [[0], [1], [2], [3]]
    table.replace(_df(spark, [4]))
    assert _values(held) == [3]
    assert len(table.expire(keep=2)) == 3
    assert table.numbers() == [3, 4] and _values(held) == [3] and _values(table.read()) == [4]
    with pytest.raises(ValueError):
        table.expire(keep=0)


def test_replaces_bound_the_folders(spark, scratch):
    sink = SinkConfig(root=scratch, snapshots=True, keep=2)
    fn = replace_each_batch("t", sink)
    for i in range(5):
        fn(_df(spark, [i]), i)
    assert _values(read_batches(spark, "t", sink)) == [4]
    assert len(os.listdir(os.path.join(scratch, "t", "_data"))) == 2


# --- appends ----------------------------------------------------------------


def test_appends_side_by_side_lose_nothing(spark, scratch):
    path = os.path.join(scratch, "t")
    errors = []

    def go(i):
        try:
            for j in range(3):
                SnapshotTable(spark, path).append(_df(spark, [10 * i + j]), stream=f"s{i}", batch=j)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    table = SnapshotTable(spark, path)
    assert _values(table.read()) == sorted(10 * i + j for i in range(5) for j in range(3))
    assert table.current().batches == {f"s{i}": 2 for i in range(5)}


def test_no_commit_when_others_are_always_first(spark, scratch, monkeypatch):
    table = SnapshotTable(spark, os.path.join(scratch, "t"))
    table.append(_df(spark, [1]))
    monkeypatch.setattr(Store, "put_new", lambda self, name, text: False)
    with pytest.raises(CommitFailed):
        table.append(_df(spark, [2]))
    assert _values(table.read()) == [1]
    assert len(os.listdir(os.path.join(scratch, "t", "_data"))) == 1


def test_columns_must_fit(spark, scratch):
    table = SnapshotTable(spark, os.path.join(scratch, "t"))
    table.append(_df(spark, [1]))
    for other in (_df(spark, ["a"], "x string"), _df(spark, [1], "y int")):
        with pytest.raises(SchemaChanged):
            table.append(other)
    assert _values(table.read()) == [1] and len(os.listdir(os.path.join(scratch, "t", "_data"))) == 1
    table.replace(_df(spark, ["a"], "y string"))  # a replace may change them
    assert table.read().columns == ["y"]


def test_owner_of_a_snapshot_table_and_of_a_plain_one(spark, scratch):
    sink = SinkConfig(root=scratch, snapshots=True)
    append_batches("t", sink, owner="a")(_df(spark, [1]), 0)
    with pytest.raises(OutputOwnedElsewhere, match="belongs to the stream"):
        append_batches("t", sink, owner="b")(_df(spark, [1]), 0)
    append_batches("t", sink, owner="a")(_df(spark, [2]), 1)
    assert _values(read_batches(spark, "t", sink)) == [1, 2]
    claims, errors = [], []

    def go(i):
        try:
            claim_output(spark, os.path.join(scratch, "plain"), f"o{i}")
            claims.append(i)
        except OutputOwnedElsewhere as e:
            errors.append(e)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(claims) == 1 and len(errors) == 5


def test_marker_folder_of_earlier_versions(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.createDataFrame([("a",)], "value string").coalesce(1).write.text(f"{path}/_owner")
    claim_output(spark, path, "a")
    with pytest.raises(OutputOwnedElsewhere):
        claim_output(spark, path, "b")


class Cut(Exception):
    pass


def test_a_callback_cut_before_its_commit(spark, scratch, monkeypatch):
    """The process dies when the rows are written and the commit is not."""
    sink = SinkConfig(root=scratch, snapshots=True)
    fn = append_batches("t", sink, owner="ck")
    fn(_df(spark, [1]), 0)
    put_new = Store.put_new

    def dead(self, name, text):
        raise Cut

    monkeypatch.setattr(Store, "put_new", dead)
    with pytest.raises(Cut):
        fn(_df(spark, [2]), 1)
    monkeypatch.setattr(Store, "put_new", put_new)
    assert _values(read_batches(spark, "t", sink)) == [1]
    again = append_batches("t", sink, owner="ck")
    again(_df(spark, [2]), 1)
    again(_df(spark, [2]), 1)  # a replay of a committed batch
    assert _values(read_batches(spark, "t", sink)) == [1, 2]
    table = sink.table(spark, "t")
    data = os.path.join(scratch, "t", "_data")
    assert len(os.listdir(data)) == 3
    assert table.expire(keep=1) == []  # it could be a write in progress
    assert len(table.expire(keep=1, grace_s=-1)) == 1 and len(os.listdir(data)) == 2
    assert _values(read_batches(spark, "t", sink)) == [1, 2]


def test_a_stream_cut_and_restarted(spark, scratch):
    """A real query whose callback dies after the commit of batch 1, before
    the checkpoint has it: the restart replays that batch."""
    topic = os.path.join(scratch, "topic")
    for i in range(4):
        _df(spark, [10 * i, 10 * i + 1]).coalesce(1).write.mode("append").parquet(topic)
    stream = spark.readStream.schema("x int").option("maxFilesPerTrigger", "1").parquet(topic)
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")
    writer = append_batches("t", sink, owner=checkpoint)

    def cut(df, batch):
        writer(df, batch)
        if batch == 1:
            raise Cut("after the write")

    with pytest.raises(Exception, match="after the write"):
        run_to_end(start(stream, checkpoint, trigger={"availableNow": True}, foreach_batch=cut), 300)
    assert read_batches(spark, "t", sink).count() == 4
    run_to_end(start(stream, checkpoint, trigger={"availableNow": True}, foreach_batch=append_batches("t", sink, owner=checkpoint)), 300)
    assert _values(read_batches(spark, "t", sink)) == sorted(10 * i + j for i in range(4) for j in (0, 1))
    assert sink.table(spark, "t").current().batches == {checkpoint: 3}


# --- compaction -------------------------------------------------------------


def test_compaction_beside_a_writer(spark, scratch):
    sink = SinkConfig(root=scratch, snapshots=True)
    fn = append_batches("t", sink, owner="ck")
    for i in range(6):
        fn(_df(spark, range(10 * i, 10 * i + 10)), i)
    table = sink.table(spark, "t")

    def merge(rows):
        fn(_df(spark, [1000]), 6)  # another batch comes while the rows are rewritten
        return rows

    new = table.compact(merge, files=1)
    assert len(new.folders) == 2
    files = [f for folder in new.folders[:1] for f in os.listdir(os.path.join(scratch, "t", "_data", folder)) if f.endswith(".parquet")]
    assert len(files) == 1
    fn(_df(spark, range(10)), 0)  # replays are still known
    fn(_df(spark, [1000]), 6)
    assert _values(read_batches(spark, "t", sink)) == [*range(60), 1000]
    assert {r[0] for r in read_batches(spark, "t", sink, keep_batch_id=True).select("batch_id").distinct().collect()} == set(range(7))
    table.expire(keep=1)
    assert len(os.listdir(os.path.join(scratch, "t", "_data"))) == 2
    assert table.compact(least=3) is None


def test_compaction_gives_way_to_a_replace(spark, scratch):
    table = SnapshotTable(spark, os.path.join(scratch, "t"))
    table.append(_df(spark, [1]))
    table.append(_df(spark, [2]))

    def merge(rows):
        table.replace(_df(spark, [7]))
        return rows

    assert table.compact(merge) is None
    assert _values(table.read()) == [7]
    table.append(_df(spark, [8]))
    with pytest.raises(SchemaChanged):
        table.compact(lambda rows: rows.selectExpr("x AS y"))
    table.compact(lambda rows: rows.agg(F.sum("x").cast("int").alias("x")))
    assert _values(table.read()) == [15]


# --- sinks without transactions -----------------------------------------------


def collection():
    """A sink that keeps what each task wrote, like a document store."""

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.options = options

        def write(self, iterator):
            path = os.path.join(self.options["root"], self.options["collection"])
            os.makedirs(path, exist_ok=True)
            rows = [r.asDict() for r in iterator]
            with open(os.path.join(path, os.urandom(8).hex()), "w") as out:
                out.write("\n".join(map(json.dumps, rows)))
            return WriterCommitMessage()

    class Collection(DataSource):
        @classmethod
        def name(cls):
            return "testcollection"

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return Collection


def _documents(scratch, name):
    path, out = os.path.join(scratch, name), []
    for f in os.listdir(path) if os.path.isdir(path) else []:
        with open(os.path.join(path, f)) as rows:
            out += [json.loads(r) for r in rows.read().splitlines()]
    return out


def test_a_document_store_has_each_batch_once(spark, scratch, monkeypatch):
    spark.dataSource.register(collection())
    sink = SinkConfig(fmt="testcollection", options={"root": scratch})
    ledger = BatchLedger(os.path.join(scratch, "ledger"))

    def undo(spark, name, stream, batch):
        path = os.path.join(scratch, name)
        for f in os.listdir(path):
            with open(os.path.join(path, f)) as rows:
                keep = [r for r in rows.read().splitlines() if (json.loads(r)["stream"], json.loads(r)["batch_id"]) != (stream, batch)]
            with open(os.path.join(path, f), "w") as rows:
                rows.write("\n".join(keep))

    fn = append_batches("hits", sink, owner="ck", ledger=ledger, undo=undo)
    fn(_df(spark, [1, 2]), 0)
    finish = BatchLedger.finish

    def dead(self, *args):
        raise Cut

    monkeypatch.setattr(BatchLedger, "finish", dead)
    with pytest.raises(Cut):
        fn(_df(spark, [3, 4]), 1)  # written, not noted
    monkeypatch.setattr(BatchLedger, "finish", finish)
    with pytest.raises(BatchInDoubt):
        append_batches("hits", sink, owner="ck", ledger=ledger)(_df(spark, [3, 4]), 1)
    fn(_df(spark, [3, 4]), 1)
    fn(_df(spark, [3, 4]), 1)
    fn(_df(spark, [1, 2]), 0)
    fn(_df(spark, [5]), 2)
    found = _documents(scratch, "hits")
    assert sorted(d["x"] for d in found) == [1, 2, 3, 4, 5]
    assert {d["stream"] for d in found} == {stream_tag("ck")}
    for i in range(3, 30):
        fn(_df(spark, [i]), i)
    assert ledger.state(spark, "hits", "ck", 2) == "done" and ledger.state(spark, "hits", "ck", 30) is None
    assert len(os.listdir(os.path.join(scratch, "ledger", "hits", stream_tag("ck")))) <= 2 * 2 * BatchLedger.KEEP + 4
    assert ledger.state(spark, "hits", "other", 0) is None


def test_a_ledger_needs_an_owner_and_another_format(scratch):
    ledger = BatchLedger(scratch)
    with pytest.raises(ValueError):
        append_batches("t", SinkConfig(fmt="mongodb"), ledger=ledger)
    with pytest.raises(ValueError):
        append_batches("t", SinkConfig(root=scratch), owner="a", ledger=ledger)


def test_columns_that_the_ledger_adds_must_be_free(spark, scratch):
    fn = append_batches("t", SinkConfig(fmt="testcollection"), owner="a", ledger=BatchLedger(scratch))
    with pytest.raises(ValueError, match="stream"):
        fn(_df(spark, ["x"], "stream string"), 0)


def test_a_writer_finds_its_next_number_without_listing_the_log(spark, scratch, monkeypatch):
    table = SnapshotTable(spark, os.path.join(scratch, "t"))
    table.append(_df(spark, [0]), "s", 0)
    listed = []
    entries = Store.entries
    monkeypatch.setattr(Store, "entries", lambda self, name="": listed.append(name) or entries(self, name))
    for batch in range(1, 4):
        assert table.append(_df(spark, [batch]), "s", batch).number == batch
    assert "_log" not in listed
    other = SnapshotTable(spark, table.path)
    other.append(_df(spark, [4]))
    other.compact()
    other.expire(keep=1)
    assert table.append(_df(spark, [5]), "s", 5).number == 6  # all that this one knew is gone
    assert _values(table.read()) == [0, 1, 2, 3, 4, 5]
