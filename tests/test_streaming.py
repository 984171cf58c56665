"""Watched folders: batches that are run again, empty files, what is left behind."""

import os

import pytest

from tallyfold.operators import tables
from tallyfold.session import scratch_within, shared_folder
from tallyfold.sources.statements import EMPTY
from tallyfold.streaming import incremental

HEAD = "Date,Description,Amount\n"


@pytest.fixture
def inbox(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a [1] {x}*.csv").write_text(HEAD + "2026-01-05,HULU WITH ADS,-9.00\n2026-01-06,BAD,x\n")
    (folder / "odd.csv").write_text("no header\n")
    (folder / "empty.csv").write_text("")
    accounts = spark.createDataFrame([("a [1] {x}*.csv", "a", "checking")], "file_name string, account_name string, account_type string")
    return folder, accounts


def watch(spark, inbox, tmp_path):
    folder, accounts = inbox
    paths = [str(tmp_path / name) for name in ("ledger", "c")]
    query = incremental.watch_statements(spark, str(folder), accounts, *paths, once=True, rejects_path=str(tmp_path / "rejects"))
    query.awaitTermination()


def rejects(spark, tmp_path):
    files = sorted((os.path.basename(r.file), r.reason) for r in spark.read.parquet(f"{tmp_path}/rejects/files").collect())
    return files, [r.reason for r in spark.read.parquet(f"{tmp_path}/rejects/rows").collect()]


def scratch_of(spark):
    folder = shared_folder(spark).removeprefix("file://")
    return {n for n in os.listdir(folder) if n.startswith(("stream-", "batch-"))} if os.path.isdir(folder) else set()


@pytest.mark.parametrize("late", [False, True])
def test_a_batch_that_runs_twice_rejects_once(spark, inbox, tmp_path, monkeypatch, late):
    whole, died = incremental.append_absent, []

    def dying(*args):
        if late:
            whole(*args)
        died.append(True)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "append_absent", dying)
        with pytest.raises(Exception, match="killed"):
            watch(spark, inbox, tmp_path)
    assert died
    watch(spark, inbox, tmp_path)
    files, rows = rejects(spark, tmp_path)
    assert [f for f, _ in files] == ["empty.csv", "odd.csv"] and files[0][1] == EMPTY
    assert rows == ["amount is not a number"]
    assert [r.raw_description for r in tables.read_monthly(spark, str(tmp_path / "ledger")).collect()] == ["HULU WITH ADS"]
    assert not scratch_of(spark)


def test_later_batches_add_their_rejects(spark, inbox, tmp_path):
    watch(spark, inbox, tmp_path)
    (inbox[0] / "later.csv").write_text("also no header\n")
    watch(spark, inbox, tmp_path)
    files, rows = rejects(spark, tmp_path)
    assert [f for f, _ in files] == ["empty.csv", "later.csv", "odd.csv"] and len(rows) == 1
    assert not scratch_of(spark)


def test_scratch_within_replaces_and_goes(spark):
    from tallyfold.session import Scratch

    with scratch_within(spark, "stream-test") as folder:
        with Scratch(spark, spark.range(3), "x") as df:
            assert df.count() == 3
        spark.range(2).write.parquet(f"{folder}/left")
    with pytest.raises(ValueError), scratch_within(spark, "stream-test") as folder:
        assert not os.path.exists(f"{folder.removeprefix('file://')}/left")
        raise ValueError
    assert "stream-test" not in scratch_of(spark)
