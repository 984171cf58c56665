"""Quoted cells with line breaks in files that are split anywhere."""

import csv
import io
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyfold.operators.ingest import ingest_files
from tallyfold.sources import statements


def plain_records(text):
    """Records of a file read whole, one character after the other."""
    out, held, inside, start = [], [], False, True
    k = 0
    while k < len(text):
        c = text[k]
        if inside:
            if c == '"' and text[k + 1 : k + 2] == '"':
                held.append('""')
                k += 2
                continue
            inside = c != '"'
        elif c == "\n":
            out.append("".join(held))
            held, start = [], True
            k += 1
            continue
        else:
            inside = start and c == '"'
            start = c == ","
        held.append(c)
        k += 1
    if held:
        out.append("".join(held))
    return out


def random_file(rng, rows):
    cells = lambda: rng.choice(
        ["x", "", "12.50", '"q"', '"a,b"', '"two\nlines"', '"\n"', '"a ""b""\n""c"""', '5" pipe', 'in"side', '"closed"tail', '""', '"""\n"""', "é"]
    )
    return "\n".join(",".join(cells() for _ in range(rng.randrange(1, 5))) for _ in range(rows)) + "\n"


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    yield lambda size: [spark.conf.set(names[0], str(size)), spark.conf.set(names[1], "0"), spark.conf.set(names[2], "1")]
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("size", [23, 400, 10_000_000])
def test_records_equal_those_of_files_read_whole(spark, tmp_path, tiny_splits, size):
    rng = random.Random(size)
    wanted = {}
    for k in range(6):
        text = random_file(rng, 60 if size < 100 else 400)
        if k == 5:
            text = text + '"never closed\nto the end,\n"" of it'
        (tmp_path / f"f{k}.csv").write_text(text, newline="")
        wanted[f"f{k}.csv"] = plain_records(text)
    tiny_splits(size)
    lines = statements.read_statement_lines(spark, str(tmp_path), multiline=True).collect()
    blocks = {(r.file, r.block) for r in lines}
    assert len(blocks) > 50 if size < 1000 else len(blocks) == 6
    found = {}
    for r in sorted(lines, key=lambda r: (r.file, r.block, r.pos)):
        found.setdefault(r.file.rsplit("/", 1)[1], []).append(r.line)
    assert found == wanted
    # Places go up by one inside a block.
    at = {}
    for r in sorted(lines, key=lambda r: (r.file, r.block, r.pos)):
        assert at.setdefault((r.file, r.block), r.pos - 1) == r.pos - 1
        at[r.file, r.block] = r.pos


def test_a_split_statement_loads_like_a_whole_one(spark, tmp_path, tiny_splits):
    rows = [("2026-01-%02d" % (1 + k % 28), f'SHOP {k}\nunit "{k % 7}"' if k % 3 else f"PLAIN {k}", f"-{k}.25", "note\r\nmore" if k % 5 == 0 else "") for k in range(1, 300)]
    out = io.StringIO()
    out.write('exported\n"by\nhand"\n')
    csv.writer(out, lineterminator="\r\n").writerows([("Date", "Description", "Amount", "Extended\nDetails"), *rows])
    (tmp_path / "card.csv").write_text(out.getvalue(), newline="")
    accounts = spark.createDataFrame([("card.csv", "card", "checking")], "file_name string, account_name string, account_type string")
    wanted = {(d, t, float(a)) for d, t, a, _ in rows}
    for size in (90, 10_000_000):
        tiny_splits(size)
        found = ingest_files(spark, str(tmp_path), accounts, multiline=True).collect()
        assert {(str(r.transaction_date), r.raw_description, float(r.amount)) for r in found} == wanted


def test_files_are_listed_with_empty_ones(spark, tmp_path):
    (tmp_path / "in ner+x").mkdir()
    (tmp_path / "in ner+x" / "a b+c%20.csv").write_text("x\n")
    (tmp_path / "empty.csv").write_text("")
    one, two = f"file://{tmp_path}/in ner+x/a b+c%20.csv", f"file://{tmp_path}/empty.csv"
    assert {r.file for r in statements.list_files(spark, str(tmp_path)).collect()} == {one, two}
    assert [r.file for r in statements.empty_files(spark, str(tmp_path)).collect()] == [two]
    assert {r.file for r in statements.read_statement_lines(spark, str(tmp_path)).collect()} == {one}


def test_small_files_share_tasks(spark, tmp_path):
    for k in range(1200):
        (tmp_path / f"f{k}.csv").write_text(f"Date,Description,Amount\n2024-01-01,shop {k},-1.00\n")
    (tmp_path / "none.csv").write_text("")
    files, lines = statements.read_files_and_lines(spark, str(tmp_path))
    assert lines.count() == 2400
    # Each file counted for 4 MB before, so that there was a task for every 32 of them.
    assert len(lines.inputFiles()) <= spark.sparkContext.defaultParallelism + 1
    assert files.count() == 1201
    assert spark.conf.get("spark.sql.files.openCostInBytes", None) is None


def test_statement_files_are_named_like_customers(spark, tmp_path):
    from checks import fixtures as fx

    customers = [(None if k == 7 else k, f"c{k}") for k in range(1200, 1230)] + [(7, "c7"), (None, "nobody")]
    spark.createDataFrame(customers, "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    orders = "SELECT id AS o_orderkey, IF(id = 5, NULL, 1200 + id % 30) AS o_custkey, 'F' AS o_orderstatus, "
    orders += "1.5D AS o_totalprice, TIMESTAMP'2000-01-01' AS o_orderdate FROM range(90)"
    spark.sql(orders).write.parquet(str(tmp_path / "orders.parquet"))
    found = [r.file for r in statements.list_files(spark, fx.statement_files(spark, str(tmp_path))).collect()]
    # One file per customer, and one for those without a key; not a folder for each.
    assert sorted(f.rsplit("/", 1)[1] for f in found) == sorted([*[f"cust_{k}.csv" for k in [*range(1200, 1230), 7]], "unnamed.csv"])
    assert {f.rsplit("/", 2)[1] for f in found} == {"cust_120", "cust_121", "cust_122", "cust_7.c", "unnamed."}
    lines = fx.statement_lines(spark, str(tmp_path)).count()
    assert spark.read.text(found).where("value <> ''").count() == lines


ODD_NAMES = ["a.csv", "b[1]*.csv", "b1x.csv", "{c,d}.csv", "c.csv", "e\\f.csv", "g h%20+.csv", "_part.csv", ".i.csv", "_k=v.csv", "_metadata", "j._COPYING_"]


def _folders(top):
    """Folders of files and folders, with names that look like patterns and names that listings pass over."""
    for folder in ("", "one", "one/deep", "two[x]*", "two", "_kept=1", "_left", ".left", "flat?"):
        (top / folder).mkdir(exist_ok=True)
        for name in ODD_NAMES:
            (top / folder / name).write_text(f"Date,Description,Amount\n2024-01-01,{folder} {name},-1.00\n")
    (top / "one" / "none.csv").write_text("")
    return str(top)


def _whole(spark, paths):
    """Files and lines of one read of everything."""
    text = spark.read.text(paths, recursiveFileLookup=True)
    lines = statements.placed(text, F.col("value")).select("file", "line").collect()
    return sorted(r.file for r in statements._listed(text).collect()), sorted(lines)


def test_many_files_take_several_reads(spark, tmp_path, monkeypatch):
    top = _folders(tmp_path)
    pattern = "/two\\[x\\]\\*"
    asked = [top, [top], [f"{top}/one", top, f"{top}/one/deep/a.csv", top], [f"{top}/_left", top], [f"{top}/*.csv", f"{top}/tw*"], f"{top}{pattern}"]
    asked += [f"{top}/_left/_part.csv", [f"{top}/one/a.csv", f"{top}/one/c.csv", f"{top}/two", f"{top}/.left/a.csv", f"{top}/*/.i.csv"]]
    whole = [_whole(spark, paths) for paths in asked]
    # Names that are passed over and those beside them.
    assert {f.rsplit("/", 1)[1] for f in whole[0][0]} >= {"a.csv", "_k=v.csv", "_metadata", "none.csv", "b[1]*.csv", "e\\f.csv"}
    assert not any("_left" in f or "_part" in f or "/." in f or "_COPYING_" in f for f in whole[0][0])
    for most in (1, 4, 15, 1000):
        monkeypatch.setattr(statements, "FILES_AT_ONCE", most)
        for paths, (names, rows) in zip(asked, whole, strict=True):
            reads = [len(text.inputFiles()) for text in statements._reads(spark, paths)]
            assert sum(reads) == len(names) and max(reads) <= most
            if most == 15:
                files, lines = statements.read_files_and_lines(spark, paths)
                assert sorted(r.file for r in files.collect()) == names
                assert sorted(lines.select("file", "line").collect()) == rows
                assert sorted(r.file for r in statements.list_files(spark, paths).collect()) == names
    for name in statements._FOR_MANY_FILES:
        assert spark.conf.get(name, None) is None


def test_several_reads_keep_the_places_of_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(statements, "FILES_AT_ONCE", 2)
    texts = {f"f{k}.csv": [f"Date,Description {k}", *[f"line {k} {n}" for n in range(400)], f'"open\n{k}"'] for k in range(5)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        plain = statements.read_statement_lines(spark, str(tmp_path)).orderBy("file", "block", "pos").collect()
        records = statements.read_statement_lines(spark, str(tmp_path), multiline=True).orderBy("file", "block", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({(r.file, r.block) for r in plain}) > 5
    assert [r.line for r in plain] == [part for name in sorted(texts) for line in texts[name] for part in line.split("\n")]
    assert [r.line for r in records] == [line for name in sorted(texts) for line in texts[name]]


def test_a_path_without_files_is_an_error_as_before(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    for paths in (f"{tmp_path}/none", [str(tmp_path), f"{tmp_path}/none"], f"{tmp_path}/n*"):
        for call in (statements.list_files, statements.read_statement_lines):
            with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
                call(spark, paths)
    (tmp_path / "bare").mkdir()
    files, lines = statements.read_files_and_lines(spark, f"{tmp_path}/bare")
    assert files.count() == lines.count() == 0


def test_hidden_names_are_those_of_spark(spark):
    as_spark = spark._jvm.org.apache.spark.util.HadoopFSUtils.shouldFilterOutPathName
    names = [*ODD_NAMES, "_", ".", "_a=", "._metadata", "_common_metadata.crc", "_metadata._COPYING_", "a._COPYING_", "_x=1._COPYING_", "a_"]
    assert [statements._hidden(f"file:/_t/{name}") for name in names] == [as_spark(name) for name in names]
