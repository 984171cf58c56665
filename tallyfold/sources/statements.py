"""Statement files: lines, cells, header discovery and column roles.

Files are read by line and split by Spark as usual, so a very large file is many tasks'
work. Files of a load go through scans of ten thousand; nothing loops over files.
"""

import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.columns import as_column, computed_once
from tallyfold.operators.skew import dimension_join, fits_broadcast
from tallyfold.sources.records import records
from tallyfold.session import kept, kept_in_turn, scratch_path

# Header names that mark a column's role.
DATE_ALIASES = ("date", "trans. date", "transaction date", "post date")
DESC_ALIASES = ("description", "memo", "details", "transaction description", "name", "payee", "merchant")
AMT_ALIASES = ("amount", "amt", "value", "transaction amount", "charge")
HEADER_WINDOW = 25
FILES_AT_ONCE = 10_000  # files of one read
# Opening a file counts for few bytes, as statements are small and a task reads many. A task looks up many
# names, too, where files are named one by one. Listings are not remembered: they would stay on the driver.
_FOR_MANY_FILES = {
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}

NO_HEADER = "no header row with a date and a description column"
NO_ROLES = "date or description column not mapped"
NO_AMOUNT = "amount column not mapped"
TOO_WIDE = "more cells than the header"
EMPTY = "empty file"
NO_ACCOUNT = "no account for the file"
_BLANKS = " \t\n\r\f\v\u00a0"

# One cell after its comma: quoted (doubled quotes inside) or plain.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'
_QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def on_disk(uri: Column | str) -> Column:
    """A file's path as it is on disk, from the URI Spark gives."""
    plain = F.url_decode(F.replace(as_column(uri), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:///")


def placed(text: DataFrame, line: Column) -> DataFrame:
    """File, block and position of each line."""
    return text.select(
        on_disk("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        line.alias("line"),
    )


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All files by path, those without any line included: the listing that a read starts from.

    More files than one read takes are kept below the shared folder.
    """
    with _many_files(spark):
        reads = (_listed(text) for text in _reads(spark, paths))
        first, second = next(reads), next(reads, None)
        return first if second is None else kept_in_turn(spark, chain([first, second], reads), "files")


def _listed(text: DataFrame) -> DataFrame:
    """The files of a read by path. Names come as one text, as URIs hold no line breaks; one by one they take minutes."""
    spark = text.sparkSession
    names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", text._jdf.inputFiles())
    found = pa.table({"uri": pa.array(names.split("\n") if names else [], pa.string())})
    return spark.createDataFrame(found).select(on_disk("uri").alias("file"))


@contextmanager
def _many_files(spark: SparkSession) -> Iterator[None]:
    """Settings for reads of many small files, each unless the session gives its own."""
    own = {name: value for name, value in _FOR_MANY_FILES.items() if spark.conf.get(name, None) is None}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def _reads(spark: SparkSession, paths: str | list[str], **options) -> Iterator[DataFrame]:
    """Reads that give each file of `paths` once, of FILES_AT_ONCE files at most.

    Spark's driver holds a few kilobytes per file of a read, so it cannot take any number of files in one.
    """
    share, size = [], 0
    for path, files in _pieces(spark, [paths] if isinstance(paths, str) else paths):
        if share and size + files > FILES_AT_ONCE:
            yield spark.read.text(share, recursiveFileLookup=True, **options)
            share, size = [], 0
        share.append(path)
        size += files
    yield spark.read.text(share, recursiveFileLookup=True, **options)


def _pieces(spark: SparkSession, paths: list[str]) -> Iterator[tuple[str, int]]:
    """Paths that hold the files of `paths` between them, with the number of files in each.

    A folder of few files stays whole, and its read lists it; others are taken apart. The driver holds the
    names of one folder at a time.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsparkSession.sessionState().newHadoopConf()

    def below(system, folder) -> Iterator[tuple[str, int]]:
        total = system.getContentSummary(folder)
        if total.getFileCount() <= FILES_AT_ONCE:
            yield _literal(folder.toString()), total.getFileCount()
            return
        if total.getDirectoryCount() == 1:
            # Nothing but files, whose names come as one text per read; asked one by one they take minutes.
            places = spark._jvm.scala.Predef.genericWrapArray(hadoop.fs.FileUtil.stat2Paths(system.listStatus(folder)))
            for start in range(0, places.size(), FILES_AT_ONCE):
                names = places.slice(start, start + FILES_AT_ONCE).mkString("\0")
                yield from ((_literal(name), 1) for name in names.split("\0") if not _hidden(name))
            return
        for status in system.listStatus(folder):
            inside = status.getPath()
            if _hidden(inside.toString()):
                continue
            if status.isDirectory():
                yield from below(system, inside)
            else:
                yield _literal(inside.toString()), 1

    roots = {}
    for path in paths:
        system = hadoop.fs.Path(path).getFileSystem(conf)
        found = system.globStatus(hadoop.fs.Path(path))
        if not found:
            yield path, 0  # its read says that there is none
        for status in found or []:
            roots[status.getPath().toString().rstrip("/")] = system, status
    for path, (system, status) in roots.items():
        if any(folder in roots for folder in _listed_by(path)):
            continue
        if status.isDirectory():
            yield from below(system, status.getPath())
        else:
            yield _literal(path), 1


def _hidden(path: str) -> bool:
    """Whether listings pass over a file or folder, as Spark's do."""
    name = path.rpartition("/")[2]
    marked = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return marked and not name.startswith(("_metadata", "_common_metadata"))


def _listed_by(path: str) -> Iterator[str]:
    """The folders above a path whose listings hold it: none above a hidden one."""
    while "/" in path and not _hidden(path):
        path = path.rpartition("/")[0]
        yield path


def _literal(path: str) -> str:
    """A path whose brackets and stars are no pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def empty_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files without a byte, from the listing alone: a scan passes them over."""
    scanned = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    path = F.regexp_replace("path", "^file:/+", "file:///").alias("file")
    return list_files(spark, paths).join(scanned.select(path), "file", "left_anti")


def read_statement_lines(spark: SparkSession, paths: str | list[str], multiline: bool = False) -> DataFrame:
    """All lines as (file, block, pos, line), read now and kept below the shared folder.

    `pos` goes up by one per line inside a block (file split); blocks are ordered by offset.
    Together with the file they give every line a place, which stays as it is. With
    `multiline`, a quoted cell may hold line breaks and a `line` is a whole record; files are
    split all the same, at the price of a shuffle of their lines.
    """
    return read_files_and_lines(spark, paths, multiline)[1]


def read_files_and_lines(
    spark: SparkSession, paths: str | list[str], multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """`list_files` and `read_statement_lines` from one listing."""
    # Split at line feeds only, so that a carriage return inside a cell is kept.
    ends = {"lineSep": "\n"} if multiline else {}
    names, rows = scratch_path(spark, "files"), scratch_path(spark, "lines")
    with _many_files(spark):
        for text in _reads(spark, paths, **ends):
            files, lines = _listed(text), placed(text, F.col("value"))
            files.coalesce(1).write.mode("append").parquet(names)
            lines.write.mode("append").parquet(rows)
    files, lines = (spark.read.schema(df.schema).parquet(at) for df, at in ((files, names), (lines, rows)))
    return files, kept(spark, records(lines)) if multiline else lines


def split_cells(line: Column | str) -> Column:
    """CSV cells of one line as an array, any width: empty cells are NULL, quotes undone.

    Only lines that hold a quote need the regular expression.
    """
    text = as_column(line)
    quoted = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_CELL), 1)

    def unquote(cell: Column) -> Column:
        whole = cell.endswith('"') & (F.length(cell) > 1)
        inner = F.replace(F.substr(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        odd = F.concat(
            F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"')),
            F.regexp_extract(cell, _QUOTED, 2),
        )
        return F.when(~cell.startswith('"'), cell).when(whole, inner).when(cell.rlike(_QUOTED), odd).otherwise(cell)

    empty = F.lit("")
    return F.when(
        text.contains('"'), F.transform(quoted, lambda cell: F.nullif(unquote(cell), empty))
    ).otherwise(F.transform(F.split(text, ","), lambda cell: F.nullif(cell, empty)))


def statement_cells(lines: DataFrame) -> DataFrame:
    """Lines with their cells. A byte order mark and a trailing carriage return are dropped."""
    return computed_once(lines, "cells", _cells_of("line"))


def read_statement_cells(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return statement_cells(read_statement_lines(spark, paths)).drop("line")


def _names(cells: Column) -> Column:
    """Header names as they are compared: trimmed, in lower case, absent ones empty."""
    return F.transform(cells, lambda name: F.lower(F.btrim(F.coalesce(name, F.lit("")), F.lit(_BLANKS))))


def _is_header(cells: Column) -> Column:
    names = _names(cells)
    return F.arrays_overlap(names, _literals(DATE_ALIASES)) & F.arrays_overlap(names, _literals(DESC_ALIASES))


def _literals(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def discover_headers(lines: DataFrame) -> DataFrame:
    """Per file the first of its first 25 lines that names a date and a description column.

    The grouping sees positions only; the cells of the one line found are joined to them.
    `header` is NULL for a file without such a line.
    """
    maybe = F.lower("line").contains("date")
    head = computed_once(lines.where(F.col("block") == 0), "cells", F.when(maybe, _cells_of("line")))
    found = head.groupBy("file").agg(
        F.min("pos").alias("first"), F.min(F.when(_is_header(F.col("cells")), F.col("pos"))).alias("at")
    )
    near = F.col("at") - F.col("first") < HEADER_WINDOW
    found = found.select("file", "first", F.when(near, F.col("at")).alias("header_pos"))
    texts = head.where(_is_header(F.col("cells"))).select("file", F.col("pos").alias("header_pos"), "cells")
    return found.join(texts, ["file", "header_pos"], "left").select(
        "file",
        (F.col("header_pos") - F.col("first")).alias("header_line"),
        "header_pos",
        F.col("cells").alias("header"),
    )


def _cells_of(line: str) -> Column:
    return split_cells(F.rtrim(F.ltrim(line, F.lit("\ufeff")), F.lit("\r")))


def _holds_alias(name: Column, aliases: tuple[str, ...]) -> Column:
    """Equal to or containing an alias; the second covers the first."""
    return F.exists(_literals(aliases), lambda alias: name.contains(alias))


def map_columns(headers: DataFrame) -> DataFrame:
    """Column positions of date, description and amount, or the reason there are none.

    The header is read left to right. Each column takes the first of the three roles that is
    still free and whose alias its name holds, so a second date-like column may be offered to
    the other two roles.
    """
    entries = F.transform(
        _names(F.col("header")),
        lambda name, at: F.struct(
            at.alias("at"),
            _holds_alias(name, DATE_ALIASES).alias("date"),
            _holds_alias(name, DESC_ALIASES).alias("desc"),
            _holds_alias(name, AMT_ALIASES).alias("amt"),
        ),
    )
    free = F.lit(None).cast("int")
    start = F.struct(free.alias("date_ix"), free.alias("desc_ix"), free.alias("amt_ix"))

    def take(roles: Column, entry: Column) -> Column:
        is_date = entry["date"] & roles["date_ix"].isNull()
        is_desc = ~is_date & entry["desc"] & roles["desc_ix"].isNull()
        is_amt = ~is_date & ~is_desc & entry["amt"] & roles["amt_ix"].isNull()
        return F.struct(
            F.when(is_date, entry["at"]).otherwise(roles["date_ix"]).alias("date_ix"),
            F.when(is_desc, entry["at"]).otherwise(roles["desc_ix"]).alias("desc_ix"),
            F.when(is_amt, entry["at"]).otherwise(roles["amt_ix"]).alias("amt_ix"),
        )

    mapped = headers.withColumn("_roles", F.aggregate(entries, start, take)).select(
        "file", "header", "header_line", "header_pos", F.size("header").alias("width"), "_roles.*"
    )
    reason = (
        F.when(F.col("header").isNull(), NO_HEADER)
        .when(F.col("date_ix").isNull() | F.col("desc_ix").isNull(), NO_ROLES)
        .when(F.col("amt_ix").isNull(), NO_AMOUNT)
    )
    return mapped.withColumn("reject_reason", reason).drop("header")


def rejected_files(columns: DataFrame) -> DataFrame:
    """Files that cannot be read as a statement, with the reason."""
    return columns.where(F.col("reject_reason").isNotNull()).select(
        "file", F.col("reject_reason").alias("reason")
    )


def raise_on_rejects(columns: DataFrame) -> None:
    """Strict mode: fail on the first file that cannot be mapped."""
    bad = rejected_files(columns).orderBy("file").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].file}: {bad[0].reason}")


def _body(lines: DataFrame, columns: DataFrame, small: bool | None) -> DataFrame:
    """Non-blank lines behind the header of usable files, with the file's column positions."""
    if small is None:
        small = fits_broadcast(lines.select("file").distinct())
    usable = columns.where(F.col("reject_reason").isNull()).select(
        "file", "header_pos", "width", "date_ix", "desc_ix", "amt_ix", *_account_of(columns)
    )

    def condition(line, head):
        behind = (line("block") > 0) | (line("pos") > head("header_pos"))
        return (line("file") == head("file")) & behind

    joined = dimension_join(lines.where(F.trim("line") != ""), usable, condition, "pos", "inner", small, {"file": "file"})
    kept = joined.select(
        *[F.col(f"facts.{name}") for name in ("file", "block", "pos", "line")],
        *usable.columns[2:],
    )
    return computed_once(kept, "cells", _cells_of("line"))


def _account_of(columns: DataFrame) -> list[str]:
    """Account columns, where the files have been given theirs already."""
    return [name for name in ("account_name", "account_type", "sign_rule") if name in columns.columns]


def _too_wide() -> Column:
    """A row with a value beyond the header's last column; empty extra cells are harmless."""
    extra = F.slice("cells", F.col("width") + 1, F.greatest(F.size("cells") - F.col("width"), F.lit(0)))
    return F.exists(extra, lambda cell: cell.isNotNull())


def statement_rows(lines: DataFrame, columns: DataFrame, small: bool | None = None) -> DataFrame:
    """Body rows as texts: (file, block, pos, date_text, description, amount_text).

    Short rows are padded with NULL; rows too wide for the header are left to `wide_rows`.
    """
    rows = _body(lines, columns, small)
    return rows.where(~_too_wide()).select(
        "file",
        "block",
        "pos",
        F.get("cells", F.col("date_ix")).alias("date_text"),
        F.get("cells", F.col("desc_ix")).alias("description"),
        F.get("cells", F.col("amt_ix")).alias("amount_text"),
        *_account_of(columns),
    )


def wide_rows(lines: DataFrame, columns: DataFrame, small: bool | None = None) -> DataFrame:
    """Quarantine: body rows that hold more values than the header has columns."""
    rows = _body(lines, columns, small)
    return rows.where(_too_wide()).select("file", "block", "pos", "line", F.lit(TOO_WIDE).alias("reason"))


def preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First n rows of a CSV file as it is, under its own header; of a folder, of its first file by name."""
    first = unquote(min(spark.read.text(path).inputFiles(), default=path))
    return spark.read.option("header", True).csv(first).limit(n)
