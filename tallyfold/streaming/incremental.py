"""Loading statement files into a stored ledger as they arrive.

The same operators as a batch load, per micro-batch. A batch that runs again after a failure
adds nothing: rows are inserted by content key only where that key is absent, and what it
rejects and stages lies under the batch's own name, where the second run replaces the first.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.functions.rules import DEFAULT_RULES, RuleSet
from tallyfold.operators.ingest import load_lines
from tallyfold.operators.tables import append_absent, create_monthly
from tallyfold.operators.versions import exists
from tallyfold.plans.runs import label
from tallyfold.session import kept, scratch_within
from tallyfold.sources.records import records
from tallyfold.sources.statements import EMPTY, empty_files, placed


def watch_statements(
    spark: SparkSession,
    folder: str,
    accounts: DataFrame,
    ledger_path: str,
    checkpoint: str,
    mapping: DataFrame | None = None,
    rules: RuleSet = DEFAULT_RULES,
    once: bool = False,
    rejects_path: str | None = None,
    multiline: bool = False,
) -> StreamingQuery:
    """Start loading new files of a folder. With `once`, take what is there and stop.

    A file enters as a whole, in one micro-batch, so its header is found as in a batch load.
    Rejected files and rows go to tables below `rejects_path`, in a folder of each stream (told
    by its checkpoint) and batch, which a repeated batch replaces; a file that is empty is
    rejected by the first batch that finds it.
    """
    create_monthly(spark, ledger_path)
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    ends = {"lineSep": "\n"} if multiline else {}
    arriving = spark.readStream.text(folder, recursiveFileLookup=True, **ends).select("value", "_metadata")

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with scratch_within(session, f"stream-{name}-{number}"):
            lines = kept(session, placed(batch, F.col("value")))
            lines = kept(session, records(lines)) if multiline else lines
            found = load_lines(lines, accounts)
            if rejects_path is not None:
                place = lambda kind: f"{rejects_path}/{kind}/stream={name}"
                files = found.rejected_files.unionByName(_new_empty(session, place("files"), number))
                files.write.mode("overwrite").parquet(f"{place('files')}/batch={number}")
                found.rejected_rows.write.mode("overwrite").parquet(f"{place('rows')}/batch={number}")
            append_absent(session, ledger_path, label(found.transactions, mapping, rules), ["transaction_id"])

    def _new_empty(session: SparkSession, rejected: str, number: int) -> DataFrame:
        empty = empty_files(session, folder).select("file", F.lit(EMPTY).alias("reason"))
        if exists(session, rejected):
            known = session.read.schema("file string, reason string, batch long").option("basePath", rejected).parquet(rejected)
            empty = empty.join(known.where((F.col("batch") < number) & (F.col("reason") == EMPTY)).select("file"), "file", "left_anti")
        # Written apart first, as the batch's own folder may be among those read.
        return kept(session, empty, "empty")

    writer = arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
