"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by its content. A ledger keeps, per blob, which
rules (by name and version) have been run over it and what they found. A run scans only the
blob and rule pairs the ledger lacks, then joins the findings back to all paths and versions.

Defined cases: a null text is the empty blob; equal texts are one blob and are scanned once,
whatever the number of paths; rows that repeat a path and version each get the result; an
empty table gives an empty result; null paths and versions are kept. Other columns of the
input are not looked at, so their names cannot clash.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import staged
from tallyfold.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    ignore_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds. Letters of the key names are taken in either case.
BASE = [
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
]
# Kinds added here. Quantifiers do not give back, so a long run of one class is read once.
ADDED = [
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,255}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
]
RULES = BASE + ADDED

_FOUND = "array<struct<kind:string,start:long,end:long>>"
_LEDGER = f"blob string, rules array<string>, found {_FOUND}"


def _compiled(rule: Rule) -> re.Pattern:
    if rule.kind == "hex":  # the same matches, without visiting the short runs one by one
        return re.compile(rf"[0-9a-f]{{{rule.least},}}")
    return re.compile(rule.pattern, re.ASCII)


def find_all(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches per rule; matches that are too short are dropped."""
    found = []
    for rule, pattern in rules:
        for m in pattern.finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((rule.kind, m.start(), m.end()))
    return found


def scan(versions: DataFrame, rules: list[Rule] | None = None, ledger: str | None = None) -> DataFrame:
    """Findings of all versions: `versions` has path, version and text.

    Returns path, version, blob and `found`, an array of (kind, start, end) in code points,
    ordered by start and then by the order of the rules. `ledger` is the folder of the ledger
    table; by default a new one below the shared folder.
    """
    spark = versions.sparkSession
    rules = list(RULES if rules is None else rules)
    ledger = ledger or scratch_path(spark, "ledger")
    addressed = versions.select(
        "path", "version", F.coalesce("text", F.lit("")).alias("text"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob")
    )
    places = staged(addressed.select("path", "version", "blob"), "places")
    known = _ledger(spark, ledger)
    todo = _unseen(places, known, rules)
    texts = addressed.join(
        todo, addressed["blob"].eqNullSafe(todo["_blob"]) & addressed["path"].eqNullSafe(todo["_path"])
    ).select("blob", "text", "_rules")
    # Findings and the fact of the scan are one row, so a run that dies half-way leaves
    # either both or neither; Spark commits the files of a write at its end.
    texts.mapInPandas(_scanner(rules), _LEDGER).write.mode("append").option("compression", "zstd").parquet(ledger)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    kinds = [r.kind for r in rules]
    rank = F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))])
    spans = (
        _ledger(spark, ledger)
        .where(F.arrays_overlap("rules", wanted))
        .select("blob", F.explode("found").alias("f"), "rules")
        .where(_current(rules))
        .select("blob", F.struct("f.start", rank[F.col("f.kind")].alias("rank"), "f.end", "f.kind").alias("f"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set("f")).alias("f"))
    )
    ordered = F.transform("f", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    nothing = F.array().cast(_FOUND)
    return places.join(spans, "blob", "left").select(
        "path", "version", "blob", F.coalesce(ordered, nothing).alias("found")
    )


def _ledger(spark, path: str) -> DataFrame:
    """The ledger so far; a folder that does not exist yet is an empty ledger."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def _current(rules: list[Rule]):
    """Only findings of the rule versions asked for: an older version's ones stay in the ledger."""
    key = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.key))])
    return F.array_contains(F.col("rules"), key[F.col("f.kind")])


def _unseen(places: DataFrame, known: DataFrame, rules: list[Rule]) -> DataFrame:
    """One path per blob with the rules it still needs."""
    blobs = places.groupBy(F.col("blob").alias("_blob")).agg(F.min("path").alias("_path"))
    done = known.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    left = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return (
        blobs.join(done, blobs["_blob"] == done["blob"], "left")
        .select("_blob", "_path", left.alias("_rules"))
        .where(F.size("_rules") > 0)
    )


def _scanner(rules: list[Rule]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = {r.key: (r, _compiled(r)) for r in rules}
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find_all(text, [ready[x] for x in keys])]
                for text, keys in zip(batch["text"], batch["_rules"], strict=True)
            ]
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["_rules"], "found": found})

    return run
