"""The two runs a user starts: statements to labelled ledger, and sidecars to context views."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyfold.functions.rules import DEFAULT_RULES, RuleSet
from tallyfold.operators.classify import classify
from tallyfold.operators.context import ledger_with_trips, master_ledger
from tallyfold.operators.ingest import ingest_files
from tallyfold.operators.labels import apply_mapping
from tallyfold.operators.reports import monthly_burn
from tallyfold.operators.skew import first_by
from tallyfold.operators.tables import upsert_by_key
from tallyfold.sources.sidecars import PLACE, read_cash_log, read_trips


def label(raw: DataFrame, mapping: DataFrame | None = None, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Rules first, then the mapping for what they leave unknown.

    Always both, as a new sweep of the rules alone would undo earlier patches.
    """
    ledger = classify(raw, rules)
    return ledger if mapping is None else apply_mapping(ledger, mapping)


def statements_to_ledger(
    spark: SparkSession,
    paths: str | list[str],
    accounts: DataFrame,
    mapping: DataFrame | None = None,
    rules: RuleSet = DEFAULT_RULES,
    **options,
) -> DataFrame:
    return label(ingest_files(spark, paths, accounts, **options), mapping, rules)


@dataclass(frozen=True)
class Context:
    """The sidecar views; each is a lazy frame."""

    trips: DataFrame
    cash_log: DataFrame
    ledger_with_trips: DataFrame
    monthly_burn: DataFrame
    master_ledger: DataFrame


def context_views(ledger: DataFrame, trips: DataFrame, cash: DataFrame) -> Context:
    travelled = ledger_with_trips(ledger, trips)
    return Context(trips, cash, travelled, monthly_burn(travelled), master_ledger(ledger, trips, cash))


def sync_sidecars(
    spark: SparkSession, ledger: DataFrame, trips_csv: str, cash_csv: str, stored_trips: DataFrame | None = None
) -> Context:
    """Read both sidecar files and rebuild the views.

    Trips are upserted by trip_id into `stored_trips`, and of rows with one id the last in the
    file counts; the cash file replaces the cash log.
    """
    trips = first_by(read_trips(spark, trips_csv), ["trip_id"], [PLACE], last=True)
    if stored_trips is not None:
        trips = upsert_by_key(stored_trips, trips, "trip_id", [PLACE])
    trips = trips.drop(PLACE)
    return context_views(ledger, trips, read_cash_log(spark, cash_csv))
