"""Write reports of the logs to files or tables: ``python -m subscriber_analytics.plans.export --help``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from subscriber_analytics.operators.state import join_360, latest_score, latest_state
from subscriber_analytics.plans import reports
from subscriber_analytics.plans.views import materialize
from subscriber_analytics.session import build_session, work_dir
from subscriber_analytics.streaming import logs

log = logging.getLogger("subscriber_analytics")

FORMATS = ("parquet", "csv", "json")

# What is computed from the latest states alone; the grouped ones come from one pass over them.
GROUPED = {"rate_by_contract": "contract", "rate_by_tenure": "tranche", "rate_by_services": "nb_services",
           "cohort_retention": "mois_cohorte", "weekly_trend": "semaine"}
OF_STATE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "latest_state": lambda state: state,
    "churn_velocity": reports.churn_velocity,
    "base_summary": reports.base_summary,
}
# What needs the scores too. Files have no order, so the risk list is whole.
OF_VIEW: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customer_360": lambda view: view,
    "actual_vs_predicted": reports.actual_vs_predicted,
    "customers_at_risk": reports.predicted_churners,
}
REPORTS = (*GROUPED, *OF_STATE, *OF_VIEW)


def build_reports(events: DataFrame, scores: DataFrame, names: Iterable[str] = REPORTS, as_of=None,
                  folder: str | None = None) -> dict[str, DataFrame]:
    """The named reports. What several of them share is written once below ``folder`` and read back.

    The latest states are found once, the grouped reports are cut from one pass over them, and the customer view
    is joined once. ``folder`` is a new one below the shared folder if not given.
    """
    names = list(names)
    unknown = [name for name in names if name not in REPORTS]
    if unknown:
        raise ValueError(f"no such report: {', '.join(unknown)}")
    folder = work_dir(events.sparkSession, "export") if folder is None else folder
    state = materialize(latest_state(events), f"{folder}/state")
    found = {name: OF_STATE[name](state) for name in names if name in OF_STATE}
    if any(name in GROUPED for name in names):
        rates = materialize(reports.all_rates(state), f"{folder}/rates")
        found |= {name: reports.grouped_report(rates, GROUPED[name]) for name in names if name in GROUPED}
    if any(name in OF_VIEW for name in names):
        view = materialize(join_360(state, latest_score(scores), as_of), f"{folder}/view")
        found |= {name: OF_VIEW[name](view) for name in names if name in OF_VIEW}
    return {name: found[name] for name in names}


def write_files(found: dict[str, DataFrame], target: str, form: str = "parquet") -> None:
    """A folder a report; a report that is there already is replaced."""
    if form not in FORMATS:
        raise ValueError(f"no such format: {form}")
    options = {"csv": {"header": True, "escape": '"'}, "json": {"ignoreNullFields": False}}.get(form, {})
    for name, report in found.items():
        report.write.mode("overwrite").options(**options).format(form).save(f"{target}/{name}")


def write_tables(found: dict[str, DataFrame], url: str, prefix: str = "", **options: str) -> None:
    """A database table a report, emptied and filled again with its definition, indexes and rights kept."""
    for name, report in found.items():
        report.write.format("jdbc").options(url=url, dbtable=f"{prefix}{name}", truncate="true", **options).mode(
            "overwrite").save()


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the logs")
    parser.add_argument("--reports", default=",".join(REPORTS))
    parser.add_argument("--as-of", help="reading time of the reports; now if absent")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--to", help="folder of the reports")
    target.add_argument("--url", help="JDBC address of a database instead")
    parser.add_argument("--format", choices=FORMATS, default="parquet")
    parser.add_argument("--prefix", default="", help="of the names of the tables")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    given = parse_arguments(arguments)
    spark = build_session() if spark is None else spark
    events, scores = (logs.read_log(spark, given.root, name) for name in (logs.EVENTS, logs.SCORES))
    found = build_reports(events, scores, given.reports.split(","), given.as_of)
    if given.to:
        write_files(found, given.to, given.format)
    else:
        write_tables(found, given.url, given.prefix)
    log.info("exported: %s", ", ".join(found))


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
