"""The exporting command: reports of the logs as files."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from subscriber_analytics import fixtures as fx
from subscriber_analytics.operators import state as st
from subscriber_analytics.plans import export, registry, reports
from subscriber_analytics.streaming import logs
from tests.helpers import values


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("logs"))
    for log in (logs.EVENTS, logs.SCORES):
        registry._recent_log(spark, "/root/testdata/sf0.001", root, log)
    return root


def test_every_report_is_what_the_library_gives(spark, stored, tmp_path):
    export.main(["--root", stored, "--as-of", fx.AS_OF, "--to", str(tmp_path)], spark)
    events, scores = logs.read_log(spark, stored, logs.EVENTS), logs.read_log(spark, stored, logs.SCORES)
    state, view = st.latest_state(events), st.customer_360(events, scores, fx.AS_OF)
    expected = {name: getattr(reports, name)(state) for name in (*export.GROUPED, "churn_velocity", "base_summary")}
    expected |= {"actual_vs_predicted": reports.actual_vs_predicted(view), "customers_at_risk": reports.predicted_churners(view),
                 "customer_360": view, "latest_state": state}
    assert set(expected) == set(export.REPORTS)
    for name, report in expected.items():
        read = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted(read.columns) == sorted(report.columns), name
        read = read.select(*report.columns)
        assert read.count() > 0 and read.exceptAll(report).isEmpty() and report.exceptAll(read).isEmpty(), name


def test_formats_and_repeated_exports(spark, stored, tmp_path):
    for form in ("csv", "json", "csv"):
        export.main(["--root", stored, "--reports", "base_summary", "--to", f"{tmp_path}/{form}", "--format", form], spark)
    read = spark.read.option("header", True).csv(f"{tmp_path}/csv/base_summary")
    assert read.count() == 1
    named = spark.read.json(f"{tmp_path}/json/base_summary")
    assert set(named.columns) == set(read.columns)
    assert values(named.selectExpr("cast(clients_en_base as string) AS n"), "n") == values(read, "clients_en_base")


def test_unknown_names_and_empty_logs(spark, stored, tmp_path):
    with pytest.raises(ValueError, match="no such report: sales"):
        export.main(["--root", stored, "--reports", "sales", "--to", str(tmp_path)], spark)
    with pytest.raises(ValueError, match="no such format"):
        export.write_files({}, str(tmp_path), "xml")
    export.main(["--root", f"{tmp_path}/none", "--reports", "rate_by_contract,base_summary", "--to", f"{tmp_path}/out"], spark)
    assert spark.read.parquet(f"{tmp_path}/out/rate_by_contract").count() == 0
    assert values(spark.read.parquet(f"{tmp_path}/out/base_summary"), "clients_en_base") == [(0,)]


def test_shared_inputs_are_read_once(spark, stored, tmp_path):
    events, scores = logs.read_log(spark, stored, logs.EVENTS), logs.read_log(spark, stored, logs.SCORES)
    found = export.build_reports(events, scores, as_of=fx.AS_OF, folder=str(tmp_path))
    assert all("/landing" not in file for report in found.values() for file in report.inputFiles())
    assert list(found) == list(export.REPORTS)


def test_a_table_is_emptied_not_dropped(spark, monkeypatch):
    seen = []

    def options(self, **given):
        seen.append(given)
        return self

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: None)
    export.write_tables({"base_summary": spark.range(1)}, "jdbc:x", "p_", user="u")
    assert seen == [{"url": "jdbc:x", "dbtable": "p_base_summary", "truncate": "true", "user": "u"}]


def test_arguments():
    given = export.parse_arguments(["--root", "r", "--url", "jdbc:x", "--prefix", "p_"])
    assert given.prefix == "p_" and given.to is None
    with pytest.raises(SystemExit):
        export.parse_arguments(["--root", "r"])
