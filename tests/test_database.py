"""What is handed to the JDBC source and sink, and the calls of the batch tables; no database takes part."""

import json
import uuid
from pathlib import Path

import pytest

from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from subscriber_analytics.schemas import EVENT_LOG_RULES, SCORE_LOG_RULES
from subscriber_analytics.sources.database import BatchTables, append_to_table, read_table
from subscriber_analytics.streaming import logs


def test_export_leaves_source_position_out(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda self: seen.update(columns=self._df.columns))
    for log, rules in ((logs.EVENTS, EVENT_LOG_RULES), (logs.SCORES, SCORE_LOG_RULES)):
        df = logs.read_log(spark, "/tmp/no-such-log", log)
        append_to_table(df, "jdbc:postgresql://host/db", "churn_data", user="u")
        assert seen["columns"] == [rule.name for rule in rules]


def test_parallel_read(spark, monkeypatch):
    seen = {}

    def options(self, **given):
        seen.update(given)
        return self

    monkeypatch.setattr(DataFrameReader, "options", options)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: None)
    read_table(spark, "jdbc:postgresql://host/db", "churn_data")
    assert seen == {"url": "jdbc:postgresql://host/db", "dbtable": "churn_data"}
    read_table(spark, "jdbc:postgresql://host/db", "churn_data", (1, 900), 4, user="u")
    assert seen == {
        "url": "jdbc:postgresql://host/db", "dbtable": "churn_data", "user": "u",
        "partitionColumn": "id", "lowerBound": 1, "upperBound": 900, "numPartitions": 4}


class Recorder:
    """A connection that writes its calls to a file of its own when it is closed. Nothing runs them."""

    def __init__(self, folder, fail=False):
        self.folder, self.fail, self.calls = folder, fail, []

    def cursor(self):
        return self

    def execute(self, sql, values):
        self.calls.append(["execute", sql, list(values)])

    def executemany(self, sql, rows):
        if self.fail:
            raise ValueError("refused")
        self.calls.append(["executemany", sql, [[str(v) for v in row] for row in rows]])

    def commit(self):
        self.calls.append(["commit"])

    def rollback(self):
        self.calls.append(["rollback"])

    def close(self):
        (Path(self.folder) / uuid.uuid4().hex).write_text(json.dumps(self.calls))


def _calls(folder):
    return [json.loads(f.read_text()) for f in sorted(folder.iterdir(), key=lambda f: f.stat().st_mtime_ns)]


def _scores(spark, n):
    return spark.range(n).repartition(3).selectExpr(
        "concat('c', id) customer_id", "0.5D churn_score", "1 churn_predicted", "0.5D seuil_applique", "'m' model_name",
        "'1' model_version", "timestamp '2024-01-01' event_ts", "timestamp '2024-01-02' predicted_ts", "'x' arrival")


def test_batch_tables_delete_then_insert_each_part_in_one_transaction(spark, tmp_path):
    sink = BatchTables(lambda folder=str(tmp_path): Recorder(folder), {logs.SCORES: "churn_model"}, rows_at_once=4)
    sink.write(_scores(spark, 20), logs.SCORES, "q", 7)
    sink.write(_scores(spark, 20), logs.EVENTS, "q", 7)  # a log without a table
    whole, *parts = _calls(tmp_path)
    assert whole == [["execute", "DELETE FROM churn_model WHERE query_id = %s AND batch_id = %s", ["q", 7]], ["commit"]]
    seen, numbers = [], set()
    for delete, *inserts, end in parts:
        assert delete[1].endswith("AND batch_id = %s AND part = %s") and delete[2][:2] == ["q", 7] and end == ["commit"]
        numbers.add(delete[2][2])
        for name, sql, rows in inserts:
            assert name == "executemany" and sql.startswith("INSERT INTO churn_model (customer_id, churn_score,") and len(rows) <= 4
            assert "arrival" not in sql and all(r[-3:] == ["q", "7", str(delete[2][2])] for r in rows)
            seen += [r[0] for r in rows]
    assert sorted(seen) == sorted(f"c{k}" for k in range(20)) and len(numbers) == len(parts)


def test_a_failed_part_is_rolled_back(spark, tmp_path):
    sink = BatchTables(lambda folder=str(tmp_path): Recorder(folder, fail=True), {logs.SCORES: "churn_model"})
    with pytest.raises(Exception, match="refused"):
        sink.write(_scores(spark, 4).coalesce(1), logs.SCORES, "q", 0)
    assert _calls(tmp_path)[-1][-1] == ["rollback"]
