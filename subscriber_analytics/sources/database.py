"""Log tables in a database over JDBC. Needs the driver of the database on the class path."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from itertools import islice
from typing import Any

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession

from subscriber_analytics.schemas import EVENT_LOG_RULES, SCORE_LOG_RULES


def read_table(spark: SparkSession, url: str, table: str, id_bounds: tuple[int, int] | None = None,
               partitions: int = 16, id_column: str = "id", **options: str) -> DataFrame:
    """A table, read by ranges of its row id in parallel if the bounds of the id are given.

    The bounds only place the ranges: rows outside them are read as well.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if id_bounds is not None:
        reader = reader.options(
            partitionColumn=id_column, lowerBound=id_bounds[0], upperBound=id_bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def stored_columns(rows: DataFrame) -> DataFrame:
    """The columns that a log table has, in the order of its rules."""
    rules = SCORE_LOG_RULES if "churn_score" in rows.columns else EVENT_LOG_RULES
    return rows.select(*[rule.name for rule in rules if rule.name in rows.columns])


def append_to_table(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Append log rows to a table, as an export of a log.

    Only the stored columns of a log are written: what reading adds (batch, day, source position, reason)
    stays out. A failed and repeated export can append rows twice; the
    Parquet logs cannot.
    """
    stored_columns(rows).write.format("jdbc").options(
        url=url, dbtable=table, **options
    ).mode("append").save()


@dataclass(frozen=True)
class BatchTables:
    """Micro-batches as rows of database tables, each batch once however often it is delivered.

    ``connect`` opens a connection of the Python database interface (PEP 249) in a task or on the driver, ``tables``
    names the table of each log. A table has the stored columns of its log and ``query_id``, ``batch_id``
    and ``part``. The driver first deletes what an earlier delivery left, as its rows may have lain in other parts;
    then each partition deletes and inserts its part in one transaction, so a task that is tried again, or
    twice at once, does not double it. A batch is whole when ``write`` returns; until then a reader can
    see some of its parts.
    """

    connect: Callable[[], Any]
    tables: Mapping[str, str]
    placeholder: str = "%s"
    rows_at_once: int = 1000

    def _run(self, work: Callable[[Any], None]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            work(cursor)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def write(self, rows: DataFrame, log: str, query_id: str, batch_id: int) -> None:
        """Replace the rows of one batch in the table of ``log``; a log without a table is left out."""
        if log not in self.tables:
            return
        table, mark, stored = self.tables[log], self.placeholder, stored_columns(rows)
        names = [*stored.columns, "query_id", "batch_id", "part"]
        delete = f"DELETE FROM {table} WHERE query_id = {mark} AND batch_id = {mark}"
        insert = f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join([mark] * len(names))})"
        self._run(lambda cursor: cursor.execute(delete, (query_id, batch_id)))
        run, at_once = self._run, self.rows_at_once

        def write_part(part_rows: Iterable[Row]) -> None:
            part = TaskContext.get().partitionId()
            found = ((*row, query_id, batch_id, part) for row in part_rows)

            def replace(cursor: Any) -> None:
                cursor.execute(f"{delete} AND part = {mark}", (query_id, batch_id, part))
                while block := list(islice(found, at_once)):
                    cursor.executemany(insert, block)

            run(replace)

        stored.foreachPartition(write_part)
