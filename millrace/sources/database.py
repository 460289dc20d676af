"""Export to a relational table through a staging table, and the checks afterwards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.session import written


def answer(spark: SparkSession, url: str, query: str, properties: Mapping[str, str]) -> DataFrame:
    """The result of a query that the database runs; only its rows come to Spark."""
    return spark.read.jdbc(url, f"({query}) answer", properties=dict(properties))


def staged_count(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> int:
    """The row count of a database table."""
    return answer(spark, url, f"SELECT count(*) AS n FROM {table}", properties).first()[0]


def move_statements(table: str, staging: str, columns) -> list[str]:
    """The statements that publish the staged rows; they run in one transaction."""
    names = ", ".join(columns)
    return [
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
        f"DELETE FROM {staging}",
    ]


def run_in_transaction(connection, statements) -> None:
    """All statements or none, on an open JDBC connection, which is closed at the end."""
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            statement.close()
    finally:
        connection.close()


def open_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A JDBC connection on the driver, for statements a DataFrame writer cannot send."""
    jvm = spark.sparkContext._jvm
    known = jvm.java.util.Properties()
    for name, value in properties.items():
        known.setProperty(name, value)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, known)


def export_table(
    rows: DataFrame,
    url: str,
    table: str,
    staging: str,
    properties: Mapping[str, str],
    connections: int = 16,
    batch_size: int = 10_000,
    attempts: int = 3,
) -> int:
    """Write `rows` to `table`, all or nothing, and return how many rows were written.

    The rows go to the staging table in parallel. A task that is retried after its executor was
    lost may have committed twice, so the staged count is compared with the source count before
    anything is published; on a difference the staging table is emptied and filled again. The
    target is touched only by the final transaction.
    """
    spark = rows.sparkSession
    # Computed once, as wide as it is; only the reading of the finished rows is as narrow as the database's connections.
    rows = written(rows, "export")
    expected = rows.count()
    writer = rows.coalesce(connections).write.option("truncate", "true").option("batchsize", batch_size)
    for _ in range(attempts):
        writer.mode("overwrite").jdbc(url, staging, properties=dict(properties))
        staged = staged_count(spark, url, staging, properties)
        if staged == expected:
            run_in_transaction(
                open_connection(spark, url, properties), move_statements(table, staging, rows.columns)
            )
            return expected
    raise RuntimeError(f"{staging} holds {staged} rows, {expected} expected; {table} is unchanged")


def read_back(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> DataFrame:
    """The exported table as a DataFrame; filters and the choice of columns run in the database."""
    return spark.read.jdbc(url, table, properties=dict(properties))
