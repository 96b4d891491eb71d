"""The jobs over a metadata database. DuckDB, inside this process, takes the
statements; tables pass between it and Spark as rows, as JDBC would pass them."""

import datetime as dt

import duckdb
import pytest

import driftlens.sources.metadata_db as mdb
from driftlens.sources import fixtures as fx
from driftlens.sources.connectors import Connector
from driftlens.sources.live import LiveMetadata
from driftlens.types import LIVE_COLUMNS

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def database(spark, monkeypatch):
    con = duckdb.connect()
    con.execute('CREATE TABLE master_configuration (config_id INT, table_name TEXT, check_type TEXT, created_by TEXT, is_active BOOLEAN, is_deleted BOOLEAN, "updatedAt" TIMESTAMP)')
    con.execute("CREATE TABLE schema_configuration (CONFIG_ID INT, column_name TEXT, data_type TEXT, is_nullable TEXT, character_maximum_length INT, ordinal_position INT)")
    con.execute("CREATE TABLE master_config_status (check_type TEXT, updated_at TIMESTAMP)")
    con.execute("CREATE TABLE anamoly_master (anamoly TEXT, compare_columns TEXT[], anamoly_type INT)")
    con.execute(
        "CREATE TABLE schema_anamoly (config_id INT, column_name TEXT, data_type TEXT, data_type_old TEXT, ordinal_position INT, ordinal_position_old INT, is_nullable TEXT, "
        "is_nullable_old TEXT, character_maximum_length INT, character_maximum_length_old INT, anamoly_id INT, updated_at TIMESTAMP, user_input BOOLEAN DEFAULT false)"
    )
    con.executemany("INSERT INTO anamoly_master VALUES (?, ?, ?)", fx.RULE_ROWS)
    con.execute("INSERT INTO master_config_status VALUES ('schema', '2024-01-01'), ('distribution', '2023-01-01')")
    con.executemany("INSERT INTO master_configuration VALUES (?, ?, 'schema', 'u', true, false, ?)", [(1, "x:c.s.t1", T0 + dt.timedelta(days=1)), (2, "x:c.s.t2", T0 + dt.timedelta(days=2)), (None, "x:c.s.t1", T0 + dt.timedelta(days=3))])

    def read_table(spark, conn, table):
        cur = con.execute(f"SELECT * FROM {table}")
        types = {"INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}
        schema = ", ".join(f"`{d[0]}` {types[str(d[1])]}" for d in cur.description)
        return spark.createDataFrame(cur.fetchall(), schema)

    def write(rows, conn, table, mode="append", **_):
        assert mode == "overwrite"
        frame = rows.toPandas()  # noqa: F841  read by DuckDB
        con.execute(f"CREATE OR REPLACE TABLE {table} AS SELECT * FROM frame")

    def execute(spark, conn, statements):
        con.begin()
        for sql in statements:
            con.execute(sql)
        con.commit()

    monkeypatch.setattr(mdb, "read_table", read_table)
    monkeypatch.setattr(mdb, "execute", execute)
    monkeypatch.setattr(mdb.stage, "__defaults__", (write,))
    return con


def live(spark, tables, case="exact"):
    rows = [("c", "s", t, c, "int", "YES", None, str(i)) for t, cols in tables.items() for i, c in enumerate(cols, 1)]
    return LiveMetadata(spark.createDataFrame(rows, LIVE_COLUMNS), case)


def captured(con):
    return con.execute("SELECT config_id, column_name FROM schema_configuration ORDER BY 1, 2").fetchall()


def test_capture_then_detection_and_reruns(spark, database):
    db = mdb.MetadataDb(Connector("meta", "postgresql", url="jdbc:postgresql://nowhere/none"))
    tables = {"t1": ["a", "b"], "t2": ["a"]}
    out = mdb.capture_to_database(spark, db, {}, "day1", live=lambda due: live(spark, tables))
    assert out == {"due": 2, "captured": 3, "rejected": 1}
    want = [(1, "a"), (1, "b"), (2, "a")]
    assert captured(database) == want
    assert database.execute("SELECT updated_at FROM master_config_status WHERE check_type = 'schema'").fetchone()[0] == T0 + dt.timedelta(days=3)
    assert mdb.capture_to_database(spark, db, {}, "day2", live=lambda due: live(spark, tables))["due"] == 0
    # a run that stopped between its two statements' transaction and its report is run again
    database.execute("UPDATE master_config_status SET updated_at = TIMESTAMP '2024-01-01' WHERE check_type = 'schema'")
    database.execute(mdb.move_baseline(db, db.staging("schema_configuration", "day1")))
    assert captured(database) == want
    assert mdb.capture_to_database(spark, db, {}, "day1", live=lambda due: live(spark, tables))["captured"] == 0
    assert captured(database) == want
    database.execute("DELETE FROM master_configuration WHERE config_id IS NULL")
    drifted = live(spark, {"t1": ["a"], "t2": ["a", "z"]}, "lower")
    for _ in range(2):
        assert mdb.detect_to_database(spark, db, {}, T0 + dt.timedelta(days=9), "run9", live=drifted) > 0
    found = database.execute("SELECT config_id, column_name, anamoly_id, updated_at, user_input FROM schema_anamoly WHERE anamoly_id IN (0, 1) ORDER BY 1").fetchall()
    when = T0 + dt.timedelta(days=9)
    assert found == [(1, "b", 0, when, False), (2, "z", 1, when, False)]


def test_the_mark_never_moves_back(database):
    db = mdb.MetadataDb(Connector("meta", "postgresql", url="jdbc:postgresql://nowhere/none"))
    for day, want in ((5, 5), (3, 5), (7, 7)):
        database.execute(mdb.move_mark(db, "schema", T0 + dt.timedelta(days=day)))
        assert database.execute("SELECT updated_at FROM master_config_status WHERE check_type = 'schema'").fetchone()[0] == T0 + dt.timedelta(days=want)
    assert mdb.MetadataDb(db.conn, "meta").staging("t", "k").startswith("meta.t_") and db.staging("t", "a") != db.staging("t", "b")
