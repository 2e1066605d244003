"""Written tables end with the work that wrote them."""

import os

import pytest

import __spark_entry__ as E
from seasonkit import session
from seasonkit.session import lasting_tables, materialize, own_table, owns_tables, written_tables

from .conftest import SF_SMALL


def folders(spark):
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(base) if not f.startswith(".")}


def test_a_scope_removes_what_no_result_reads(spark):
    before = folders(spark)

    @owns_tables
    def query(spark):
        materialize(spark.range(5), "unread")
        spark.range(3).write.saveAsTable(own_table(spark, "unread_table"))
        with written_tables(spark):
            materialize(spark.range(9), "inner")
        return materialize(spark.range(7), "read").filter("id > 1")

    result = query(spark)
    left = folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("read-")
    assert not spark.catalog.tableExists("unread_table") and result.count() == 5


def test_a_failing_query_leaves_nothing(spark):
    before = folders(spark)

    @owns_tables
    def query(spark):
        materialize(spark.range(5), "unread")
        raise ValueError("no result")

    with pytest.raises(ValueError, match="no result"):
        query(spark)
    assert folders(spark) == before


def test_lasting_tables_outlive_the_scope(spark):
    with written_tables(spark):
        with lasting_tables(spark):
            kept = materialize(spark.range(4), "kept")
    assert kept.count() == 4


def test_a_consumed_result_leaves_no_folder(spark):
    """The caller's own scope: a registered query's last table goes when the scope closes."""
    before, tables = folders(spark), {t.name for t in spark.catalog.listTables()}
    with written_tables(spark):
        assert E.queries()["nearest_neighbour"](spark, SF_SMALL).count() == 30
    assert folders(spark) == before and {t.name for t in spark.catalog.listTables()} == tables
