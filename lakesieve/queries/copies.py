"""Source against target."""

from ..operators import reconcile_counts, rows_to_delete, rows_to_insert, snapshot_upsert
from ..sinks import replace_table, write_table
from ..sources import read_table
from ..storage import scratch_path, staged
from .registry import query, table
from .views import V4_COLUMNS, V4_SOURCE, V4_TARGET, sql, view

_S, _T = sql(V4_SOURCE), sql(V4_TARGET)
_SAME = " AND ".join(f"a.{c} = b.{c}" for c in V4_COLUMNS)


def missing(left: str, right: str, picked: str = "*") -> str:
    return f"SELECT {picked} FROM ({left}) a WHERE NOT EXISTS (SELECT 1 FROM ({right}) b WHERE {_SAME})"


@query("J1_rows_to_insert", missing(_S, _T))
def inserted(spark, sf_dir):
    return rows_to_insert(view(spark, sf_dir, V4_SOURCE), view(spark, sf_dir, V4_TARGET))


@query("J2_rows_to_delete", missing(_T, _S))
def deleted(spark, sf_dir):
    return rows_to_delete(view(spark, sf_dir, V4_SOURCE), view(spark, sf_dir, V4_TARGET))


@query("J1_rows_to_insert_by_hash", missing(_S, _T))
def inserted_by_hash(spark, sf_dir):
    return rows_to_insert(view(spark, sf_dir, V4_SOURCE), view(spark, sf_dir, V4_TARGET), by="fingerprint")


def _snapshot(spark, sf_dir):
    """A stored target that becomes a snapshot of orders, and what that changes."""
    path = scratch_path(spark, "target")
    write_table(view(spark, sf_dir, V4_TARGET), path)
    snapshot, counts = snapshot_upsert(table(spark, sf_dir, "orders"), read_table(spark, path))
    counts = staged(counts, "counts")
    replace_table(snapshot, path)
    return read_table(spark, path), counts


@query("J5_snapshot_upsert", _S)
def upserted(spark, sf_dir):
    return _snapshot(spark, sf_dir)[0]


_DELTA = (
    f"SELECT s.n AS source_rows, t.n AS target_before, s.n AS target_after, i.n AS to_insert, d.n AS to_delete, "
    f"greatest(0, s.n - t.n) AS appended FROM (SELECT count(*) AS n FROM ({_S}) x) s, "
    f"(SELECT count(*) AS n FROM ({_T}) x) t, ({missing(_S, _T, 'count(*) AS n')}) i, ({missing(_T, _S, 'count(*) AS n')}) d")


@query("J5_snapshot_counts", _DELTA)
def upsert_counts(spark, sf_dir):
    return _snapshot(spark, sf_dir)[1]


@query("A17_table_delta", _DELTA)
def table_delta(spark, sf_dir):
    return reconcile_counts(view(spark, sf_dir, V4_SOURCE), view(spark, sf_dir, V4_TARGET))
