"""Brain snapshots: one tenant's rows out of, into and away from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.operators.tables import insert_ignore
from cairngraph.schemas import PRIMARY_KEYS

Tables = dict[str, DataFrame]


def tenant_column(name: str) -> str:
    return "id" if name == "brains" else "brain_id"


def export_brain(tables: Tables, brain_id: str) -> Tables:
    return {
        name: frame.filter(F.col(tenant_column(name)) == brain_id)
        for name, frame in tables.items()
    }


def retarget(snapshot: Tables, brain_id: str) -> Tables:
    """The snapshot under another brain id."""
    return {
        name: frame.withColumn(tenant_column(name), F.lit(brain_id))
        for name, frame in snapshot.items()
    }


def clear_brain(tables: Tables, brain_id: str) -> Tables:
    return {
        name: frame.filter(~F.col(tenant_column(name)).eqNullSafe(F.lit(brain_id)))
        for name, frame in tables.items()
    }


def import_brain(tables: Tables, snapshot: Tables, target_id: str | None = None) -> Tables:
    """The tables with the snapshot added, under its own or another brain id; known keys stay."""
    incoming = snapshot if target_id is None else retarget(snapshot, target_id)
    merged = dict(tables)
    for name, frame in incoming.items():
        merged[name] = (
            insert_ignore(tables[name], frame, PRIMARY_KEYS[name]) if name in tables else frame
        )
    return merged
