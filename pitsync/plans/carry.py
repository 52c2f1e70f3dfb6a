"""Point-in-time snapshots that go on from a carried state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.functions.ordering import OrderKey
from pitsync.operators.snapshots import carry_forward
from pitsync.sources.sinks import LayoutSpec, SnapshotTable

UNTIL = "carried_until"


@dataclass(frozen=True)
class CarriedAsof:
    """As-of snapshots of versions that arrive in increments.

    ``table`` keeps the state, one row per id and those not due yet, with the last point
    done in ``carried_until``. ``late`` says what becomes of versions dated on or before
    that point: ``carry`` lets them count from the next point on, ``reject`` is an error.
    """

    table: SnapshotTable
    ids: Sequence[str]
    date: str
    order: Sequence[OrderKey] = ()
    ties: Sequence[OrderKey] | None = None
    late: str = field(default="carry")

    def done_until(self) -> Any | None:
        """The last point whose snapshot is committed."""
        state = self.table.read()
        return None if state is None else state.agg(F.max(UNTIL)).first()[0]

    def advance(self, increment: DataFrame, points: DataFrame, run_id: str, at: Any) -> tuple[DataFrame, Callable[[], None]] | None:
        """The snapshot at the ``points`` above those done, and what commits the new state.

        Write the snapshot, then commit: a run that stops in between is repeated and gives
        the same rows. A run that is committed gives None.
        """
        if self.table.is_published(run_id):
            return None
        state, until, point = self.table.read(), self.done_until(), points.columns[0]
        if until is not None:
            points = points.where(F.col(point) > F.lit(until))
            if self.late == "reject":
                behind = increment.where(F.col(self.date).cast("date") <= F.lit(until)).limit(1).count()
                if behind:
                    raise ValueError(f"versions dated up to {until}, which is done")
        carried = None if state is None else state.drop(UNTIL)
        last = points.agg(F.max(point)).first()[0] or until
        snapshot, after = carry_forward(carried, increment, points, self.ids, self.date, self.order, self.ties)

        def commit() -> None:
            if points.limit(1).count():
                kept = after
            else:  # no new point: all that came waits for one
                kept = increment if carried is None else carried.unionByName(increment)
            marked = kept.withColumn(UNTIL, F.lit(last).cast("date"))
            _, rows = self.table.write(marked, run_id, LayoutSpec(sort_keys=tuple(self.ids)))
            self.table.publish(run_id, rows, at)

        return snapshot, commit
