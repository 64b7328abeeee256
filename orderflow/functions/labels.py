"""Target definition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def late_label(delivered_at: str = "delivered_at", estimated_at: str = "estimated_at") -> Column:
    """1 when delivered after the promise, 0 when in time, NULL while not delivered."""
    return (F.col(delivered_at) > F.col(estimated_at)).cast("int")


def label_known_at(delivered_at: str = "delivered_at", estimated_at: str = "estimated_at") -> Column:
    """When lateness is settled: with the delivery, or with the promise if that passes first."""
    return F.least(F.col(delivered_at), F.col(estimated_at))


def settled_label(delivered_at: str = "delivered_at", estimated_at: str = "estimated_at") -> Column:
    """The label once it is settled: an order that is open past its promise is late."""
    return F.when(F.col(delivered_at) <= F.col(estimated_at), 0).when(F.col(estimated_at).isNotNull(), 1)


def label_as_of(today: date, delivered_at: str = "delivered_at", estimated_at: str = "estimated_at") -> Column:
    """The settled label if it is known by the end of `today`, else NULL."""
    known = label_known_at(delivered_at, estimated_at) < F.date_add(F.lit(today), 1).cast("timestamp")
    return F.when(known, settled_label(delivered_at, estimated_at))
