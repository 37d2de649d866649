"""A producer's repeats, kept from a stream without losing a record.

Spark's watermarked removal drops what is late and takes all records without an id for one. Here the
watermark runs on the time of arrival, which a record carries from its source, so being old
does not make a record late; and records that the removal cannot judge go around it:

* without an id: nothing says that two of them are one transaction, both pass;
* older at their arrival than ``horizon``, ahead of it by more than ``ahead``, or without a time: these
  are set aside, to be stored. A repeat can come after its first arrival was forgotten only
  if it is that old, so what passes is never a repeat.

State is an id per transaction of the last two horizons.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.sources.kafka import ARRIVED


def once_each(
    df: DataFrame, horizon: timedelta = timedelta(days=1), ahead: timedelta = timedelta(hours=1), arrived: str = ARRIVED
) -> tuple[DataFrame, DataFrame]:
    """(transactions without repeats, transactions set aside) of a stream with a time of arrival.

    The former lose the column ``arrived``, the latter keep it. Every record is in one of the two, or
    is the repeat of one that passed. Arrivals may be out of order by up to ``horizon + ahead``.
    """
    timely = _timely(F.col(arrived), horizon, ahead)
    passing = df.where(timely)
    delay = f"{int((horizon + ahead).total_seconds())} seconds"
    known = passing.where("transaction_id is not null").withWatermark(arrived, delay)
    unique = known.dropDuplicatesWithinWatermark(["transaction_id"])
    return unique.union(passing.where("transaction_id is null")).drop(arrived), df.where(~timely)


def _timely(arrived: Column, horizon: timedelta, ahead: timedelta) -> Column:
    age = F.unix_micros(arrived) - F.unix_micros("timestamp")
    micro = timedelta(microseconds=1)
    return F.coalesce(age.between(-(ahead // micro), horizon // micro), F.lit(False))
