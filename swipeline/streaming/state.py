"""Card alerts that see bursts across micro-batches.

Scoring per micro-batch misses a burst that straddles two batches. Here transactions are first
summed per card and second by a native aggregate: it combines on the map side, so a card with most
of the traffic reaches its state as one row per second, and the watermark releases each second once,
complete and in order. Alerts therefore do not depend on how the input was cut into batches. A small
keyed state then keeps what the rules look back on: running totals, and the seconds of the last
look-back window.

Two differences from the table form follow from working forward in time: the mean covers the seconds
before the present one, and a geography alert holds from the offending second on.

State per card is four numbers and the active seconds of the longest look-back, to which a batch
appends what is new; seconds out of reach are dropped when they are half of the list. The mean runs over
the whole history, so state stays until a card has been idle for ``forget_after``, if that is given.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from swipeline.operators.fraud import FraudConfig

_RECENT = ["second", "txns", "first_country", "last_country", "first_id", "last_id"]


def card_alerts(
    df: DataFrame, config: FraudConfig = FraudConfig(), delay: str = "10 minutes", forget_after: timedelta | None = None
) -> DataFrame:
    """One row per card and second of a stream, with the three rules evaluated on it.

    A card that brings nothing for ``forget_after``, by the times of its transactions, begins anew,
    however the input is cut into batches; a timer removes its state once the watermark is that far. A
    query keeps the choice of its first run, to forget or not. Needs the RocksDB state store of the
    streaming profile.
    """
    if forget_after is not None and forget_after <= timedelta(seconds=max(config.velocity_window_seconds, config.geo_window_seconds)):
        raise ValueError("forget_after must be longer than the look-backs")
    both = F.col("country_code").isNotNull() & F.col("transaction_id").isNotNull()
    located, country = F.when(both, F.col("transaction_id")), F.when(both, F.col("country_code"))
    seconds = (
        df.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 second"), "card_hash")
        .agg(
            F.count(F.lit(1)).alias("txns"),
            F.count("amount").alias("amounts"),
            F.coalesce(F.sum("amount") * 100, F.lit(0)).cast("long").alias("cents"),
            F.max("amount").cast("double").alias("largest"),
            F.min(country).alias("first_country"),
            F.max(country).alias("last_country"),
            F.min(located).alias("first_id"),
            F.max(located).alias("last_id"),
        )
        .withColumn("second", F.unix_seconds("window.start"))
    )
    # Timers need the column that the watermark runs on.
    seconds = seconds if forget_after else seconds.drop("window")
    return seconds.groupBy("card_hash").transformWithStateInPandas(
        statefulProcessor=_CardHistory(config, forget_after and int(forget_after.total_seconds())),
        outputStructType=(
            "card_hash string, second timestamp, txn_count long, velocity_count long,"
            "prior_sample_count long, rolling_avg double, fraud_velocity boolean,"
            "fraud_amount_anomaly boolean, fraud_geo_impossibility boolean"
        ),
        outputMode="Append",
        timeMode="EventTime" if forget_after else "None",
    )


def _last_change(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Per second the latest start from which up to here two values occur; -1 where only one does.

    ``first`` and ``last`` are the least and the greatest value of a second, None where it has none.
    """
    change = np.full(len(first), -1)
    placed = np.flatnonzero([value is not None for value in first])
    if len(placed):
        least, most = first[placed], last[placed]
        change[placed[1:]] = np.where(most[:-1] != least[1:], placed[:-1], -1)
        mixed = placed[least != most]
        change[mixed] = mixed
    return np.maximum.accumulate(change) if len(change) else change


def _texts(column: pd.Series) -> np.ndarray:
    return column.astype(object).where(column.notna(), None).to_numpy(object)


def _rows(seconds: pd.DataFrame) -> list[tuple]:
    plain = seconds.astype(object)
    return list(plain.where(plain.notna(), None).itertuples(index=False, name=None))


class _CardHistory(StatefulProcessor):
    """Per card: totals over all earlier seconds, and the seconds a look-back can still reach."""

    def __init__(self, config: FraudConfig, forget_after: int | None = None) -> None:
        self.config, self.forget_after = config, forget_after
        self.reach = max(config.velocity_window_seconds, config.geo_window_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "txns long, amounts long, cents long, conflict boolean, last long")
        self.recent = handle.getListState(
            "recent",
            "second long, txns long, first_country string, last_country string, first_id string, last_id string",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values("second", ignore_index=True)
        if self.forget_after is None:
            yield self._extend(key, arrived)
            return
        last = self.totals.get()[4] if self.totals.exists() else None
        second = arrived.second.to_numpy("int64")
        idle = np.diff(second, prepend=second[0] if last is None else last) >= self.forget_after
        for first, end in itertools.pairwise([0, *np.flatnonzero(idle[1:]) + 1, len(arrived)]):
            if idle[first]:
                self._forget()
            yield self._extend(key, arrived[first:end].reset_index(drop=True))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(second[-1] + self.forget_after) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._forget()
        return iter(())

    def _forget(self) -> None:
        self.totals.clear()
        self.recent.clear()

    def _extend(self, key, arrived: pd.DataFrame) -> pd.DataFrame:
        config = self.config
        txns, amounts, cents, hit, _ = self.totals.get() if self.totals.exists() else (0, 0, 0, False, None)
        history = pd.DataFrame([tuple(r) for r in self.recent.get()] if self.recent.exists() else [], columns=_RECENT)
        known = len(history)
        seen = pd.concat([history, arrived[_RECENT]], ignore_index=True) if known else arrived[_RECENT]

        # Seconds rise in ``seen``, so a look-back is a slice of it.
        second = seen.second.to_numpy("int64")
        running = np.concatenate([[0], seen.txns.to_numpy("int64").cumsum()])
        here = np.arange(known, len(seen))
        start = np.searchsorted(second, second[here] - config.velocity_window_seconds)
        velocity = running[here + 1] - running[start]
        nearby = np.searchsorted(second, second[here] - config.geo_window_seconds)
        countries = _last_change(_texts(seen.first_country), _texts(seen.last_country))[here]
        ids = _last_change(_texts(seen.first_id), _texts(seen.last_id))[here]
        geo = np.logical_or.accumulate((countries >= nearby) & (ids >= nearby)) | hit

        def before(carried: int, column: str) -> np.ndarray:
            values = arrived[column].to_numpy("int64")
            return carried + values.cumsum() - values

        samples, counted = before(txns, "txns"), before(amounts, "amounts")
        mean = before(cents, "cents") / 100 / np.where(counted > 0, counted, np.nan)
        odd = arrived.largest.to_numpy("float64") > mean * config.amount_multiplier

        self.totals.update(
            (
                int(txns + arrived.txns.sum()),
                int(amounts + arrived.amounts.sum()),
                int(cents + arrived.cents.sum()),
                bool(geo[-1]),
                int(second[-1]),
            )
        )
        in_reach = second >= second[-1] - self.reach
        if in_reach[:known].sum() * 2 < known:
            self.recent.put(_rows(seen[in_reach]))
        else:
            self.recent.appendList(_rows(seen[known:][in_reach[known:]]))
        return pd.DataFrame(
            {
                "card_hash": key[0],
                "second": pd.to_datetime(arrived.second, unit="s"),
                "txn_count": arrived.txns,
                "velocity_count": velocity,
                "prior_sample_count": samples,
                "rolling_avg": mean,
                "fraud_velocity": velocity > config.velocity_max_txns,
                "fraud_amount_anomaly": (samples >= config.amount_min_samples) & odd,
                "fraud_geo_impossibility": geo,
            }
        )
