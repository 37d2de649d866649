"""Fraud rules over the history of each card.

All three rules look back along one card's transactions:

* velocity: how many in the last N seconds;
* amount: is the amount far above the mean of the card's earlier amounts;
* geography: were two transactions in different countries within W minutes.

One plan holds two ways through it, both exact, and takes a card by the one or the other:

* An ordinary card fits one task. Window functions over one shuffle by card answer all rules.
* A busy card (more than ``busy_card_rows`` transactions; it may hold a third of the table) is never
  gathered. Its rows are first summed per second, on the map side. The look-backs run over these
  seconds in slices of time that carry a copy of the seconds just before them, totals of earlier
  slices are carried forward, and each transaction then picks up the values of its second. A busy
  second is no group either: a sample of the rows cuts it into pieces in the order of its transactions,
  pieces are summed on the map side, and their totals are carried forward like those of slices.

Counting the cards and drawing the sample are steps of the plan: building a query starts no job and
brings nothing to the driver. The list of busy cards and the cuts are broadcast, since both are
bounded whatever the table holds (``_MOST_BUSY`` and ``_CUTS``). Where no card is busy, Spark finds the
list empty and drops that part of the plan. A hash collision only sends an ordinary card down the
longer way.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from swipeline.functions.columns import epoch_second

REASONS = {
    "fraud_velocity": "VELOCITY",
    "fraud_amount_anomaly": "AMOUNT_ANOMALY",
    "fraud_geo_impossibility": "GEO_IMPOSSIBILITY",
}

_SLICE_SECONDS = 3600
# At most this many cards can hold more than this part of all rows.
_MOST_BUSY = 50_000
# Rows drawn to cut busy seconds: a piece holds about this part of the rows of busy cards.
_CUTS = 16_384
_CUT_RUN = 64
_HISTORY = ("velocity_count", "_prior_rows", "_prior_amounts", "_prior_total", "_geo_hit")


@dataclass(frozen=True)
class FraudConfig:
    """Thresholds of the three rules, and the row count from which a card is treated as busy."""

    velocity_window_seconds: int = 60
    velocity_max_txns: int = 5
    amount_multiplier: float = 3.0
    amount_min_samples: int = 3
    geo_window_minutes: int = 30
    busy_card_rows: int = 1_000_000

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> FraudConfig:
        """Read the deployment's threshold variables; unset ones keep their defaults."""
        names = {
            "velocity_window_seconds": "FRAUD_VELOCITY_WINDOW_SECONDS",
            "velocity_max_txns": "FRAUD_VELOCITY_MAX_TXN",
            "amount_multiplier": "FRAUD_AMOUNT_MULTIPLIER",
            "geo_window_minutes": "FRAUD_GEO_WINDOW_MINUTES",
        }
        kinds = {f.name: type(f.default) for f in fields(cls)}
        return cls(**{k: kinds[k](env[v]) for k, v in names.items() if v in env})

    @property
    def geo_window_seconds(self) -> int:
        return self.geo_window_minutes * 60


def flag_velocity(
    df: DataFrame, window_seconds: int = 60, max_txns: int = 5, busy_card_rows: int = 1_000_000
) -> DataFrame:
    """Add ``velocity_count`` and ``fraud_velocity``: more than ``max_txns`` in the last seconds.

    The look-back is inclusive at both ends and counts every transaction of the same second.
    """
    config = FraudConfig(
        velocity_window_seconds=window_seconds,
        velocity_max_txns=max_txns,
        busy_card_rows=busy_card_rows,
    )
    return _with_history(df, config).select(
        *df.columns, "velocity_count", _velocity_flag(config).alias("fraud_velocity")
    )


def flag_amount_anomaly(
    df: DataFrame, multiplier: float = 3.0, min_samples: int = 3, busy_card_rows: int = 1_000_000
) -> DataFrame:
    """Add the mean of the card's earlier signed amounts and ``fraud_amount_anomaly``."""
    config = FraudConfig(
        amount_multiplier=multiplier, amount_min_samples=min_samples, busy_card_rows=busy_card_rows
    )
    return _with_history(df, config).select(
        *df.columns,
        F.col("amount").cast("double").alias("amount_dbl"),
        _prior_mean().alias("rolling_avg"),
        F.col("_prior_rows").alias("prior_sample_count"),
        _amount_flag(config).alias("fraud_amount_anomaly"),
    )


def flag_geo_impossibility(
    df: DataFrame, window_minutes: int = 30, busy_card_rows: int = 1_000_000
) -> DataFrame:
    """Add ``fraud_geo_impossibility``, true on every row of a card with any offending pair."""
    config = FraudConfig(geo_window_minutes=window_minutes, busy_card_rows=busy_card_rows)
    return _with_history(df, config).select(
        *df.columns, F.col("_geo_hit").alias("fraud_geo_impossibility")
    )


def multi_country_cards(
    df: DataFrame, window_minutes: int = 30, busy_card_rows: int = 1_000_000
) -> DataFrame:
    """The cards with any offending pair, one row each."""
    flagged = flag_geo_impossibility(df, window_minutes, busy_card_rows)
    return flagged.where("fraud_geo_impossibility").select("card_hash").distinct()


def apply_all_fraud_rules(df: DataFrame, config: FraudConfig = FraudConfig()) -> DataFrame:
    """Add ``fraud_reasons`` and ``is_fraud_flagged``; rows and other columns stay as they are."""
    flags = {
        "fraud_velocity": _velocity_flag(config),
        "fraud_amount_anomaly": _amount_flag(config),
        "fraud_geo_impossibility": F.col("_geo_hit"),
    }
    reasons = [F.when(flag, F.lit(REASONS[name])) for name, flag in flags.items()]
    return (
        _with_history(df, config)
        .select(*df.columns, F.concat_ws("|", *reasons).alias("fraud_reasons"))
        .withColumn("is_fraud_flagged", F.col("fraud_reasons") != "")
    )


def _velocity_flag(config: FraudConfig) -> Column:
    return F.col("velocity_count") > config.velocity_max_txns


def _prior_mean() -> Column:
    return F.try_divide(F.col("_prior_total").cast("double"), F.col("_prior_amounts").cast("double"))


def _amount_flag(config: FraudConfig) -> Column:
    above = F.col("amount").cast("double") > _prior_mean() * F.lit(config.amount_multiplier)
    enough = F.col("_prior_rows") >= config.amount_min_samples
    return F.coalesce(enough & above, F.lit(False))


def _with_history(df: DataFrame, config: FraudConfig) -> DataFrame:
    """Add the ``_HISTORY`` columns; what a caller does not use is pruned from the plan."""
    timed = df.withColumns({"_second": epoch_second(), "_route": F.xxhash64("card_hash")})
    busy = busy_cards(df, config.busy_card_rows)
    listed = F.broadcast(busy.select("_route"))
    ordinary = timed.join(listed, "_route", "left_anti").drop("_route")
    gathered = timed.join(listed, "_route", "left_semi").drop("_route")
    rows = busy.agg(F.sum("count")).scalar()
    return _ordinary(ordinary, config).unionByName(_busy(gathered, config, rows))


def busy_cards(df: DataFrame, limit: int) -> DataFrame:
    """(_route, count): hashes of the cards with more than ``limit`` rows.

    A card must also hold more than one in ``_MOST_BUSY`` of all rows, so there are fewer than that many.
    """
    counts = df.groupBy(F.xxhash64("card_hash").alias("_route")).count()
    share = counts.agg(F.sum("count")).scalar() / F.lit(_MOST_BUSY)
    return counts.where((F.col("count") > limit) & (F.col("count") > share))


def _changes(second: Column, first: Column, last: Column, located: Column, order: WindowSpec) -> Column:
    """The nearest time, up to the present row, at which another value than the present one occurred.

    A row stands for one transaction or for one second of them; its values lie between ``first`` and
    ``last``. Looking back from a row, the first row that differs is the one before its run of equal
    values, so it is enough to note the previous time wherever a run begins, or the present time if
    the row itself holds two values. Frames only ever grow, which keeps the pass linear.
    """
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    until_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def previous(value: Column) -> Column:
        return F.last(F.when(located, value), ignorenulls=True).over(earlier)

    begins = (previous(first) != first) | (previous(last) != last)
    noted = F.when(first != last, second).when(begins, previous(second))
    return F.last(F.when(located, noted), ignorenulls=True).over(until_now)


def _conflict(second: Column, other_country: Column, other_id: Column, seconds: int) -> Column:
    """Whether the look-back from a row holds a pair with both another country and another id.

    Two different countries and two different ids in it are enough: if no pair differed in both,
    a third transaction would have to share its country with two different ones.
    """
    near = (second - other_country <= seconds) & (second - other_id <= seconds)
    return F.coalesce(near, F.lit(False))


def _count_back(rows: Column, second: Column, by_second: WindowSpec, seconds: int) -> Column:
    """Sum of ``rows`` over the last seconds: what has happened less what is too old to count.

    Both frames start at the beginning, so Spark extends them instead of recomputing a sliding one.
    """
    so_far = F.sum(rows).over(by_second.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    too_old = F.sum(rows).over(by_second.rangeBetween(Window.unboundedPreceding, -seconds - 1))
    return so_far - F.when(second.isNotNull(), F.coalesce(too_old, F.lit(0))).otherwise(0)


def _ordinary(df: DataFrame, config: FraudConfig) -> DataFrame:
    # The time order refines the order by second, so one sort serves every frame.
    card = Window.partitionBy("card_hash")
    in_order = card.orderBy("_second", "timestamp", "transaction_id")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    second, country, number = F.col("_second"), F.col("country_code"), F.col("transaction_id")
    located = country.isNotNull() & number.isNotNull()
    return (
        df.withColumns(
            {
                "_prior_rows": F.count(F.lit(1)).over(earlier),
                "_prior_amounts": F.count("amount").over(earlier),
                "_prior_total": F.sum("amount").over(earlier).cast("decimal(38,2)"),
                "_other_country": _changes(second, country, country, located, in_order),
                "_other_id": _changes(second, number, number, located, in_order),
            }
        )
        .withColumns(
            {
                "velocity_count": _count_back(
                    F.lit(1), second, card.orderBy("_second"), config.velocity_window_seconds
                ),
                "_conflict": _conflict(
                    second, F.col("_other_country"), F.col("_other_id"), config.geo_window_seconds
                ),
            }
        )
        .withColumn("_geo_hit", F.max("_conflict").over(card) & F.col("card_hash").isNotNull())
        .drop("_conflict", "_other_country", "_other_id", "_second")
    )


def _cuts(moments: DataFrame, rows: Column) -> DataFrame:
    """(_moment, _cuts): places within the busy seconds, in order.

    About ``_CUTS`` of all ``rows`` are drawn by their hash, so a second gets as many places as it has
    rows to cut; one with fewer than two stays whole.
    """
    part = F.xxhash64("_moment", "_place").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    drawn = moments.select("_moment", "_place").where(part * rows < _CUTS)
    return drawn.groupBy("_moment").agg(F.sort_array(F.collect_set("_place")).alias("_cuts")).where(F.size("_cuts") > 1)


def _up_to(places: str) -> Column:
    """How many of the ``places`` lie up to a row's own."""
    return F.size(F.filter(places, lambda cut: cut <= F.col("_place")))


def in_pieces(df: DataFrame, rows: Column) -> DataFrame:
    """Rows of busy cards with their ``_moment`` (card and second) and the ``_piece`` of it they lie in.

    A row looks its place up among every ``_CUT_RUN``-th cut of its second, and then in the run that begins
    there. The runs are joined apart, so a row carries two short lists and never all cuts of its second.
    """
    # Keys are structs so that an absent card or time is a key of its own, as in a window.
    moments = df.withColumns(
        {"_moment": F.struct("card_hash", "_second"), "_place": F.struct("timestamp", "transaction_id")}
    )
    cuts = _cuts(moments, rows)
    tops = cuts.select("_moment", F.filter("_cuts", lambda _, i: i % _CUT_RUN == 0).alias("_tops"))
    starts = F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / _CUT_RUN).cast("int"))
    runs = cuts.select(
        "_moment",
        F.posexplode(F.transform(starts, lambda i: F.slice("_cuts", i * _CUT_RUN + 1, F.lit(_CUT_RUN)))).alias("_run", "_inside"),
    )
    topped = moments.join(F.broadcast(tops), "_moment", "left")
    begun = topped.withColumn("_run", F.when(F.col("_tops").isNotNull(), _up_to("_tops") - 1)).drop("_tops")
    placed = begun.join(F.broadcast(runs), ["_moment", "_run"], "left")
    piece = F.when(F.col("_inside").isNull(), 0).otherwise(F.col("_run") * _CUT_RUN + _up_to("_inside"))
    return placed.withColumn("_piece", piece.cast("int")).drop("_run", "_inside", "_place")


def _busy(df: DataFrame, config: FraudConfig, rows: Column) -> DataFrame:
    moments = in_pieces(df, rows)
    # Two transactions are told apart by their ids: one without an id, or a country, is no partner.
    located = F.col("country_code").isNotNull() & F.col("transaction_id").isNotNull()
    located_id = F.when(located, F.col("transaction_id"))
    located_country = F.when(located, F.col("country_code"))
    before = Window.partitionBy("_moment").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    measures = ("_rows", "_amounts", "_total")
    pieces = (
        moments.groupBy("_moment", "_piece")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("amount").alias("_amounts"),
            F.sum("amount").alias("_total"),
            F.min(located_country).alias("_first_country"),
            F.max(located_country).alias("_last_country"),
            F.min(located_id).alias("_first_id"),
            F.max(located_id).alias("_last_id"),
        )
        .withColumns({f"_piece{m}": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures})
    )
    # A second has as many pieces as cuts, so the list that its row takes along is bounded by those.
    seconds = pieces.groupBy("_moment").agg(
        *[F.sum(m).alias(m) for m in measures],
        *[F.min(c).alias(c) for c in ("_first_country", "_first_id")],
        *[F.max(c).alias(c) for c in ("_last_country", "_last_id")],
        F.collect_list(F.struct("_piece", *[f"_piece{m}" for m in measures])).alias("_pieces"),
    )
    history = _carry_forward(_look_back(seconds, config)).select("*", F.inline("_pieces"))

    same_piece = Window.partitionBy("_moment", "_piece").orderBy("timestamp", "transaction_id")
    earlier = same_piece.rowsBetween(Window.unboundedPreceding, -1)
    own_total = F.coalesce(F.sum("amount").over(earlier), F.lit(0))
    total = F.col("_before_total") + F.col("_piece_total") + own_total
    return (
        moments.join(history, ["_moment", "_piece"])
        .withColumns(
            {
                "_prior_rows": F.col("_before_rows") + F.col("_piece_rows") + F.count(F.lit(1)).over(earlier),
                "_prior_amounts": F.col("_before_amounts") + F.col("_piece_amounts") + F.count("amount").over(earlier),
                "_prior_total": total.cast("decimal(38,2)"),
            }
        )
        .select(*[c for c in df.columns if c != "_second"], *_HISTORY)
    )


def _look_back(seconds: DataFrame, config: FraudConfig) -> DataFrame:
    """Frames over the seconds of a card, slice by slice.

    A slice is at least as long as either look-back, so a second is needed in its own slice and at
    most in the next. A group holds no more rows than two slices have seconds.
    """
    reach = max(config.velocity_window_seconds, config.geo_window_seconds)
    length = max(_SLICE_SECONDS, reach)
    second = F.col("_moment._second")
    home = F.floor(second / length)
    needed_in = F.array_distinct(F.array(home, F.floor((second + reach) / length)))
    copies = seconds.select(
        "*", F.explode(needed_in).alias("_number"), home.alias("_home"), second.alias("_second")
    ).select(
        "*",
        F.struct(F.col("_moment.card_hash").alias("card_hash"), "_number").alias("_slice"),
        F.col("_number").eqNullSafe(F.col("_home")).alias("_own"),
    )

    in_order = Window.partitionBy("_slice").orderBy("_second")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    at, located = F.col("_second"), F.col("_first_country").isNotNull()

    def before(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_own"), F.col(column))).over(earlier), F.lit(0))

    other_country = _changes(at, F.col("_first_country"), F.col("_last_country"), located, in_order)
    other_id = _changes(at, F.col("_first_id"), F.col("_last_id"), located, in_order)
    return copies.select(
        "_moment",
        "_slice",
        "_own",
        "_rows",
        "_amounts",
        "_total",
        _count_back(F.col("_rows"), at, in_order, config.velocity_window_seconds).alias("velocity_count"),
        _conflict(at, other_country, other_id, config.geo_window_seconds).alias("_conflict"),
        before("_rows").alias("_slice_rows"),
        before("_amounts").alias("_slice_amounts"),
        before("_total").alias("_slice_total"),
        F.when(F.col("_own"), F.col("_pieces")).alias("_pieces"),
    ).where("_own")


def _carry_forward(seconds: DataFrame) -> DataFrame:
    """Add the totals of the card's earlier slices, and whether any slice had a conflict."""
    card = Window.partitionBy("_slice.card_hash")
    earlier = card.orderBy("_slice._number").rowsBetween(Window.unboundedPreceding, -1)

    def carried(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    slices = (
        seconds.groupBy("_slice")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_amounts").alias("_amounts"),
            F.sum("_total").alias("_total"),
            F.max("_conflict").alias("_conflict"),
        )
        .select(
            "_slice",
            carried("_rows").alias("_carried_rows"),
            carried("_amounts").alias("_carried_amounts"),
            carried("_total").alias("_carried_total"),
            (F.max("_conflict").over(card) & F.col("_slice.card_hash").isNotNull()).alias("_geo_hit"),
        )
    )
    # A conflict of the second itself is part of its card's; asking for it here as well makes both
    # sides of the join need the same columns, so they share one scan and one shuffle.
    return seconds.join(slices, "_slice").select(
        "_moment",
        "velocity_count",
        (F.col("_geo_hit") | (F.col("_conflict") & F.col("_moment.card_hash").isNotNull())).alias("_geo_hit"),
        (F.col("_carried_rows") + F.col("_slice_rows")).alias("_before_rows"),
        (F.col("_carried_amounts") + F.col("_slice_amounts")).alias("_before_amounts"),
        (F.col("_carried_total") + F.col("_slice_total")).alias("_before_total"),
        "_pieces",
    )
