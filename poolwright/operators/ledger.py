"""Balance history and run-off profile rebuilt from a movement ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions.exprs import day_from_number, day_number, effective_date, movement_effects
from poolwright.operators.lookups import convert_currency

EVOLUTION_COLUMNS = [
    *GRAIN, "signing_date", "expiry_date", "start_date", "var_total", "var_drawn", "runoff",
    "var_total_cum", "var_drawn_cum", "end_date", "runoff_cum",
]


def ledger_join(movements: DataFrame, balances: DataFrame) -> DataFrame:
    """Movements of the facilities that have a balance row."""
    return movements.join(balances, ["facility_id", "tranche_id", "entity_id", "branch_id"], "inner")


def balance_movements(movements: DataFrame) -> DataFrame:
    """Movements whose class changes an authorised or drawn balance."""
    return movements.filter(F.col("movement_class").isin(codes.BALANCE_CLASSES))


def signed_movements(movements: DataFrame, fx: DataFrame) -> DataFrame:
    """Movements in EUR with their signed effects, dated by start or end."""
    amounts = {"movement_amount": "amount_eur", "base_amount": "base_eur"}
    converted = convert_currency(movements, fx, amounts)
    return converted.withColumns({
        **movement_effects("movement_type", "base_eur", "amount_eur"),
        "start_date": effective_date("movement_type", "start_date", "end_date"),
    })


def _daily(signed: DataFrame, value_date: Column) -> DataFrame:
    """One row per facility and day: bounded by the calendar, whatever the ledger size.

    ``side`` is 0 up to the value date, 1 after it, 2 for undated movements;
    ``distance`` counts days away from the value date on either side.
    """
    day = F.col("start_date")
    side = F.when(day <= value_date, 0).when(day > value_date, 1).otherwise(2)
    summed = signed.groupBy(*GRAIN, "signing_date", "expiry_date", "start_date").agg(
        F.sum("var_total").alias("var_total"),
        F.sum("var_drawn").alias("var_drawn"),
        F.sum("runoff").alias("runoff"),
    )
    return summed.withColumns({
        "side": side,
        "distance": F.abs(F.datediff(day, value_date)),
    })


def balance_evolution(signed: DataFrame, value_date) -> DataFrame:
    """Rebuilt balance steps: up to the value date, one bridge row, and after it.

    Seen from the value date both sides are alike: totals run outwards, and the
    far end of a step is the next date outwards (or the signing / expiry date).
    So one window, with the sign flipped before the value date, serves both,
    and the bridge row is emitted beside the innermost row of each facility.
    Everything after the daily roll-up happens in one shuffle on the facility.
    """
    value_day = F.lit(value_date).cast("date")
    outwards = W.partitionBy(*GRAIN, "side").orderBy("distance")
    running = outwards.rangeBetween(W.unboundedPreceding, W.currentRow)
    facility = W.partitionBy(*GRAIN)
    contract_terms = W.partitionBy(*GRAIN, "signing_date", "expiry_date").orderBy("side", "distance")

    before = F.col("side") == 0
    # negate rather than multiply by -1: a decimal product would lose digits
    daily = _daily(signed, value_day).withColumns({
        c: F.when(before, -F.col(c)).otherwise(F.col(c)) for c in ("var_total", "var_drawn")
    })
    steps = daily.withColumns({
        "var_total_cum": F.sum("var_total").over(running),
        "var_drawn_cum": F.sum("var_drawn").over(running),
        "runoff_cum": F.when(before, F.lit(0)).otherwise(F.sum("runoff").over(running)),
        "next_out": F.lead("start_date").over(outwards),
        "last_before": F.max(F.when(before, F.col("start_date"))).over(facility),
        "first_after": F.min(F.when(F.col("side") == 1, F.col("start_date"))).over(facility),
        "emits_bridge": F.row_number().over(contract_terms) == 1,
    })
    day = F.col("start_date")
    types = dict(steps.dtypes)
    measures = ["var_total", "var_drawn", "runoff", "var_total_cum", "var_drawn_cum", "runoff_cum"]
    step = F.struct(
        F.when(before, F.coalesce("next_out", "signing_date")).otherwise(day).alias("start_date"),
        F.when(before, day).otherwise(F.coalesce("next_out", "expiry_date")).alias("end_date"),
        *[F.col(m) for m in measures],
        F.col("side").alias("part"),
    )
    bridge = F.struct(
        F.coalesce("last_before", "signing_date").alias("start_date"),
        F.coalesce("first_after", "expiry_date").alias("end_date"),
        *[F.lit(0).cast(types[m]).alias(m) for m in measures],
        F.lit(2).alias("part"),
    )
    rows = F.filter(
        F.array(F.when(F.col("side") != 2, step), F.when(F.col("emits_bridge"), bridge)),
        lambda row: row.isNotNull(),
    )
    out = steps.select(*GRAIN, "signing_date", "expiry_date", F.explode(rows).alias("row"))
    return out.select(*GRAIN, "signing_date", "expiry_date", "row.*")


PARTS = {"before": 0, "after": 1, "bridge": 2}


def evolution_part(evolution: DataFrame, part: str) -> DataFrame:
    return evolution.filter(F.col("part") == PARTS[part]).drop("part")


def runoff_profile(evolution: DataFrame, value_date, horizon: int = 11) -> DataFrame:
    """Total run-off after the value date, by calendar year, with its average date."""
    value_day = F.lit(value_date).cast("date")
    year_ahead = F.year("start_date") - F.year(value_day)
    yearly = [
        F.sum(F.when(year_ahead == n, F.col("runoff")).otherwise(F.lit(0))).alias(f"runoff_y{n}")
        for n in range(horizon)
    ]
    profile = (
        evolution.filter(F.col("start_date") > value_day)
        .groupBy(*GRAIN)
        .agg(
            F.sum("runoff").alias("runoff_total"),
            F.sum(F.col("runoff") * day_number(F.col("start_date"))).alias("runoff_day_sum"),
            *yearly,
        )
    )
    return profile.withColumn("avg_maturity", _mean_date())


def average_maturity(signed: DataFrame, balances: DataFrame, value_date) -> DataFrame:
    """Run-off after the value date and its average date, of the facilities that have a balance row.

    The same date as in ``runoff_profile``, which needs neither steps nor running totals: movements are summed by
    facility and entity in place, and only these sums meet the balances, so no ledger row is shuffled.
    """
    later = signed.filter(F.col("start_date") > F.lit(value_date).cast("date"))
    sums = later.groupBy(*GRAIN, "entity_id").agg(
        F.sum("runoff").alias("runoff"), F.sum(F.col("runoff") * day_number(F.col("start_date"))).alias("day_sum"))
    total = ledger_join(sums, balances.select(*GRAIN, "entity_id").distinct()).groupBy(*GRAIN).agg(
        F.sum("runoff").alias("runoff_total"), F.sum("day_sum").alias("runoff_day_sum"))
    return total.withColumn("avg_maturity", _mean_date())


def _mean_date() -> Column:
    mean_day = F.try_divide(F.col("runoff_day_sum").cast("double"), F.col("runoff_total").cast("double"))
    return F.when(F.col("runoff_total") > 0, day_from_number(mean_day))
