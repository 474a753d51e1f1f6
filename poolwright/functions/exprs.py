"""Column functions: everything stays a built-in Spark expression."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.functions import codes


def lookup(mapping: dict, key: Column) -> Column:
    """Value of ``key`` in a small literal map, NULL when the key is unknown."""
    pairs = chain.from_iterable(mapping.items())
    return F.create_map(*[F.lit(item) for item in pairs])[key]


def rating_ordinal(letter: Column) -> Column:
    return lookup(codes.rating_ordinals(), F.trim(letter))


def investment_grade(ordinal: Column) -> Column:
    return F.when(ordinal <= codes.LAST_INVESTMENT_ORDINAL, 1).otherwise(0)


def entity_currency(entity: Column) -> Column:
    return lookup(codes.ENTITY_CURRENCY, entity)


def clean_sentinels(df: DataFrame, amounts: list[str] = (), percents: list[str] = ()) -> DataFrame:
    """Replace the "missing" placeholders of the listed columns by 0."""
    types = dict(df.dtypes)
    cleaned = {}
    for names, placeholder in ((amounts, codes.MISSING_AMOUNT), (percents, codes.MISSING_PERCENT)):
        for name in names:
            marker = F.lit(placeholder).cast(types[name])
            cleaned[name] = F.when(F.col(name) == marker, F.lit(0).cast(types[name])).otherwise(F.col(name))
    return df.withColumns(cleaned)


def movement_effects(kind: str, base_eur: str, amount_eur: str) -> dict[str, Column]:
    """Signed effect of a movement on the total, the drawn amount and the run-off."""
    zero = F.lit(0).cast("decimal(1,0)")
    movement, base = F.col(kind), F.col(base_eur)
    reduces_total = movement.isin(codes.TOTAL_REDUCTIONS)
    return {
        "var_total": F.when(reduces_total, -base)
        .when(movement == codes.TOTAL_INCREASE, base)
        .otherwise(zero),
        "var_drawn": F.when(movement.isin(codes.DRAWN_INCREASES), base)
        .when(movement.isin(codes.DRAWN_REDUCTIONS), -base)
        .otherwise(zero),
        "runoff": F.when(reduces_total, F.col(amount_eur)).otherwise(zero),
    }


def effective_date(kind: str, start: str, end: str) -> Column:
    return F.when(F.col(kind).isin(codes.DATED_BY_END), F.col(end)).otherwise(F.col(start))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL instead of an error when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def least_of(columns: list[Column], empty: Column) -> Column:
    """Row-wise minimum of any number of columns (``F.least`` needs two)."""
    if not columns:
        return empty
    return columns[0] if len(columns) == 1 else F.least(*columns)


def parse_locale_decimal(text: Column) -> Column:
    """``1.234,5`` style text -> double, NULL when it is not a number."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"\.", ""), ",", ".")
    return plain.try_cast("double")


def parse_flexible_date(text: Column) -> Column:
    """Date from text with exactly three digit runs, year first or day first."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"))
    first, middle, last = (F.get(runs, i) for i in range(3))
    ordered = F.when(F.length(first) == 4, F.concat_ws("-", first, middle, last)).otherwise(
        F.concat_ws("-", last, middle, first)
    )
    return F.when(F.size(runs) == 3, ordered.try_cast("date"))


def day_number(day: Column) -> Column:
    """Days since the start of year 1, counted from 1."""
    return F.datediff(day, F.lit("0001-01-01").cast("date")) + 1


def day_from_number(number: Column) -> Column:
    return F.date_add(F.lit("0001-01-01").cast("date"), F.floor(number).cast("int") - 1)


def average_term(avg_maturity: Column, signing: Column) -> Column:
    """Years from signing to the average maturity, 0 when either is unknown."""
    return F.coalesce(F.datediff(avg_maturity, signing) / F.lit(365.0), F.lit(0.0))


def grain_key(*columns: str) -> Column:
    return F.concat_ws("_", *[F.col(c) for c in columns])


def contract_parts(contract: Column) -> dict[str, Column]:
    """Entity and contract tail packed in a global contract id."""
    return {
        "entity_id": F.substring(contract, 1, 2),
        "contract_tail": F.substring(contract, 11, 26),
    }


def customer_parts(customer: Column) -> dict[str, Column]:
    return {
        "customer_country": F.substring(customer, 1, 2),
        "customer_entity": F.substring(customer, 3, 4),
        "local_customer_id": F.substring(customer, 7, 9),
    }


def non_investment_flag(ordinal: Column, letter: Column) -> Column:
    """1 from the first speculative grade down, never for the BBB family."""
    threshold = codes.rating_ordinals()[codes.FIRST_SPECULATIVE_GRADE]
    return F.when((ordinal >= threshold) & ~letter.startswith("BBB"), 1).otherwise(0)


def feature_flags(ordinal: str = "rating_ordinal", letter: str = "rating_letter", agency_amount: str = "bei_guaranteed") -> dict[str, Column]:
    """The eight 0/1 marks the limit rules refer to; the rating and the agency's amount are read from the named columns."""

    def mark(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return {
        "ico_flag": mark(F.trim("purpose") == codes.PUBLIC_AGENCY_PURPOSE),
        "non_ig_flag": non_investment_flag(F.col(ordinal), F.col(letter)),
        "building_project_flag": mark(F.trim("construction_type") == "S"),
        "workout_flag": mark(F.trim("watch_list").try_cast("int") != 0),
        "sts_payment_flag": mark(F.col("sts_payment_condition").cast("string") == "true"),
        "sts_rw_flag": mark(F.col("sts_rw_condition").cast("string") == "true"),
        "esg_linked_flag": mark(F.col("esg_linked") == 1),
        "bei_flag": mark(F.coalesce(F.col(agency_amount), F.lit(0)) != 0),
    }


def risk_ratios() -> dict[str, Column]:
    """Totals and capital / loss ratios of one facility."""
    reg_capital = ratio(F.col("reg_capital"), F.col("reg_ead"))
    return {
        "exchange_rate": ratio(F.col("nominal_ccy"), F.col("nominal_eur")),
        "total_ccy": F.col("funded_ccy") + F.col("available_ccy"),
        "total_eur": F.col("funded_eur") + F.col("available_eur"),
        "econ_capital_ratio": ratio(F.col("econ_capital"), F.col("econ_ead")),
        "reg_capital_ratio": reg_capital,
        "risk_weight": F.lit(12.5) * reg_capital,
        "econ_loss_ratio": ratio(F.col("econ_loss"), F.col("econ_ead")),
        "reg_loss_ratio": ratio(F.col("reg_loss"), F.col("reg_ead")),
    }


def within_full_weight(risk_weight: Column) -> Column:
    """True up to a 100 % risk weight; unknown weights pass."""
    return F.coalesce(100 * risk_weight <= 100, F.lit(True))


def row_hash(columns: list[str]) -> Column:
    return F.sha2(F.concat_ws("||", *[F.col(c) for c in columns]), 256)


def threshold_flag(column: Column, barrier) -> Column:
    return F.when(column <= barrier, 0).otherwise(1)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def typed_fill(df: DataFrame, number: float = 0, text: str = codes.UNKNOWN_TEXT,
               overrides: dict | None = None) -> DataFrame:
    """Fill NULLs by column type; ``overrides`` names the value of single columns."""
    overrides = overrides or {}
    fills: dict = dict(overrides)
    for name, kind in df.dtypes:
        if name in fills:
            continue
        if kind == "string":
            fills[name] = text
        elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
            fills[name] = number
    return df.fillna(fills)
