"""From a limit sheet and a facility table to a selected pool."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions import exprs as E
from poolwright.operators import allocation as A
from poolwright.operators import eligibility, limits, report
from poolwright.operators.dedupe import duplicate_keys
from poolwright.operators.limits import RuleBook
from poolwright.session import literal_rows, materialize
from poolwright.sinks.writers import publish
from poolwright.sources.snapshots import scan_latest


def portfolio_type_of(header: DataFrame) -> str:
    """The portfolio type of a one-list header."""
    return header.select("portfolio_type").first()[0]


def product_facilities(facilities: DataFrame, portfolio_type: str) -> DataFrame:
    return facilities.filter(F.col("com_product") == codes.PRODUCT_OF_PORTFOLIO[portfolio_type])


def prepare(facilities: DataFrame, sheet: DataFrame, relation: DataFrame) -> tuple[DataFrame, RuleBook]:
    """Facilities of the sheet's product with their base amount, and its rule book.

    ``sheet`` is one list, already reduced to its active rules. They are written once, as
    the header, the catalogue and the rule index are each read from them at once.
    """
    rules = materialize(limits.without_constants(sheet), "list")
    portfolio_type = portfolio_type_of(limits.portfolio_header(rules))
    book = limits.rule_book(limits.resolve_limits(rules, relation, portfolio_type))
    sellable = book.shares["risk_retention"]
    base = product_facilities(facilities, portfolio_type).withColumn(
        "base_amount", eligibility.base_amount(book.shares["ccf"], sellable))
    return base, book


def eligible(facilities: DataFrame, book: RuleBook) -> DataFrame:
    return eligibility.eligible_amount(eligibility.apply_row_limits(facilities, book), book)


def fill(facilities: DataFrame, book: RuleBook, kept: tuple[str, ...] | None = None) -> A.Filled:
    """The fill of the eligible amounts; its facilities keep all columns, or ``kept`` and what the fill reads."""
    amounts = eligible(facilities, book)
    if kept is not None:
        amounts = amounts.select(*dict.fromkeys([*A.fill_columns(book), *kept]))
    return A.fill_pool(amounts, book.pool_size, book=book)


@dataclass
class Selection:
    """The result tables of one run."""

    limits: DataFrame
    facilities: DataFrame
    excluded: DataFrame
    portfolio: DataFrame
    trace: DataFrame
    ledger: DataFrame
    constants: DataFrame | None = None


#: Tables of a run that are kept; ``read_current`` and ``read_history`` read them back.
OUTPUTS = ("limits", "facilities", "excluded", "portfolio", "ledger", "constants")


def write_selection(chosen: Selection, folder: str, closing_date: str) -> None:
    """Publish the kept tables of a run under its date, all of them or none; that date is replaced."""
    publish({name: getattr(chosen, name) for name in OUTPUTS if getattr(chosen, name) is not None}, folder, closing_date)


def select_pool(facilities: DataFrame, sheet: DataFrame, relation: DataFrame, constants: DataFrame | None = None) -> Selection:
    """One run over facilities with one row per facility, tranche and branch; ``constants`` go with the results."""
    base, book = prepare(facilities, sheet, relation)
    twice = duplicate_keys(base.select(*GRAIN), GRAIN).first()
    if twice is not None:
        raise ValueError(f"facility with more than one row: {tuple(twice)}")
    filled = fill(base, book)
    portfolio = A.allocation(filled)
    header = sheet.select("name_list_desc").first()
    return Selection(
        limits=book.resolved,
        facilities=base,
        excluded=portfolio.filter(F.col("excluded") == 1),
        portfolio=report.typed_portfolio(portfolio, portfolio_type_of(limits.portfolio_header(sheet))),
        trace=A.allocation_trace(filled),
        ledger=A.limit_ledger(filled, header[0]),
        constants=constants,
    )


def flag_facilities(cube: DataFrame, sector_catalogue: DataFrame | None = None, portfolio_type: str | None = None) -> DataFrame:
    """The eight feature marks on cube rows, with the project subsector joined in.

    With a portfolio type the marks read the wide table's own columns: its
    rating for that type, and the amount guaranteed by the agency.
    """
    df = cube
    if sector_catalogue is not None:
        # both sides are trimmed: the catalogue is maintained by hand
        names = sector_catalogue.select(
            F.trim("project_sector_desc").alias("project_sector_desc"), "project_subsector_desc").distinct()
        df = df.withColumn("project_sector_desc", F.trim("project_sector_desc"))
        df = df.join(names, "project_sector_desc", "left").fillna(codes.UNKNOWN_TEXT, ["project_subsector_desc"])
    if portfolio_type is None:
        return df.withColumns(E.feature_flags())
    letter, ordinal = codes.RATING_OF_PORTFOLIO[portfolio_type]
    return df.withColumns(E.feature_flags(ordinal, letter, "agency_guaranteed")).withColumn("rating_letter", F.col(letter))


def cube_facilities(cube: DataFrame, portfolio_type: str, sector_catalogue: DataFrame | None = None) -> DataFrame:
    """Wide-table rows as facilities for a selection: flagged, under the names that limit relations target."""
    flagged = flag_facilities(cube, sector_catalogue, portfolio_type)
    return flagged.select(
        *GRAIN, "group_id", F.col("customer_country").alias("country"), "currency", "financial_product", "com_product",
        F.col("sector_desc").alias("sector"), F.col("subsector_desc").alias("subsector"), "signing_date", "expiry_date",
        "reg_ead", "funded_eur", "available_eur", "reg_capital", F.col("sold_amount").cast(A.MONEY).alias("sold_amount"),
        "reg_capital_ratio", "rating_letter", "group_rating",
        *E.feature_flags().keys(), *(["project_subsector_desc"] if sector_catalogue is not None else []))


def cost_income(ratios: DataFrame, area: str = codes.COST_INCOME_AREA, office: str = codes.HOME_OFFICE) -> DataFrame:
    """One row, ``constant_value``: the ratio of the area's home office at the newest cutoff.

    ``ratios`` has the columns cutoff_date, area_id, office_desc, ratio; of several rows the least counts.
    """
    newest = scan_latest(ratios, "cutoff_date")
    home = newest.filter((F.col("area_id") == area) & (F.trim("office_desc") == office))
    return home.agg(F.min(F.col("ratio").cast("double")).alias("constant_value"))


def pool_constants(sheet: DataFrame, facilities: DataFrame, lgd_col: str, cost_income: DataFrame,
                   fixed: dict[str, float]) -> DataFrame:
    """Constants of the sheet, fixed rates, the average LGD and the cost-income ratio.

    ``facilities`` is the wide table: the average is taken over its rows.

    The averages stay one-row frames; nothing is collected to build the result.
    """
    spark = sheet.sparkSession
    of_sheet = sheet.filter(F.col("limit_type") == "constant_type").select(
        "name_list_desc", F.col("concept1_desc").alias("constant_type"), F.col("limit_value").alias("constant_value"))
    rates = literal_rows(spark, [("all", name, float(v)) for name, v in fixed.items()],
                         "name_list_desc string, constant_type string, constant_value double")
    lgd = facilities.agg(F.try_divide(F.sum(lgd_col).cast("double"), F.count(lgd_col).cast("double")).alias("constant_value"))

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit("all").alias("name_list_desc"), F.lit(name).alias("constant_type"), "constant_value")

    return (of_sheet.unionByName(rates).unionByName(named(lgd, "lgd"))
            .unionByName(named(cost_income, "ci_ratio")))
