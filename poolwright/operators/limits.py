"""Limit sheets: active rules, header values, rule resolution and share lookup."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.functions import codes
from poolwright.functions.exprs import least_of, lookup
from poolwright.operators.dedupe import keep_first
from poolwright.operators.lookups import lookup_many
from poolwright.session import materialize

ANY = "total"
SEP = "\x1f"
#: Forms of a rule's key: the value of a single column, both columns, one of them.
VALUE, BOTH, FIRST, SECOND, NONE = "value", "both", "first", "second", "none"
SCOPES = {"individual": "row", "portfolio": "pool"}
DATE_LIMITS = ("maturity_min", "maturity_max")
SHARE_UNITS = 10_000_000  # shares are kept to 7 decimals
# limits whose target column differs from what the relation names
FIXED_TARGETS = {"bei": "bei_flag", "maturity_min": "expiry_date", "maturity_max": "expiry_date"}


def active_limits(sheet: DataFrame, list_cols: tuple[str, ...] = ("name_list_desc",)) -> DataFrame:
    """Active rules, newest per rule key, without STS-only rules when STS is off.

    Works on one sheet or on many lists at once: the STS switch is read per list.
    """
    lists = list(list_cols)
    active = sheet.filter(F.col("active_flag") == 1)
    others = [c for c in sheet.columns if c not in (*lists, *codes.LIMIT_KEY, "limit_date")]
    newest = keep_first(active, [*lists, *codes.LIMIT_KEY],
                        [F.desc_nulls_last("limit_date"), *[F.asc_nulls_last(c) for c in others]])
    switched_off = (
        newest.filter(F.col("limit_type") == "sts")
        .groupBy(*lists).agg(F.max(F.struct("concept1_value", "concept1_desc")).alias("switch"))
        .filter(~F.col("switch.concept1_value").eqNullSafe("1"))
        .select(*lists, F.col("switch.concept1_desc").alias("concept1_desc"), F.lit("1").alias("concept1_value"))
    )
    return newest.join(switched_off, [*lists, "concept1_desc", "concept1_value"], "left_anti").select(*sheet.columns)


def without_constants(limits: DataFrame) -> DataFrame:
    return limits.filter(F.col("limit_type") != "constant_type")


def portfolio_header(limits: DataFrame) -> DataFrame:
    """Portfolio type, newest date and pool size of every list."""

    def of(limit_type: str, column: str) -> Column:
        return F.max(F.when(F.col("limit_type") == limit_type, F.col(column)))

    corporate = of("portfolio_type", "corporate_loan_flag").cast("string") == "1"
    return limits.groupBy("name_list_desc").agg(
        F.when(corporate, "corporate_loan").otherwise("project_finance").alias("portfolio_type"),
        F.max("limit_date").alias("limit_date"),
        of("portfolio_size", "limit_value").alias("pool_size"),
    )


def resolve_limits(limits: DataFrame, relation: DataFrame, portfolio_type: str) -> DataFrame:
    """Rules with their target column, scope, cap basis and share for NULL values.

    ``relation`` has one row per limit type. The risk retention is turned into
    the share that may be sold.
    """
    target = F.col("corporate_loan_column" if portfolio_type == "corporate_loan" else "project_finance_column")
    columns = relation.select(
        "limit_type", target.alias("target_column"), "header_flag",
        F.col("imp_limit").alias("cap_basis"), F.col("null_values").alias("null_share"))
    scope = F.coalesce(lookup(SCOPES, F.col("limit_scope")), F.col("limit_scope"))
    basis = F.when(F.col("cap_basis") == "limit_scope", F.col("limit_scope")).otherwise(F.col("cap_basis"))
    value = F.col("limit_value").cast("double")
    return limits.distinct().join(columns, "limit_type", "left").withColumns({
        "limit_value": F.when(F.col("limit_type") == "risk_retention", 1 - value).otherwise(value),
        "cap_basis": F.coalesce(lookup(SCOPES, basis), basis),
        "limit_scope": scope,
        "target_column": F.coalesce(lookup(FIXED_TARGETS, F.col("limit_type")), F.col("target_column")),
    })


@dataclass
class LimitSpec:
    """What the driver needs to know about one limit type."""

    name: str
    columns: list[str]
    scope: str
    basis: str
    null_share: float
    order: int
    rules: int
    complex: bool
    # share of the rule for all values, if there is one
    total: float | None = None
    # different rule keys: by the value that a single column is compared with, and by both concepts
    values: int = 0
    keys: int = 0
    # which sides the rules of two columns name: "both", "first", "second" or "none"
    forms: frozenset[str] = frozenset()
    # day counts of a date limit with the share beyond each
    days: list[tuple[int, float]] = field(default_factory=list)

    @property
    def lone(self) -> bool:
        """A single rule that applies to everything, or of two columns to one side only."""
        if len(self.columns) == 1:
            return self.values == 1 and self.total is not None
        return self.keys == 1 and "both" not in self.forms


@dataclass
class RuleBook:
    """Resolved rules plus their small catalogue (one entry per limit type)."""

    resolved: DataFrame
    # one share (``value``) per limit type, form and key (``id``), of all rules; and its rows
    index: DataFrame
    index_rows: int
    specs: list[LimitSpec]
    pool_size: Decimal
    limit_date: object
    shares: dict[str, float]

    def row_limits(self) -> list[LimitSpec]:
        return [s for s in self.specs if s.scope == "row"]

    def pool_limits(self) -> list[LimitSpec]:
        return [s for s in self.specs if s.scope == "pool"]


def rule_book(resolved: DataFrame) -> RuleBook:
    """Catalogue of one list: header values and the limit types to apply.

    One row per limit type reaches the driver, date limits with their day
    counts. The rules stay in the cluster, whatever their number: they become one index of
    all limit types and forms of keys, repeated ones reduced to the strictest share, which is written once and counted.
    """
    c1, c2 = F.col("concept1_value"), F.col("concept2_value")
    value = F.when(F.col("complex_limit") == 1, c2).otherwise(c1)
    any1, any2 = F.coalesce(c1 == ANY, F.lit(False)), F.coalesce(c2 == ANY, F.lit(False))
    form = F.when(any1 & any2, NONE).when(any1, SECOND).when(any2, FIRST).otherwise(BOTH)
    day = F.when(F.col("limit_type").isin(*DATE_LIMITS), F.struct(
        c1.cast("double").cast("int").alias("days"), F.col("limit_value").alias("share")))
    catalogue = (
        resolved.groupBy("limit_type")
        .agg(
            F.min("target_column").alias("target"), F.min("limit_scope").alias("scope"),
            F.min("cap_basis").alias("basis"), F.min("header_flag").alias("header"),
            F.min("null_share").alias("null_share"), F.min("visual_order").alias("place"),
            F.max("complex_limit").alias("complex"), F.count(F.lit(1)).alias("rules"),
            F.min("limit_value").alias("value"), F.max("limit_date").alias("limit_date"),
            F.min(F.when(value == ANY, F.col("limit_value"))).alias("total"),
            F.countDistinct(value).alias("values"), F.countDistinct(F.struct(c1, c2)).alias("keys"),
            F.collect_set(form).alias("forms"), F.collect_set(day).alias("days"),
        )
        .collect()
    )
    keys = F.array(
        rule_id(F.col("limit_type"), VALUE, value),
        F.when(form == BOTH, rule_id(F.col("limit_type"), BOTH, c1, c2)).when(form == FIRST, rule_id(F.col("limit_type"), FIRST, c1))
        .when(form == SECOND, rule_id(F.col("limit_type"), SECOND, c2)))
    index = resolved.filter(~F.col("limit_type").isin(*DATE_LIMITS)).select(F.explode(keys).alias("id"), "limit_value").filter("id is not null")
    index = materialize(index.groupBy("id").agg(F.min("limit_value").alias("value")), "rules")
    specs = [
        LimitSpec(r.limit_type, r.target.split("/"), r.scope, r.basis, float(r.null_share or 0),
                  r.place if r.place is not None else 10_000, r.rules, bool(r.complex), r.total, r["values"], r["keys"],
                  frozenset(r.forms), _strictest_days(r.limit_type, [(d.days, d.share) for d in r.days if d.days is not None]))
        for r in catalogue
        if not r.header and r.target is not None and r.limit_type != "sts"
    ]
    specs.sort(key=lambda s: (s.order, s.name))
    values = {r.limit_type: r.value for r in catalogue}
    return RuleBook(
        resolved, index, index.count(), specs, Decimal(str(values["portfolio_size"])).quantize(Decimal("0.0001")),
        max(r.limit_date for r in catalogue if r.limit_date is not None),
        {name: values[name] for name in ("ccf", "risk_retention") if name in values},
    )


def rule_id(limit_type: Column | str, form: str, *values: Column) -> Column:
    """Key of the rule index; NULL where a value is."""
    kind = F.lit(limit_type) if isinstance(limit_type, str) else limit_type
    parts = [p for v in values for p in (F.lit(SEP), v.cast("string"))]
    return F.concat(kind, F.lit(SEP + form), *parts)


def date_bound(limit_date, days: int) -> Column:
    return F.date_add(F.lit(limit_date).cast("date"), F.lit(days))


def _strictest_days(name: str, days: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """Day counts that matter, those broken most easily first; a bound broken later counts only if it is stricter."""
    out: list[tuple[int, float]] = []
    for count, share in sorted(days, key=lambda d: (-d[0] if name == "maturity_min" else d[0], d[1])):
        if not out or share < out[-1][1]:
            out.append((count, share))
    return out


def date_share(spec: LimitSpec, limit_date) -> Column:
    """The least share of all rules whose bound the date breaks, 1 where it breaks none."""
    day = F.col(spec.columns[0])

    def broken(days: int) -> Column:
        bound = date_bound(limit_date, days)
        return day < bound if spec.name == "maturity_min" else day > bound

    shares = [F.when(broken(days), F.lit(share)).otherwise(F.lit(1.0)) for days, share in spec.days]
    return F.when(day.isNull(), F.lit(spec.null_share)).otherwise(least_of(shares, F.lit(1.0)))


def _column(name: str, form: str) -> str:
    return f"_{name}_{form}"


def index_keys(spec: LimitSpec) -> dict[str, Column]:
    """Lookups in the rule index that a limit needs, by the column they fill."""
    if spec.name in DATE_LIMITS or (len(spec.columns) == 1 and spec.lone):
        return {}
    values = [F.col(c) for c in spec.columns]
    if len(values) == 1:
        wanted = {VALUE: values}
    else:
        wanted = {form: part for form, part in ((BOTH, values), (FIRST, values[:1]), (SECOND, values[1:])) if form in spec.forms}
    return {_column(spec.name, form): rule_id(spec.name, form, *part) for form, part in wanted.items()}


def with_shares(df: DataFrame, book: RuleBook, specs: list[LimitSpec]) -> DataFrame:
    """All lookups of all limits at once; ``matched_share`` reads the added columns."""
    keys = {name: key for spec in specs for name, key in index_keys(spec).items()}
    return lookup_many(df, book.index, book.index_rows, keys)


def matched_share(book: RuleBook, spec: LimitSpec) -> Column:
    """The share of the rule that matches a row of ``with_shares``, NULL where none does.

    One target column: the rule of its value; a lone ``total`` rule is a
    constant. Two columns: both values, with ``total`` as a wildcard on either
    side; the strictest match counts.
    """
    if spec.name in DATE_LIMITS:
        return date_share(spec, book.limit_date)
    if len(spec.columns) == 1 and spec.lone:
        return F.lit(spec.total)
    matches = [F.col(name) for name in index_keys(spec)]
    if len(spec.columns) > 1 and NONE in spec.forms:
        matches.append(F.lit(spec.total))
    return least_of(matches, F.lit(None).cast("double"))
