"""Renames, currency conversion and dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.functions import codes

#: Rows of an index that may be broadcast, at about a hundred bytes each.
INDEX_ROWS = 200_000


def rename_known(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the mapped columns that exist; the others pass through."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def convert_currency(df: DataFrame, fx: DataFrame, amounts: dict[str, str],
                     currency_col: str = "currency", keep_original: bool = False) -> DataFrame:
    """``amount * fx`` for each ``source -> target``; a missing rate counts as 1.

    ``fx`` (columns ``currency``, ``fx``) has one row per currency; read from a
    table or made by ``literal_rows`` its size is known and Spark broadcasts it.
    """
    rates = fx.select(F.col("currency").alias(currency_col), F.col("fx"))
    joined = df.join(rates, currency_col, "left").withColumn(
        "fx", F.coalesce(F.col("fx"), F.lit(1).cast(dict(fx.dtypes)["fx"])))
    passed = [c for c in df.columns if keep_original or c not in amounts]
    converted = [(F.col(source) * F.col("fx")).alias(target) for source, target in amounts.items()
                 if not (keep_original and source == target)]
    return joined.select(*passed, *converted, "fx")


def lookup_many(df: DataFrame, index: DataFrame, rows: int, keys: dict[str, Column]) -> DataFrame:
    """Several values of one index (``id``, ``value``; one row an id), a column for each of ``keys``; NULL where nothing is found.

    ``rows`` is the counted size of the index. A small one is broadcast once, for all lookups together,
    and ``df`` stays in place. A larger one is joined once: the keys of all lookups are unpivoted, joined,
    and pivoted back by the list of keys, so the shuffles do not follow the number of lookups.
    """
    if not keys:
        return df
    if rows <= INDEX_ROWS:
        # the joins must not become one method with what made the rows
        keys = {name: unfused(key) if i == 0 else key for i, (name, key) in enumerate(keys.items())}
        df = df.withColumns({f"_key_{name}": key for name, key in keys.items()})
        for name in keys:
            side = index.select(F.col("id").alias(f"_id_{name}"), F.col("value").alias(name))
            df = df.join(F.broadcast(side), F.col(f"_key_{name}") == F.col(f"_id_{name}"), "left").drop(f"_id_{name}", f"_key_{name}")
        return df
    keyed = df.withColumn("_keys", F.array(*keys.values()))
    each = keyed.select("_keys", F.posexplode("_keys").alias("_place", "id")).filter("id is not null")
    found = each.join(index.select("id", "value"), "id").groupBy("_keys").agg(
        *[F.max(F.when(F.col("_place") == i, F.col("value"))).alias(name) for i, name in enumerate(keys)])
    return keyed.join(found, "_keys", "left").drop("_keys")


def unfused(value: Column) -> Column:
    """``value``, by an expression that Spark does not fuse: the projection that holds it ends a generated method.

    Spark makes one method of all steps between two shuffles, and the JVM interprets methods of more than 8000
    bytes for good, at a fraction of the speed of compiled ones.
    """
    return F.element_at(F.transform(F.array(value), lambda x: x), 1)


def digested(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``_digest``, a hash of the keys, to be joined on ahead of them.

    Long ids share their first bytes, which is what a sort compares first; by the hash a merge join
    tells rows apart without reading the ids.
    """
    return df.withColumn("_digest", F.xxhash64(*keys))


def range_band(df: DataFrame, bands: DataFrame, value: Column, columns: list[str]) -> DataFrame:
    """Left join into half-open bands ``[band_from, band_to)``, which may overlap.

    The edges of all bands cut the axis into elementary intervals. A value finds its interval by search
    in the sorted edges, and rows and bands meet in an equality join on the interval's number, which Spark may broadcast or
    shuffle; the bands of an interval hold all its values, so nothing is compared twice. Bands of
    any widths, growing ones too, get as many intervals as they have edges. ``bands`` is a scale: its sorted
    edges, 16 bytes a band, travel as one row.
    """
    edges = bands.select("band_from", "band_to", *columns).filter("band_from < band_to")
    cuts = edges.select(F.explode(F.array(F.col("band_from").cast("double"), F.col("band_to").cast("double"))).alias("cut")).agg(F.sort_array(F.collect_set("cut")).alias("_cuts"))
    placed = edges.join(F.broadcast(cuts)).select(
        "*", F.explode(F.sequence(interval_of(F.col("_cuts"), F.col("band_from")), interval_of(F.col("_cuts"), F.col("band_to")) - 1)).alias("_interval"))
    keyed = df.join(F.broadcast(cuts)).withColumn("_at", interval_of(F.col("_cuts"), value)).drop("_cuts")
    return keyed.join(placed.select(*columns, F.col("_interval").alias("_at")), "_at", "left").drop("_at")


def interval_of(cuts: Column, value: Column) -> Column:
    """Number of the sorted cuts that are not above the value (0 below all, NULL for NULL), by halving."""
    steps = F.sequence(F.ceil(F.log2(F.size(cuts) + 1)).cast("int"), F.lit(0), F.lit(-1))
    x = value.cast("double")

    def halve(at: Column, step: Column) -> Column:
        tried = at + F.call_function("shiftleft", F.lit(1), step)
        return F.when(F.coalesce(F.get(cuts, tried - 1) <= x, F.lit(False)), tried).otherwise(at)

    return F.when(x.isNotNull(), F.aggregate(steps, F.lit(0), halve))


def role_lookup(df: DataFrame, dimension: DataFrame, key: str, value: str,
                roles: dict[str, str]) -> DataFrame:
    """Join one dimension several times: ``roles`` maps a code column to its text column."""
    for code_col, text_col in roles.items():
        role = dimension.select(F.col(key).alias(code_col), F.col(value).alias(text_col))
        df = df.join(role, code_col, "left")
    return df


def existence_flag(df: DataFrame, members: DataFrame, keys: list[str], flag: str,
                   value=True, absent=False) -> DataFrame:
    """Mark rows whose keys occur in ``members``."""
    marks = members.select(*keys).distinct().withColumn(flag, F.lit(value))
    return df.join(marks, keys, "left").fillna({flag: absent})


def cascade(df: DataFrame, key: str, own: str, fallbacks: list[DataFrame]) -> DataFrame:
    """First non-null of the own value and the same column of each fallback table."""
    names = []
    for i, fallback in enumerate(fallbacks):
        name = f"_fallback_{i}"
        names.append(name)
        # one value per key, whatever the fallback holds
        values = fallback.groupBy(key).agg(F.min(own).alias(name))
        df = df.join(values, key, "left")
    return df.withColumn(own, F.coalesce(own, *names)).drop(*names)


def taxonomy_hop(df: DataFrame, relation: DataFrame, values: DataFrame, activity_col: str) -> DataFrame:
    """Activity -> subsector / sector code -> description."""
    steps = [("subsector", codes.SUBSECTOR_CATALOGUE), ("sector", codes.SECTOR_CATALOGUE)]
    for name, catalogue in steps:
        hop = (
            relation.filter((F.col("from_catalogue") == codes.ACTIVITY_CATALOGUE)
                            & (F.col("to_catalogue") == catalogue))
            .select(F.col("from_value").alias(activity_col), F.col("to_value").alias(f"{name}_code"))
            .distinct()
        )
        texts = (
            values.filter(F.col("catalogue") == catalogue)
            .select(F.col("value").alias(f"{name}_code"), F.col("description").alias(f"{name}_desc"))
            .distinct()
        )
        df = df.join(hop, activity_col, "left").join(texts, f"{name}_code", "left")
    return df
