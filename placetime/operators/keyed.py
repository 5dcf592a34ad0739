"""Keyed layer tables: last write wins, linked selections, deletes, visibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import text
from placetime.operators.joins import salted_join
from placetime.operators.ordered import ordered_columns

# Opacity rules of linked highlighting and the missing class label.
DEFAULT_STROKE_OPACITY = 0.5
DEFAULT_FILL_OPACITY = 0.2
FADED = 0.2
MISSING_LABEL = "NA"


# --- upserts ------------------------------------------------------------------

def latest_per_key(changes: DataFrame, keys: list[str], order: list[str], optional: str | None = None) -> DataFrame:
    """Last row per key by ``order``; rows whose ``optional`` key is null all stay.

    The maximum combines on the map side, so a hot key costs one row per task.
    """
    def newest(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in keys and c not in order]
        top = df.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_row"))
        return top.select(*(F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns))

    if optional is None:
        return newest(changes)
    named = newest(changes.where(F.col(optional).isNotNull()))
    return named.unionByName(changes.where(F.col(optional).isNull()))


def replaced_by(changes: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Every keyed change with the values of the row it replaces (null for the first)."""
    named = changes.dropna("any", subset=keys)
    return ordered_columns(named, keys, order, previous={f"old_{c}": c for c in columns})


def latest_state(df: DataFrame, entity: str, order: list[str], state: list[str]) -> DataFrame:
    """Latest values of some columns per entity."""
    top = df.groupBy(entity).agg(F.max_by(F.struct(*state), F.struct(*order)).alias("_state"))
    return top.select(entity, "_state.*")


# --- linked selections ----------------------------------------------------------

def linked_filter(layers: DataFrame, selection: DataFrame | None, on: list[str], spread_by: list[str]) -> DataFrame:
    """Layers whose key is selected. No selection keeps all; an empty one keeps none."""
    if selection is None:
        return layers
    return salted_join(layers, selection.select(*on).distinct(), on, spread_by, how="left_semi")


def linked_highlight(
    layers: DataFrame, selection: DataFrame | None, on: list[str], spread_by: list[str],
    stroke: str | None = None, fill: str | None = None,
) -> DataFrame:
    """Opacity of every layer: full when its key is selected or nothing is, else faded."""
    base_stroke = F.coalesce(F.col(stroke), F.lit(DEFAULT_STROKE_OPACITY)) if stroke else F.lit(DEFAULT_STROKE_OPACITY)
    base_fill = F.coalesce(F.col(fill), F.lit(DEFAULT_FILL_OPACITY)) if fill else F.lit(DEFAULT_FILL_OPACITY)
    if selection is None:
        factor, marked = F.lit(1.0), layers
    else:
        keys = selection.select(*on).distinct().withColumn("_selected", F.lit(True))
        some = keys.agg(F.count(F.lit(1)) > 0).scalar()
        marked = salted_join(layers, keys, on, spread_by, how="left").withColumn("_some", some)
        factor = F.when(~F.col("_some") | F.col("_selected"), 1.0).otherwise(FADED)
    return marked.withColumns(
        {"opacity": base_stroke * factor, "fill_opacity": base_fill * factor}
    ).drop("_selected", "_some")


# --- deletes --------------------------------------------------------------------

def delete_keys(layers: DataFrame, doomed: DataFrame, on: list[str], spread_by: list[str]) -> DataFrame:
    """Layers without the named keys; unknown keys are ignored."""
    return salted_join(layers, doomed.select(*on).distinct(), on, spread_by, how="left_anti")


def delete_groups(layers: DataFrame, column: str, names: list[str] | None = None) -> DataFrame:
    """Layers without the named categories or groups; no names removes everything."""
    if names is None:
        return layers.where(F.lit(False))
    return layers.where(F.col(column).isNull() | ~F.col(column).isin(names))


# --- visibility -----------------------------------------------------------------

def visible_at(layers: DataFrame, rules: DataFrame, group: str, zoom: Column) -> DataFrame:
    """Layers of groups shown at a zoom.

    ``rules`` has one row per group: ``always`` (boolean) and ``zooms`` (array).
    Groups without a rule are untouched.
    """
    ruled = layers.join(rules.withColumn("_ruled", F.lit(True)), group, "left")
    shown = (
        F.col("_ruled").isNull()
        | F.coalesce(F.col("always"), F.lit(False))
        | F.coalesce(F.array_contains("zooms", zoom), F.lit(False))
    )
    return ruled.where(shown).select(*layers.columns)


def nearest_listing(pages: DataFrame, membership: DataFrame) -> DataFrame:
    """The listing that fits each page best.

    ``pages``: page_id, path, referrer. ``membership``: page_id, listing, position (its
    order among all listings). The listing that shares the longest path prefix wins,
    then the referrer if it lists the page, then the first listing.
    """
    scored = membership.join(pages, "page_id").select(
        "page_id", "listing", "position",
        text.shared_prefix("path", "listing").alias("shared"),
        F.equal_null(F.col("listing"), F.col("referrer")).alias("referred"),
    )
    early = -F.col("position")
    best = scored.groupBy("page_id").agg(
        F.max(F.struct("shared", early.alias("early"), "listing")).alias("near"),
        F.max(F.when(F.col("referred"), F.struct(early.alias("early"), F.col("listing")))).alias("back"),
        F.max(F.struct(early.alias("early"), "listing")).alias("first"),
    )
    return best.select(
        "page_id",
        F.when(F.col("near.shared") > 0, F.col("near.listing"))
        .otherwise(F.coalesce("back.listing", "first.listing")).alias("listing"),
        F.col("near.shared").cast("bigint").alias("shared"),
    )


# --- classes --------------------------------------------------------------------

def class_counts(df: DataFrame, column: str, missing: str = MISSING_LABEL) -> DataFrame:
    """Rows per class, missing values as a class of their own."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias(column)).agg(
        F.count(F.lit(1)).alias("rows")
    )


def with_missing_class(domain: DataFrame, label: str, colour: str, missing_colour: str, missing: str = MISSING_LABEL) -> DataFrame:
    """A class domain with the missing class appended unless it is already there."""
    own = domain.where(F.col(label) == missing).agg(F.count(F.lit(1)).alias("_n"))
    extra = own.where(F.col("_n") == 0).select(F.lit(missing).alias(label), F.lit(missing_colour).alias(colour))
    return domain.select(label, colour).unionByName(extra)


def styled_features(df: DataFrame, properties: str = "properties") -> DataFrame:
    """Nine style columns, popup and label out of a feature's property map."""
    p = F.col(properties)
    # fixed values: the property names that features carry
    numbers = ("radius", "opacity", "weight", "fillOpacity")
    texts = ("fillColor", "color", "dashArray", "popup", "label")
    flags = ("stroke", "fill")
    return df.withColumns(
        {name: p[name].try_cast("double") for name in numbers}
        | {name: p[name] for name in texts}
        | {name: p[name].try_cast("boolean") for name in flags}
    )


def map_rows(df: DataFrame, make: Column, into: str) -> DataFrame:
    """Apply a caller's row expression; rows for which it gives nothing are skipped."""
    return df.withColumn(into, make).where(F.col(into).isNotNull())
