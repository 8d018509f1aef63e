"""Problem 2: entity-attribute-value rows into one wide row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, fits

MAX_COLUMNS = 2_000


def resolve_cells(rows: DataFrame, entity: Sequence[str], attribute: str = "column_name", value: str = "quantity", row: str = "obs_id") -> DataFrame:
    """One row per entity and attribute: value, state, bad_rows and first_bad.

    state: ``ok`` one value in all rows that have one; ``conflict`` two or more, value null; ``empty`` none. Rows without
    a value, whose text did not cast, are counted in bad_rows and found by first_bad, the least ``row`` among them: numbers
    only, so the aggregation hashes instead of sorting texts. Repeats count once. Rows with a null in the entity are no
    entity's; a null attribute is a cell of its own, which keeps the entity in being.
    """
    bad = F.col(value).isNull()
    out = rows.dropna(subset=list(entity)).groupBy(*entity, attribute).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_if(bad).alias("bad_rows"), F.min(F.when(bad, F.col(row))).alias("first_bad"),
    )
    state = F.when(F.col("lo").isNull(), "empty").when(F.col("lo") != F.col("hi"), "conflict").otherwise("ok")
    return out.select(*entity, F.col(attribute).alias("attribute"), F.when(state == "ok", F.col("lo")).alias("value"), state.alias("state"), "bad_rows", "first_bad")


def entity_maps(cells: DataFrame, entity: Sequence[str]) -> DataFrame:
    """One row per entity with ``cells``: a map from attribute, in order, to struct(value, state, bad_rows, first_bad).

    A map holds one entry per attribute, however many rows there are.
    """
    entry = F.when(F.col("attribute").isNotNull(), F.struct("attribute", F.struct("value", "state", "bad_rows", "first_bad")))
    return cells.groupBy(*entity).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells"))


def cell_state(column: str) -> Column:
    """State of a known column: a cell without any row is empty like one without any value."""
    return F.coalesce(F.col("cells")[column]["state"], F.lit("empty"))


def attribute_names(cells: DataFrame, max_columns: int = MAX_COLUMNS) -> list[str]:
    """All attributes in order; more than ``max_columns`` raise, since a table that wide is a sign of a wrong key."""
    names = cells.select("attribute").dropna().distinct()
    if not fits(names, max_columns):
        raise ValueError(f"more than {max_columns} attributes")
    return sorted(r[0] for r in names.collect())


def widen(rows: DataFrame, entity: Sequence[str], known: Sequence[str], attribute: str = "column_name", value: str = "quantity", row: str = "obs_id") -> DataFrame:
    """Entity columns, one typed column per attribute, those ``known`` first and any others in order, then ``failures``:
    attribute to state and rows of every cell that is empty, in conflict or has rows that did not cast, so none is lost.

    Cells are resolved once and kept, to read the names of the others from them.
    """
    cells = cut(resolve_cells(rows, entity, attribute, value, row))
    columns = [*known, *(n for n in attribute_names(cells) if n not in known)]
    failures = F.map_filter("cells", lambda _, v: (v["state"] != "ok") | (v["bad_rows"] > 0))
    return entity_maps(cells, entity).select(*entity, *(F.col("cells")[k]["value"].alias(k) for k in columns), F.to_json(failures).alias("failures"))


def unresolved_cells(rows: DataFrame, entity: Sequence[str], known: Sequence[str], attribute: str = "column_name", value: str = "quantity", row: str = "obs_id") -> DataFrame:
    """entity, column_name, cell_state of each known cell of an existing entity that is empty or in conflict."""
    states = F.explode(F.array(*(F.struct(F.lit(k).alias("column_name"), cell_state(k).alias("cell_state")) for k in known)))
    return entity_maps(resolve_cells(rows, entity, attribute, value, row), entity).select(*entity, states.alias("s")).select(*entity, "s.*").filter("cell_state != 'ok'")
