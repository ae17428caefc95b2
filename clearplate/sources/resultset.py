"""Result-set events: nested JSON into rows, and the pairs they name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearplate.sources.schemas import RESULT_EVENT_DDL


def result_rows(events: DataFrame, payload: str = "payload", keys: Sequence[str] = ()) -> DataFrame:
    """Flatten events to (keys…, names, cells): one row per result row.

    A data item is a row (array of cells) or a block (array of rows); anything
    else is skipped. Broken payloads give no rows.
    """
    parsed = events.select(*keys, F.from_json(payload, RESULT_EVENT_DDL)["data"]["result_set"].alias("rs"))
    items = parsed.select(
        *keys,
        F.transform("rs.resultSetMetaData.rowType", lambda t: t["name"]).alias("names"),
        F.explode("rs.data").alias("item"),
    )
    block = F.from_json("item", "array<array<string>>")
    row = F.from_json("item", "array<string>")
    is_block = F.col("item").rlike(r"^\s*\[\s*\[")
    is_row = F.col("item").rlike(r"^\s*\[")
    rows = F.when(is_block, block).when(is_row, F.array(row))
    return items.select(*keys, "names", F.explode(rows).alias("cells")).filter(F.col("cells").isNotNull())


def result_table(events: DataFrame, columns: Sequence[str], payload: str = "payload", keys: Sequence[str] = ()) -> DataFrame:
    """Rows with named string columns; a column the metadata lacks is NULL."""
    rows = result_rows(events, payload, keys)

    def cell(name: str):
        at = F.array_position("names", name)
        return F.when(at > 0, F.get(F.col("cells"), (at - 1).cast("int"))).alias(name)

    return rows.select(*keys, *[cell(c) for c in columns])


def name_borough_pairs(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct (restaurant_name, borough) pairs named in the events; a missing borough is ''."""
    table = result_table(events, ["RESTAURANT_NAME", "BOROUGH"], payload)
    return (
        table.filter(F.col("RESTAURANT_NAME").isNotNull() & (F.col("RESTAURANT_NAME") != ""))
        .select(F.col("RESTAURANT_NAME").alias("restaurant_name"), F.coalesce("BOROUGH", F.lit("")).alias("borough"))
        .distinct()
    )
