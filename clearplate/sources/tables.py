"""Writing and maintaining tables on plain Parquet.

Plain Parquet has no row update, so a change is a new DataFrame: the functions that
take a ``target`` frame return the whole new state, and the caller writes it to a
new path. Functions that take a path overwrite the partitions they touch, and no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearplate.functions.latest import join_null_safe, top_per_key
from clearplate.session import written

RATINGS = ("up", "down")
# Rows of one partition of a table cut by key, when it is first written.
PART_ROWS = 1_000_000


class RowCountMismatch(RuntimeError):
    pass


def full_refresh(df: DataFrame, path: str) -> int:
    """Replace the table at ``path`` and check that what was written is what is there."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    written = seen.get["rows"]
    stored = df.sparkSession.read.parquet(path).count()
    if stored != written:
        raise RowCountMismatch(f"{path}: wrote {written} rows, found {stored}")
    return stored


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Make ``df`` the content of the partitions its rows fall in; other partitions stay.

    Finished files are moved into place when all tasks have ended, so a write that fails
    before changes nothing. A failure during the move can leave some partitions new and
    others old; the same write made again completes it. One writer at a time is assumed.
    Rebalancing cuts a large partition into several files.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def part_of(key: str) -> Column:
    """A folder name for any value of ``key``: NULL and empty text differ, and long or odd text has a short name."""
    return F.coalesce(F.sha2(F.col(key).cast("string"), 256), F.lit("none"))


def replace_by_key(df: DataFrame, path: str, key: str) -> None:
    """Replace all rows of each ``key`` value in ``df``; other values stay. Re-running changes nothing.

    The table is partitioned by the key, so nothing old is read.
    """
    overwrite_partitions(df.withColumn("_part", part_of(key)), path, ["_part"])


def create_cut_by_keys(df: DataFrame, path: str, keys: Sequence[str], part_rows: int = PART_ROWS) -> None:
    """Write a table cut by a hash of ``keys`` into as many partitions as its rows ask for.

    The number is a partition column itself, so that later changes place rows alike.
    """
    parts = max(1, -(-df.count() // part_rows))
    overwrite_partitions(df.withColumns({"_parts": F.lit(parts), "_part": F.pmod(F.xxhash64(*keys), F.lit(parts))}), path, ["_parts", "_part"])


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a partitioned table, without the columns that only name its folders."""
    return spark.read.parquet(path).drop("_parts", "_part")


def last_update_wins(updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key out of a batch that may hold several."""
    return top_per_key(updates, keys, order)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], keep_on_update: Sequence[str] = ("created_at",)) -> DataFrame:
    """Matched rows take the values of ``updates``, except ``keep_on_update``; new keys are added.

    ``updates`` holds one row per key (see :func:`last_update_wins`). The join is a
    full outer equi-join; both sides have at most one row per key, so no key is hot.
    """
    fresh = updates.select(*[F.col(c).alias(f"_u_{c}") for c in target.columns])
    matched = F.col(f"_u_{keys[0]}").isNotNull()
    joined = target.join(fresh, [target[k] == fresh[f"_u_{k}"] for k in keys], "full")
    known = F.col(keys[0]).isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            value = F.coalesce(F.col(c), F.col(f"_u_{c}"))
        elif c in keep_on_update:
            value = F.when(known, F.col(c)).otherwise(F.col(f"_u_{c}"))
        else:
            value = F.when(matched, F.col(f"_u_{c}")).otherwise(F.col(c))
        out.append(value.alias(c))
    return joined.select(*out)


def upsert_partitions(path: str, updates: DataFrame, keys: Sequence[str], keep_on_update: Sequence[str] = ("created_at",)) -> None:
    """Upsert into a table cut by a hash of ``keys``; only the touched partitions are read and written anew.

    Their new content is written beside the table first: a path is never overwritten while
    it is read. An upsert made again changes nothing, which also mends one that failed while
    its files were moved into place.
    """
    spark = updates.sparkSession
    table = spark.read.parquet(path)
    parts = table.agg(F.max("_parts")).first()[0]  # from folder names
    place = {"_parts": F.lit(parts), "_part": F.pmod(F.xxhash64(*keys), F.lit(parts))}
    touched = updates.select(place["_part"].alias("_part")).distinct()
    held = table.join(touched, "_part", "left_semi").drop("_parts", "_part")
    merged = upsert(held, updates, keys, keep_on_update).withColumns(place)
    overwrite_partitions(written(merged, "merged"), path, ["_parts", "_part"])


def delete_where(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose keys are in ``doomed`` (one fact, or all of a user's)."""
    return target.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def deleted_counts(target: DataFrame, doomed: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How many rows :func:`delete_where` removes, in total or per ``by``."""
    gone = target.join(doomed.select(*keys).distinct(), list(keys), "left_semi")
    return gone.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_deleted"))


def rating_events(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Rating rows with a generated id and defaults; only known ratings pass."""
    created = F.col("created_at") if "created_at" in df.columns else F.lit(None).cast("timestamp_ntz")
    return (
        df.filter(F.col("rating").isin(*RATINGS))
        .filter(F.col("user_id").isNotNull() & F.col("session_id").isNotNull() & F.col("turn_index").isNotNull())
        .select(
            F.uuid().alias("feedback_id"), "user_id", "session_id", "turn_index", "question", "answer", "rating",
            F.coalesce(created, now if now is not None else F.localtimestamp()).alias("created_at"),
        )
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks."""
    missing = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(missing.select(*target.columns))


def correct(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched rows only; NULL in ``changes`` leaves a column as it was."""
    columns = [c for c in changes.columns if c not in keys]
    fresh = changes.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in columns])
    joined = join_null_safe(target, fresh, keys, "left")
    return joined.select(*[F.coalesce(f"_u_{c}", c).alias(c) if c in columns else c for c in target.columns])


def correct_fact(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Change fact values. The vector belongs to the value, so it is replaced in the same step."""
    if "fact_value" in changes.columns and "fact_embedding" not in changes.columns:
        raise ValueError("a changed fact_value needs its new fact_embedding")
    return correct(target, changes, ["user_id", "fact_key"])


def write_audited(df: DataFrame, path: str, audit_path: str, job: str, run_id: str, event_time, inputs: Sequence[Mapping[str, str]], output: str, mode: str = "OVERWRITE") -> None:
    """Write a table and append one row that records the load; the rows are counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode.lower()).parquet(path)
    append(audit_row(df, seen.get["rows"], job, run_id, event_time, inputs, output, mode), audit_path)


def audit_row(df: DataFrame, rows: int, job: str, run_id: str, event_time, inputs: Sequence[Mapping[str, str]], output: str, mode: str = "OVERWRITE") -> DataFrame:
    """One row that records a load: run, time, inputs, output, columns, row count, mode."""
    fields = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema]
    sources = [F.struct(*[F.lit(i[k]).alias(k) for k in ("namespace", "name")]) for i in inputs]
    return df.sparkSession.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit("COMPLETE").alias("event_type"),
        F.lit(event_time).cast("timestamp_ntz").alias("event_time"),
        F.lit(job).alias("job"),
        F.array(*sources).alias("inputs"),
        F.lit(output).alias("output"),
        F.array(*fields).alias("columns"),
        F.lit(rows).cast("long").alias("row_count"),
        F.lit(mode).alias("lifecycle_state"),
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count") for name, df in layers.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
