"""Silver operators over bronze tables: consolidate, validate, deduplicate, conform, clean.

All are DataFrame-in, DataFrame-out compositions of built-in operators.
"Latest row per key" is written as ``max_by`` over a struct ordering rather
than ``row_number`` over a window: ``max_by`` aggregates partially on the map
side, so a key holding a third of all rows is reduced to one row per task
before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """The columns but those in ``exclude`` and those whose type has no order."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, _UNORDERABLE)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the remaining columns.

    The tie-break makes the result deterministic even when two versions share
    the same ordering values (same sequence, same timestamp).
    """
    keys, order_by = list(keys), list(order_by)
    others = [c for c in df.columns if c not in keys]
    tiebreak = orderable(df, keys + order_by)
    ordering = F.struct(*[_q(c).alias(f"o{i}") for i, c in enumerate(order_by + tiebreak)])
    best = F.max_by(F.struct(*[_q(c) for c in others]), ordering).alias("_row")
    out = df.groupBy(*[_q(k) for k in keys]).agg(best)
    return out.select(*[_q(k) for k in keys], *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def cdc_current_state(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                      deleted: Column | str) -> DataFrame:
    """Current state per key from change records (insert / update / delete).

    The last change of each key wins; a key whose last change is a delete has
    no current row (the tombstone hides it, it is not resurrected by older rows).
    """
    flag = F.expr(deleted) if isinstance(deleted, str) else deleted
    marked = changes.withColumn("_is_deleted", F.coalesce(flag, F.lit(False)))
    latest = latest_per_key(marked, keys, order_by)
    return latest.where(~F.col("_is_deleted")).drop("_is_deleted")


def validate_ranges(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``failed_rules`` (names of rules violated, comma separated, '' if none) and ``is_valid``.

    A rule is a ``(name, SQL condition)``; a row violates it when the condition
    is false. A null condition (missing input) is *not* a violation: missing
    values are a completeness question, not a range one.
    """
    failed = F.array_compact(F.array(*[F.when(~F.expr(cond), F.lit(name)) for name, cond in rules]))
    return (df.withColumn("failed_rules", F.array_join(failed, ","))
              .withColumn("is_valid", F.col("failed_rules") == ""))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of a ``validate_ranges`` result."""
    return validated.where("is_valid"), validated.where("NOT is_valid")


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, keeping the greatest by ``order_by`` then by all other columns."""
    return latest_per_key(df, keys, order_by)


def conform(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    """Join a fact table with dimensions on business keys; facts are never dropped (left join) nor multiplied.

    A dimension is reduced to one row per key first (the greatest by its other columns, by order).

    No broadcast is forced: Spark broadcasts a side only when its estimated size
    is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans with
    actual sizes (and splits skewed partitions) at runtime.
    """
    return reduce(lambda acc, d: acc.join(deduplicate(d[0], list(d[1])), list(d[1]), how), dims, fact)


def latest_snapshot(df: DataFrame, entity: Sequence[str], snapshot_ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per entity: its latest snapshot, ties on time broken by ``tiebreak`` then all columns."""
    return latest_per_key(df, entity, [snapshot_ts, *tiebreak])


def typed_clean(df: DataFrame, types: dict[str, str], keep_raw: bool = False) -> DataFrame:
    """Bronze text to silver types with ``try_cast``: unconvertible values become null.

    With ``keep_raw`` the original text of every column is kept as ``<col>_raw``.
    """
    cols = []
    for c in df.columns:
        if c in types:
            cols.append(_q(c).try_cast(types[c]).alias(c))
            if keep_raw:
                cols.append(_q(c).alias(f"{c}_raw"))
        else:
            cols.append(_q(c))
    return df.select(*cols)


def path_columns(df: DataFrame, path_col: str, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns taken from folder names: ``name: (regex with one group, type)``, URL-decoded path."""
    decoded = F.url_decode(_q(path_col))
    return df.withColumns({name: F.regexp_extract(decoded, rx, 1).try_cast(t) if t != "string"
                           else F.regexp_extract(decoded, rx, 1)
                           for name, (rx, t) in patterns.items()})
