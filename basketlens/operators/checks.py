"""Table validation and data-quality counts, each a bounded number of aggregate rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ValidationError(ValueError):
    """A required table is empty or lacks required columns."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def validate_tables(
    tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One row per table ``(table_name, row_count, missing_cols, ok)``, in a single job.

    Columns are checked on the schema; the row count needs no column, so parquet answers it
    from its footers.
    """

    def check(name: str, df: DataFrame) -> DataFrame:
        lacking = missing_columns(df, required.get(name, ()))
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(",".join(lacking)).alias("missing_cols"),
            ((F.col("row_count") > 0) & F.lit(not lacking)).alias("ok"),
        )

    return _union([check(name, df) for name, df in tables.items()])


def assert_valid(report: DataFrame, enabled: bool = True) -> dict[str, int]:
    """Row counts per table; raises on the first bad report when ``enabled``."""
    rows = report.collect()  # one row per table of the job
    bad = [r for r in rows if not r["ok"]]
    if bad and enabled:
        reasons = "; ".join(
            f"{r['table_name']}: " + (f"missing {r['missing_cols']}" if r["missing_cols"] else "empty")
            for r in bad
        )
        raise ValidationError(reasons)
    return {r["table_name"]: r["row_count"] for r in rows}


def null_checks(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where a column that must be filled is null."""
    return condition_checks(table, df, {f"null:{c}": F.col(c).isNull() for c in columns})


def condition_checks(table: str, df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows per broken rule, all rules in one pass."""
    counted = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, cond in enumerate(conditions.values())])
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(f"v{i}").alias("violations"))
            for i, name in enumerate(conditions)
        ]
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(cells))


WORD = 6  # key values share words of 2 ** 6 bits
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _integers(df: DataFrame, keys: Sequence[str]) -> bool:
    return len(keys) <= WORD and all(isinstance(df.schema[k].dataType, INTEGERS) for k in keys)


def key_words(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact bitmaps of integer keys: per word of 64 neighbouring key values ``bits`` (those that occur) and
    ``rows``. A key of several columns shares the bits out among them, so that a word is a tile of
    neighbouring values of each.

    Bits are or-ed in every task before the shuffle, by the hash aggregation that sums use. A
    null counts as a value of its own. Sparse, large and negative keys only take more words.
    """
    share = [(WORD + i) // len(keys) for i in range(len(keys))]  # bits of each column; they add up to WORD
    tiles, place, nulls = {}, F.lit(0), F.lit(0)
    for i, (key, bits) in enumerate(zip(keys, share)):
        value = F.coalesce(F.col(key).cast("bigint"), F.lit(0))
        tiles[f"w{i}"] = F.shiftright(value, bits)
        place = F.shiftleft(place, bits).bitwiseOR(value.bitwiseAND((1 << bits) - 1).cast("int"))
        nulls = nulls + F.col(key).isNull().cast("int") * (1 << i)
    placed = df.select(*(tile.alias(n) for n, tile in tiles.items()), nulls.alias("nulls"), place.alias("place"))
    bit = F.expr("shiftleft(1L, place)")
    return placed.groupBy(*tiles, "nulls").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("rows"))


def duplicate_check(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Surplus rows of keys that should be unique: rows less distinct keys. Nulls are equal."""
    if _integers(df, keys):
        surplus = F.col("rows") - F.bit_count("bits")
        counted = key_words(df, keys).agg(F.coalesce(F.sum(surplus), F.lit(0)).alias("violations"))
    else:
        copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        counted = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("violations"))
    return _check_row(table, f"duplicate:{'+'.join(keys)}", counted)


def orphan_check(
    table: str, df: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Rows whose foreign key has no parent; rows without a key are not counted.

    Integer keys are compared as bitmaps, one row per 64 key values, so a key that holds much of the
    table joins as one row. Rows are looked at again only where a word has both orphans and
    others. Other keys are first counted per key.
    """
    filled = df.filter(F.col(key).isNotNull()).select(key)
    parents = parent.filter(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias(key))
    if _integers(filled, [key]) and _integers(parents, [key]):
        there = key_words(parents, [key]).select("w0", F.col("bits").alias("known"))
        lost = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
        words = key_words(filled, [key]).join(there, "w0", "left").select("w0", "bits", "rows", lost.alias("lost")).filter("lost <> 0")
        mixed = words.filter("lost <> bits").select("w0", "lost")
        value = F.col(key).cast("bigint")
        again = filled.select(F.shiftright(value, WORD).alias("w0"), value.bitwiseAND((1 << WORD) - 1).cast("int").alias("place"))
        some = again.join(mixed, "w0").filter(F.getbit("lost", "place") == 1).agg(F.count(F.lit(1)).alias("n"))
        whole = words.filter("lost = bits").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        counted = whole.unionByName(some).agg(F.sum("n").alias("violations"))
    else:
        per_key = filled.groupBy(key).agg(F.count(F.lit(1)).alias("children"))
        counted = per_key.join(parents, key, "left_anti").agg(F.coalesce(F.sum("children"), F.lit(0)).alias("violations"))
    return _check_row(table, f"orphan:{key}", counted)


def key_checks(
    table: str, df: DataFrame, unique: Mapping[str, Sequence[str]], references: Mapping[str, DataFrame],
    conditions: Mapping[str, Column],
) -> DataFrame:
    """All checks of one table: broken ``conditions``, surplus rows of ``unique`` keys, and for each of
    ``references`` (a key column: its parents, one column of the same name) rows that are null or
    have no parent.

    Conditions and nulls are counted in one pass without a shuffle of rows; every key is read by
    itself, as a column, and shuffled as bitmaps.
    """
    broken = dict(conditions) | {f"null:{key}": F.col(key).isNull() for key in references}
    checks = [condition_checks(table, df, broken)] if broken else []
    checks += [duplicate_check(table, df, keys) for keys in unique.values()]
    checks += [orphan_check(table, df, key, parents, key) for key, parents in references.items()]
    return _union(checks)


def quality_report(*checks: DataFrame) -> DataFrame:
    return _union(list(checks))


def _check_row(table: str, check: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
