"""Operators on the event log: bounds, page pruning, latest events, ranks, filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairnlake.operators import scans


def in_bounds(at: Column, low, high) -> Column:
    """low < at <= high."""
    return (at > low) & (at <= high)


def prune_pages(pages: DataFrame, at: str, low, high) -> DataFrame:
    """Pages later than low, in order, up to and with the first one later than high. The page list is
    the short index of the log, one row for each page."""
    before = F.lag(at).over(Window.orderBy(at))
    kept = pages.where(F.col(at) > low).withColumn("__before", before)
    return kept.where(F.col("__before").isNull() | (F.col("__before") <= high)).drop("__before")


def latest(df: DataFrame, keys: list[str], at: list[str]) -> DataFrame:
    """The row of each key with the greatest `at`: one aggregation with map-side combine."""
    whole = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*at))
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(whole.alias("__row")).select("__row.*")


def drop_redundant(leaves: DataFrame, page: str, keys: list[str], order: list[str]) -> DataFrame:
    """The last leaf of each key inside each page."""
    return latest(leaves, [page, *keys], order)


def ranked(df: DataFrame, by: list[str], partition: list[str] | None = None, name: str = "rank") -> DataFrame:
    """A 0-based rank in the order of the columns, inside each partition or over the whole table."""
    if not partition:
        return scans.numbered(df, by, name)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*by)) - 1)


def without_ignored(df: DataFrame, id_col: str, at: str, patterns: list[tuple[str, object, object]]) -> DataFrame:
    """Rows that match none of (id pattern without regard to case, first time, last time)."""
    for pattern, low, high in patterns:
        df = df.where(~(F.col(id_col).rlike(f"(?is){pattern}") & F.col(at).between(low, high)))
    return df


def version_set(events: DataFrame, id_col: str, version_col: str, deleted: Column, order: list[str]) -> DataFrame:
    """(lower_id, id, lower_version, version, is_deleted): the last event of a version says whether it is deleted, and
    the last events give the casing of ids and versions. Deleted versions stay in the set."""
    rows = events.select(F.lower(id_col).alias("lower_id"), F.col(id_col).alias("id"), F.lower(version_col).alias("lower_version"), F.col(version_col).alias("version"), deleted.alias("is_deleted"), F.struct(*order).alias("at"))
    each = rows.groupBy("lower_id", "lower_version").agg(F.max_by("version", "at").alias("version"), F.max_by("is_deleted", "at").alias("is_deleted"), F.max_by("id", "at").alias("last_id"), F.max("at").alias("at"))
    ids = each.groupBy("lower_id").agg(F.max_by("last_id", "at").alias("id"))
    return each.join(ids, "lower_id").select("lower_id", "id", "lower_version", "version", "is_deleted")


def merged_version_set(stored: DataFrame, new: DataFrame, stored_commit, commit) -> DataFrame:
    """A stored version set with a new one (both as version_set gives them) of a commit: the new one says how it spells ids and
    versions and which are deleted; what it does not name stays. A commit older than the stored one changes nothing.

    One aggregation by version and one by id, with map-side combine."""
    if stored_commit is not None and commit < stored_commit:
        return stored
    both = stored.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    last = lambda c: F.max_by(c, "__new").alias(c)
    each = both.groupBy("lower_id", "lower_version").agg(last("version"), last("is_deleted"), last("id").alias("__id"), F.max("__new").alias("__new"))
    ids = each.groupBy("lower_id").agg(F.max_by("__id", "__new").alias("id"))
    return each.join(ids, "lower_id").select("lower_id", "id", "lower_version", "version", "is_deleted")


def version_set_as_of(history: DataFrame, as_of, checked: DataFrame | None = None) -> DataFrame:
    """Versions created by a moment. Ids that `checked` (lower_id) does not name keep all their versions."""
    if checked is None:
        return history.where(F.col("created") <= as_of)
    known = checked.select("lower_id", F.lit(True).alias("__checked")).distinct()
    return history.join(known, "lower_id", "left").where(F.col("__checked").isNull() | (F.col("created") <= as_of)).drop("__checked")


def existing_at(moments: DataFrame, things: DataFrame, key: str, width: int, salts: int = 16) -> DataFrame:
    """(as_of, key) of all things (key, created) that existed at each of many moments (as_of): created <= as_of.

    Time is cut into bins of `width` seconds, and a thing is sent to the bins from its creation to the last moment, so the join
    has an equal key and compares times inside a bin only. Things are salted, so that few bins are no few tasks."""
    at = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / width)
    last = moments.agg(F.max("as_of")).first()[0]
    if last is None:
        return moments.select("as_of").limit(0).join(things.select(key).limit(0))
    early = things.where(F.col("created") <= F.lit(last)).withColumn("__last", F.floor(F.unix_seconds(F.lit(last).cast("timestamp")) / width))
    spread = early.select(key, "created", F.explode(F.sequence(at("created"), "__last")).alias("__bin"), F.pmod(F.xxhash64(key), F.lit(salts)).alias("__salt"))
    asked = moments.select("as_of").distinct().select("as_of", at("as_of").alias("__bin"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("__salt"))
    return asked.join(spread, ["__bin", "__salt"]).where(F.col("created") <= F.col("as_of")).select("as_of", key)


def backfill(history: DataFrame, facts: DataFrame, moments: DataFrame, key: str, part: str, value: str, width: int = 90 * 86400) -> DataFrame:
    """(as_of, key, part, value, total): what a snapshot of each moment gives, with the history (key, part, created) of all
    parts. Keys and parts come in lower case.

    Facts (as_of, key, part, value) of parts that did not exist yet drop out. A key with facts left has their sum as its total,
    and its other parts that existed and that no fact names come with 0. A key that no fact names comes, if it existed, with
    all its parts, later ones too, and 0; a key whose facts all drop out gives nothing."""
    born = history.groupBy(key, part).agg(F.min("created").alias("created"))
    kept = facts.join(born, [key, part]).where(F.col("created") <= F.col("as_of")).select("as_of", key, part, value)
    totals = kept.groupBy("as_of", key).agg(F.sum(value).alias("total"))
    zero = F.lit(0).cast(facts.schema[value].dataType).alias(value)
    rest = totals.join(born, key).where(F.col("created") <= F.col("as_of")).join(facts.select("as_of", key, part), ["as_of", key, part], "left_anti")
    keys = born.groupBy(key).agg(F.min("created").alias("created"))
    unnamed = existing_at(moments, keys, key, width).join(facts.select("as_of", key).distinct(), ["as_of", key], "left_anti").join(born.select(key, part), key)
    none = F.lit(0).cast(totals.schema["total"].dataType).alias("total")
    out = kept.join(totals, ["as_of", key]).select("as_of", key, part, value, "total")
    return out.unionByName(rest.select("as_of", key, part, zero, "total")).unionByName(unnamed.select("as_of", key, part, zero, none))
