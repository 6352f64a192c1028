"""Join helpers: NULL-as-wildcard left join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wildcard_matches(right: DataFrame, keys: DataFrame, group_key: str, wildcard_key: str) -> DataFrame:
    """Right rows keyed for an equi-join that reproduces the NULL-as-wildcard condition.

    Condition: ``l.g = r.g AND coalesce(l.w, '') = coalesce(r.w, l.w)``. The
    probe key of a left row is ``(g, w IS NULL, coalesce(w, ''))``; this
    returns, per right row, every probe key it satisfies:

    * keyed row (w = k): ``(g, false, k)``, and also ``(g, true, '')`` when
      k = '' (a NULL left key compares as '');
    * wildcard row (w NULL): one row per distinct non-NULL left key of its
      group, taken from ``keys`` (the left entity table, not an accumulated
      join), by an inner join on the group. The keys of a hot group are the
      large side of that join, which AQE splits.

    Output is bounded by right rows + (left keys x wildcard rows per group).
    """
    rcols = [c for c in right.columns if c not in (group_key, wildcard_key)]
    w = F.col(wildcard_key)
    # grouped on more than the join's key, so that the join shuffles both sides itself: only such a shuffle can be split
    lk = (keys.select(F.col(group_key).alias("__g"), F.col(wildcard_key).alias("__lk"))
          .filter(F.col("__lk").isNotNull() & F.col("__g").isNotNull()).distinct())
    wild = right.filter(w.isNull()).drop(wildcard_key).join(lk, F.col(group_key) == F.col("__g")).select(
        group_key, F.lit(False).alias("__wnull"), F.col("__lk").cast("string").alias("__wkey"), *rcols)

    def probe(is_null, key):
        return F.struct(F.lit(is_null).alias("__wnull"), key.cast("string").alias("__wkey"))

    probes = F.when(w == "", F.array(probe(False, w), probe(True, F.lit("")))).otherwise(F.array(probe(False, w)))
    keyed = (right.filter(w.isNotNull()).select(group_key, F.explode(probes).alias("__p"), *rcols)
             .select(group_key, "__p.__wnull", "__p.__wkey", *rcols))
    return wild.unionByName(keyed)


def probe_keys(df: DataFrame, wildcard_key: str) -> DataFrame:
    """Add the probe key (``w IS NULL``, ``coalesce(w, '')``) used by the wildcard joins."""
    return (df.withColumn("__wnull", F.col(wildcard_key).isNull())
              .withColumn("__wkey", F.coalesce(F.col(wildcard_key), F.lit(""))))


def exact_keys(right: DataFrame, wildcard_key: str) -> DataFrame:
    """Right rows of a plain equi-join on ``w``, keyed like :func:`wildcard_matches`.

    NULL keys never match (SQL equality), so they are dropped; joining on the
    same (group, flag, key) columns keeps one hash partitioning across a
    chain of wildcard and plain joins.
    """
    return (right.filter(F.col(wildcard_key).isNotNull())
            .withColumn("__wnull", F.lit(False)).withColumnRenamed(wildcard_key, "__wkey"))


def wildcard_left_join(left: DataFrame, right: DataFrame, group_key: str, wildcard_key: str,
                       keys: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right ON l.g = r.g AND coalesce(l.w, '') = coalesce(r.w, l.w)``.

    A right row whose ``wildcard_key`` is NULL matches every left row of its
    group; a non-NULL one matches its own key. Rewritten as one left
    equi-join on (group, NULL flag, key) -- no theta join, no nested loop --
    against :func:`wildcard_matches`. ``keys`` is the frame the wildcard rows
    expand over (default: ``left``); pass the entity table when ``left`` is
    itself a join so that join is not evaluated twice. A hot group is a
    skewed equi-join on the group key, which AQE splits.
    """
    m = wildcard_matches(right, left if keys is None else keys, group_key, wildcard_key)
    return probe_keys(left, wildcard_key).join(m, [group_key, "__wnull", "__wkey"], "left") \
        .drop("__wnull", "__wkey")
