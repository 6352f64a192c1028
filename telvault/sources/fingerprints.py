"""Content fingerprints of tables, and where two tables differ.

A fingerprint is a multiset hash: two 64-bit hashes of each row, each summed over
all rows as decimals. Sums do not depend on order or partitioning, count repeated
rows as often as they occur, and are formed per partition before anything moves.
A row is hashed as typed, length-framed fields, so no two different rows are
hashed as the same text, and NULL is a field of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.session import materialize

BUCKETS, PARTS = 256, 256  # of keys, and of the keys of a bucket


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def family(kind: T.DataType) -> str:
    """One letter for the kind of a field."""
    for letter, kinds in (("s", (T.StringType,)), ("i", (T.IntegralType,)), ("d", (T.DecimalType,)), ("t", (T.TimestampType, T.TimestampNTZType)),
                          ("a", (T.DateType,)), ("b", (T.BooleanType,))):
        if isinstance(kind, kinds):
            return letter
    raise TypeError(f"a field of type {kind.simpleString()} has no portable text")


def row_text(schema: T.StructType) -> Column:
    """Text of a row: per field its kind, the number of characters and the value, or ``n`` alone for NULL."""
    def field(f):
        text = quoted(f.name).cast("string")
        return F.when(text.isNull(), F.lit("n;")).otherwise(
            F.concat(F.lit(family(f.dataType)), F.char_length(text).cast("string"), F.lit(":"), text, F.lit(";")))
    return F.concat(*[field(f) for f in schema.fields])


def row_hashes(schema: T.StructType, portable: bool = False) -> list[Column]:
    """Two hashes of a row, as decimal(20,0). Portable: the halves of the md5 of its text, as unsigned numbers, which any
    engine can form. Else Spark's own hash of the fields and whether they are NULL, from two seeds."""
    if portable:
        digest = F.md5(row_text(schema))
        return [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    fields = [c for f in schema.fields for c in (quoted(f.name).isNull(), quoted(f.name))]
    return [F.xxhash64(F.lit(seed), *fields).cast("decimal(20,0)") for seed in (1, 2)]


def fingerprint(df: DataFrame, portable: bool = False) -> DataFrame:
    """(rows, fingerprint) of a frame; the fingerprint is the text of both sums."""
    a, b = row_hashes(df.schema, portable)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("decimal(38,0)")).cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", total(a), total(b)).alias("fingerprint"))


def differences(source: DataFrame, target: DataFrame, key: list[str], buckets: int = BUCKETS, parts: int = PARTS) -> DataFrame:
    """(key columns, row_md5, source_rows, target_rows) of every distinct row that the two frames (of equal columns and
    types) do not hold equally often.

    Each side is read once for a narrow table of key hashes and row hashes. Sums by bucket of the key, then by part of
    the differing buckets, say where to look; only the rows of differing parts are read and counted, row by row. Equal
    tables are thus told by ``buckets`` sums, and no side is ever joined whole.
    """
    if [(f.name, f.dataType) for f in source.schema] != [(f.name, f.dataType) for f in target.schema]:
        raise ValueError("the frames differ in columns or types")
    place = F.xxhash64(*[c for k in key for c in (quoted(k).isNull(), quoted(k))])
    where = [F.pmod(place, F.lit(buckets)).cast("int").alias("_bucket"), F.pmod(F.shiftright(place, 24), F.lit(parts)).cast("int").alias("_part")]
    sums = lambda df, by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("_h1").alias("h1"), F.sum("_h2").alias("h2"))

    def narrow(df):
        a, b = row_hashes(df.schema)
        return materialize(df.select(*where, a.alias("_h1"), b.alias("_h2")))

    def unequal(a, b, by):
        """Places at which the sums differ: at most ``buckets`` or ``buckets * parts``."""
        both = sums(a, by).alias("a").join(sums(b, by).alias("b"), by, "full")
        same = F.lit(True)
        for c in ("n", "h1", "h2"):
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        return materialize(both.where(~same).select(*by))

    a, b = narrow(source), narrow(target)
    first = unequal(a, b, ["_bucket"])
    second = unequal(a.join(first, "_bucket", "left_semi"), b.join(first, "_bucket", "left_semi"), ["_bucket", "_part"])
    out = [c for c in source.columns if c in key]

    def counted(df, name):
        rows = df.select("*", *where).join(second, ["_bucket", "_part"], "left_semi")
        # a text is compared, not a hash: md5 of the framed text names the row
        return rows.select(*[quoted(c) for c in out], F.md5(row_text(df.schema)).alias("row_md5")).groupBy(*[quoted(c) for c in out], "row_md5").agg(
            F.count(F.lit(1)).alias(name))

    s, t = counted(source, "source_rows").alias("s"), counted(target, "target_rows").alias("t")
    joined = s.join(t, F.col("s.row_md5") == F.col("t.row_md5"), "full")
    either = lambda c: F.coalesce(F.col(f"s.`{c}`"), F.col(f"t.`{c}`")).alias(c)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select(*[either(c) for c in [*out, "row_md5"]], zero("source_rows"), zero("target_rows")).where("source_rows <> target_rows")
