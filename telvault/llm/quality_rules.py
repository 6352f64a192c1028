"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a text whose measure is above a cutoff. The cutoffs come from
labelled documents: in each stratum (language), the cutoffs of a rule are tested
from the loosest to the strictest. A cutoff passes if the exact binomial test
says that it rejects less than its share of good documents: with ``n`` good ones
of which ``k`` are rejected, P(Bin(n, limit / rules) <= k) is at most
``(1 - confidence) / (rules * strata)``. The first that fails ends the rule's
series, so testing in a fixed order needs no further correction, and dividing by
rules and strata corrects for these. With the given confidence, all rules
together thus reject at most ``limit`` of the good documents of every stratum.
Among the cutoffs that passed, the one that catches most bad documents counts
(of equal ones, the loosest); a rule that catches none, or that has too few
labels to pass, has no cutoff there.

Per-text measures are computed inside the row, so no word is shuffled: repeated
windows are found by sorting (hash, position) packed in one long.

Defined results: null and empty texts have no words, fail the base rule and are
not kept; a null language and an empty one are one stratum; repeated rows repeat; without
labels only the base rule rejects; further columns are dropped (``measures``) or
kept (``kept_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telvault.llm.common import fresh, quoted, shared_table

LIMIT = 0.02  # of the good documents of a stratum, over all rules
CONFIDENCE = 0.95
BLANK = r"[\\x20\\x09-\\x0D]+"  # between words
WINDOW = 3
# rule: measure, and cutoffs from the loosest to the strictest
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.6, 0.5, 0.4, 0.3)),
    "repeats": ("n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3)),
    "long_words": ("word_chars / n_words", (12.0, 10.0, 9.0, 8.0, 7.0)),
    "capitals": ("n_capitals / word_chars", (0.5, 0.4, 0.3, 0.2, 0.1)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def _twice(name: str) -> str:
    """Entries of a sorted array of packed (hash, position) whose hash a neighbour shares."""
    return (f"filter({name}, (x, j) -> (j > 0 and shiftright(x, bits) = shiftright(get({name}, j - 1), bits)) "
            f"or (j < size({name}) - 1 and shiftright(x, bits) = shiftright(get({name}, j + 1), bits)))")


def _packed(positions: str, seed: str) -> str:
    words = ", ".join(f"get(words, i + {k})" for k in range(WINDOW))
    return f"sort_array(transform({positions}, i -> shiftleft(xxhash64({seed}{words}), bits) | i))"


def measures(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` and COUNTS (bigint) and base_failed per row, over the whole text.

    A window's hash keeps the bits that its position leaves free (over 40 for a million words). Positions whose
    hash occurs again are tested once more by the free bits of another hash.
    """
    rows = df.select(*[quoted(c).alias(f"c{k}") for k, c in enumerate(keep)], F.coalesce(quoted(text_col), F.lit("")).alias("t"))
    ids = [f"c{k}" for k in range(len(keep))]
    rows = rows.select(*ids, "t", F.expr(f"filter(split(t, '{BLANK}'), w -> w <> '')").alias("words"),
                       F.expr(r"filter(split(t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"))
    counts = {
        "n_words": "size(words)", "word_chars": "char_length(array_join(words, ''))", "n_symbols": r"regexp_count(t, '[#*$%&|<>]')",
        "n_dup_lines": "size(lines) - size(array_distinct(lines))", "n_lines": "size(lines)", "n_capitals": r"regexp_count(t, '\\p{Lu}')",
    }
    counts = [F.expr(f"cast({e} as bigint)").alias(c) for c, e in counts.items()]
    names = [*ids, *[c for c in COUNTS if c != "n_repeat_words"]]
    # each step is a projection of its own, so that what a lambda uses is computed once
    rows = rows.select(*ids, "words", F.expr("length(bin(size(words)))").alias("bits"), *counts)
    starts = f"if(size(words) >= {WINDOW}, transform(sequence(0, greatest(size(words) - {WINDOW}, 0)), i -> cast(i as bigint)), array())"
    rows = rows.select(*names, "words", "bits", F.expr(_packed(starts, "").replace("get(words, i +", "get(words, cast(i as int) +")).alias("packed"))
    rows = rows.select(*names, "words", "bits", F.expr(f"transform({_twice('packed')}, x -> x & (shiftleft(1L, bits) - 1))").alias("again"))
    rows = rows.select(*names, "bits", F.expr(_packed("again", "'again', ").replace("get(words, i +", "get(words, cast(i as int) +")).alias("packed"))
    rows = rows.select(*names, F.expr(f"sort_array(transform({_twice('packed')}, x -> x & (shiftleft(1L, bits) - 1)))").alias("again"))
    covered = (f"aggregate(again, struct(cast(0 as bigint) as e, cast(0 as bigint) as n), "
               f"(a, p) -> struct(p + {WINDOW} as e, a.n + {WINDOW} - greatest(a.e - p, 0L) as n)).n")
    rows = rows.select(*names, F.expr(covered).alias("n_repeat_words"))
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)], *COUNTS, failed.alias("base_failed"))


def rule_value(rule: str) -> Column:
    return F.expr(f"if(n_words = 0, 0D, cast({RULES[rule][0]} as double))")


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1, by Stirling's series at x + 8."""
    y = x + 8
    low = x
    for k in range(1, 8):
        low = low * (x + k)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - F.log(low)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exactly, for k up to the mean; 1 above it, where no test passes."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    # terms below the k-th, each a multiple of the one above; those beyond the span add nothing to a double
    span = F.least(k, F.ceil(40 * F.sqrt(n * p * (1 - p))) + 60).cast("int")
    add = lambda a, i: F.struct((a.term * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("term"), (a.total + a.term).alias("total"))
    series = F.aggregate(F.sequence(F.lit(0), span), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")), add, lambda a: a.total)
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * series))


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str, stratum: str, label_col: str = "quality",
            limit: float = LIMIT, confidence: float = CONFIDENCE) -> DataFrame:
    """(stratum, and a column per rule with its cutoff or null), one row for each stratum that has labels."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).alias("good"))
    rows = measured.where("not base_failed").join(known, measured[id_col] == F.col("label_id")).select(
        F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "good", *[rule_value(r).alias(r) for r in RULES])
    count = lambda c: F.sum(c.cast("bigint"))
    over = [F.struct(F.lit(r).alias("rule"), F.lit(k).alias("step"), F.lit(c).alias("cutoff"),
                     count((F.col(r) > c) & (F.col("good") == 1)).alias("k"), count((F.col(r) > c) & (F.col("good") == 0)).alias("caught"))
            for r, (_, cuts) in RULES.items() for k, c in enumerate(cuts)]
    tests = rows.groupBy("stratum").agg(count(F.col("good") == 1).alias("n"), F.array(*over).alias("tests"))
    tests = shared_table(tests.select("stratum", "n", F.inline("tests")), "tests")
    strata = max(1, tests.select("stratum").distinct().count())
    level = (1 - confidence) / (len(RULES) * strata)
    passed = tests.withColumn("failed", (binomial_tail(F.col("k"), F.col("n"), limit / len(RULES)) > level).cast("int"))
    series = Window.partitionBy("stratum", "rule").orderBy("step")
    passed = passed.withColumn("failed", F.sum("failed").over(series)).where("failed = 0 and caught > 0")
    best = passed.groupBy("stratum").agg(*[
        F.max_by(F.when(F.col("rule") == r, F.col("cutoff")), F.when(F.col("rule") == r, F.struct("caught", "cutoff"))).alias(f"cut_{r}") for r in RULES])
    # written: as small as the strata, so that Spark sees its size when it plans the join with the documents
    return shared_table(best, "cutoffs")


def verdict(measured: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    """``measured`` with ``kept``."""
    best = cuts.withColumnRenamed("stratum", "_stratum")
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(rule_value(r) > F.col(f"cut_{r}"), F.lit(False))
    joined = measured.join(best, F.coalesce(F.col(stratum), F.lit("")) == F.col("_stratum"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("_stratum", *[f"cut_{r}" for r in RULES])


def kept_rows(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang") -> DataFrame:
    """The rows of ``df`` that pass, with their own columns. Rows are written once with their measures, so that no
    text is shuffled or measured twice."""
    row = fresh("_row", df)
    whole = df.select(F.struct(*[quoted(c) for c in df.columns]).alias(row), quoted(id_col).alias("_id"), quoted(stratum).alias("_stratum0"), quoted(text_col).alias("_text"))
    table = shared_table(measures(whole, [row, "_id", "_stratum0"], "_text"), "measured")
    narrow = table.select("_id", "_stratum0", *COUNTS, "base_failed")
    cuts = cutoffs(narrow, labels.withColumnRenamed(id_col, "_id"), "_id", "_stratum0")
    return verdict(table, cuts, "_stratum0").where("kept").select(f"{row}.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    table = shared_table(measures(docs, ["doc_id", "lang"], "text"), "measured")
    return verdict(table, cutoffs(table, labels, "doc_id", "lang"), "lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
