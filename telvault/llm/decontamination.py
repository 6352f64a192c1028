"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

``build_index`` stores a posting (document, position) of every occurrence of the
terms asked for, as a written table. ``phrase_matches`` finds where the phrases
stand: for each phrase its rarest term's postings give the candidate starts
(position minus offset), the second rarest term's postings, adjusted by their
offset, are intersected with these, and the few that remain are intersected with
the lists of all other terms. A phrase is found if every list has its start, so
matches are exact. ``proximity_matches`` finds pairs of terms near each other.

Documents are known by ``k1`` (the id) and ``k2`` (the text's hash), so repeated
ids do not mix. Joins are on (document, position), which no hot term or document
gathers; small sides are written tables whose size Spark sees.

Ids are integers. Defined results: null and empty texts have no words, no hits and no items; null
item ids match but are not listed or counted; items with equal text are listed
each; repeated documents give repeated rows; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telvault.llm.common import fresh, quoted, shared_table

# words lie between runs of ASCII characters that are neither letters nor digits
BETWEEN = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
DOC = ["k1", "k2"]
END = ""  # no word is empty
NO_ID = -(1 << 63)  # stands for a null id, and is no id itself


def lower_az(word: Column) -> Column:
    """``word`` with A-Z lowered and other letters as they are."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words_of(text: str) -> Column:
    # a split takes a sixth of the time of an extraction of all matches
    return F.expr(f"filter(split({text}, '{BETWEEN}'), w -> w <> '')")


def doc_keys(id_col: str, text_col: str) -> list[Column]:
    """Never null, and equal for rows of equal id and text."""
    return [F.coalesce(quoted(id_col).cast("bigint"), F.lit(NO_ID)).alias("k1"),
            F.xxhash64(quoted(id_col).isNull(), quoted(text_col)).alias("k2")]


def build_index(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame | None = None) -> DataFrame:
    """Written postings (k1, k2, pos, term) of all words, or of those in ``terms`` (distinct). Behind its last word each
    row has a posting of the term END, whose position is thus the row's number of words."""
    words = F.concat(words_of(f"coalesce(`{text_col}`, '')"), F.array(F.lit(END)))
    rows = docs.select(*doc_keys(id_col, text_col), F.posexplode(words).alias("pos", "word"))
    rows = rows.select(*DOC, "pos", lower_az(F.col("word")).alias("term"))
    if terms is not None:
        end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
        rows = rows.join(shared_table(terms.select("term").unionAll(end), "terms"), "term")
    return shared_table(rows.select(*DOC, "pos", "term"), "postings")


def windows(items: DataFrame, item_col: str, text_col: str, width: int = WINDOW) -> DataFrame:
    """(item, words): each run of ``width`` words of an item; a shorter one is one window."""
    words = F.transform(words_of(f"coalesce(`{text_col}`, '')"), lower_az)
    rows = items.select(F.col(item_col).alias("item"), words.alias("words")).where("size(words) > 0")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))).alias("start")
    return rows.select("item", "words", starts).select("item", F.expr(f"slice(words, start + 1, {width})").alias("words"))


def phrase_terms(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Written (phrase, len, off, term, rank): rank 1 is a phrase's rarest term in the index. Phrases of which a term
    does not occur are left out, for they cannot occur."""
    seen = shared_table(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    rows = phrases.select("phrase", F.size("words").alias("len"), F.posexplode("words").alias("off", "term")).join(seen, "term")
    whole = Window.partitionBy("phrase")
    rows = rows.withColumn("there", F.count(F.lit(1)).over(whole)).where("there = len")
    rows = rows.withColumn("rank", F.row_number().over(whole.orderBy("n", "term", "off")))
    return shared_table(rows.select("phrase", "len", "off", "term", "rank"), "phrase_terms")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Written (phrase, len, k1, k2, start) of each occurrence of ``phrases`` (phrase: key, words: distinct arrays)."""
    terms = phrase_terms(phrases, index)
    place = [*DOC, "pos", "term"]

    def adjusted(found: DataFrame, ranks: str) -> DataFrame:
        """Where the terms of ``ranks`` have to stand for the starts found."""
        more = terms.where(ranks).select("phrase", "off", "term")
        return found.join(more, "phrase").select("phrase", "len", *DOC, "start", (F.col("start") + F.col("off")).alias("pos"), "term")

    def postings(rank: int) -> DataFrame:
        """Postings of the terms that have ``rank`` in some phrase: no longer lists than the vocabulary's rarer ones.
        The terms are written, so that Spark knows how few they are before it plans to move the index."""
        names = shared_table(terms.where(F.col("rank") == rank).select("term").distinct(), "ranked_terms")
        return index.join(names, "term", "left_semi")

    first = terms.where("rank = 1").select("phrase", "len", "off", "term")
    found = postings(1).join(first, "term").select("phrase", "len", *DOC, (F.col("pos") - F.col("off")).alias("start")).where("start >= 0").distinct()
    found = shared_table(found, "rarest")
    second = postings(2)
    both = adjusted(found, "rank = 2").join(second, place, "left_semi").select("phrase", "len", *DOC, "start")
    both = shared_table(both.unionAll(found.where("len = 1")), "intersected")
    # the other lists, which hold the frequent terms: one shuffle of the postings by place
    whole = adjusted(both, "rank > 2").join(index, place, "left_semi").groupBy("phrase", "len", *DOC, "start").agg(
        F.count(F.lit(1)).alias("n")).where("n = len - 2").drop("n")
    return shared_table(whole.unionAll(both.where("len <= 2")), "matches")


def proximity_matches(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair, k1, k2, pos_a, pos_b) for ``pairs`` (pair, a, b, most): terms at most ``most`` (at least 1) words apart,
    in either order. Positions meet by blocks of ``most`` words, and a block's neighbours."""
    block = lambda c: F.floor(F.col(c) / F.col("most"))
    a = index.join(pairs.select("pair", F.col("a").alias("term"), "most"), "term").select("pair", "most", *DOC, F.col("pos").alias("pos_a"))
    a = a.withColumn("block", F.explode(F.array(*[block("pos_a") + k for k in (-1, 0, 1)])))
    b = index.join(pairs.select("pair", F.col("b").alias("term"), "most"), "term").select("pair", "most", *DOC, F.col("pos").alias("pos_b"))
    b = b.withColumn("block", block("pos_b")).drop("most")
    return a.join(b, ["pair", *DOC, "block"]).where("abs(pos_a - pos_b) <= most and pos_a <> pos_b").select(
        "pair", *DOC, "pos_a", "pos_b").distinct()


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: id (bigint), k1, k2, n_words, n_hit (words inside occurrences of windows), n_items and items
    (those whose windows occur, as text, sorted), contaminated (a twentieth of the words hit, and one at least)."""
    runs = windows(items, item_col, item_text, width).select("item", "words", F.unhex(F.md5(F.array_join("words", " "))).alias("phrase"))
    runs = shared_table(runs, "windows")
    phrases = runs.select("phrase", "words").distinct()
    vocabulary = shared_table(phrases.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    index = build_index(docs, id_col, text_col, vocabulary)
    found = phrase_matches(index, phrases)
    # words covered: each occurrence adds what lies beyond the furthest end so far
    before = Window.partitionBy(*DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy(*DOC, "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    spans = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = spans.groupBy(*DOC).agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).cast("long").alias("n_hit"))
    owners = runs.where("item is not null").select("phrase", F.col("item").cast("string").alias("item")).distinct()
    named = found.select("phrase", *DOC).distinct().join(owners, "phrase").groupBy(*DOC).agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = shared_table(hits.join(named, DOC, "left"), "overlaps")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rows = index.where(F.col("term") == END).select(*DOC, F.col("pos").cast("long").alias("n_words"))
    return rows.join(found, DOC, "left").select(
        F.nullif("k1", F.lit(NO_ID)).alias(id_col), *DOC, "n_words", zero(F.col("n_hit")).alias("n_hit"),
        zero(F.size(F.coalesce("items", F.array()))).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def clean_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    found = report(docs, items, id_col, text_col, width=width)
    bad = shared_table(found.where("contaminated").select(*DOC).distinct(), "contaminated")
    a, b = fresh("k1", docs), fresh("k2", docs)
    keys = [c.alias(n) for c, n in zip(doc_keys(id_col, text_col), (a, b))]
    rows = docs.select("*", *keys)
    bad = bad.toDF("_bad1", "_bad2")
    return rows.join(bad, (rows[a] == bad["_bad1"]) & (rows[b] == bad["_bad2"]), "left_anti").select(*[quoted(c) for c in docs.columns])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return report(docs, items).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
