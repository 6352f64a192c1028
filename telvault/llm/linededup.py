"""Line deduplication by levelled sorted runs of line hashes, in DataFrame functions only.

``Runs`` holds the hashes of all lines met so far as sorted runs: tables
bucketed and sorted by the hash, so a merge join with a run moves and sorts
nothing on the run's side. ``add`` takes one batch of hashed lines: its distinct
hashes are merge-anti-joined with every run, what is left is new and becomes a
run of level 0; hashes that a run already holds are set down as repeats. Once a
level has ``fanout`` runs they are compacted into one of the next level, so there
are few runs at any time, and a hash is rewritten once a level. No two runs share
a hash.

``common_lines`` feeds a whole table in batches, from the largest ids to the
smallest, so that the batch which first holds a line has its largest id.
``without_common_lines`` then drops the lines of documents that are not the last
holder. A line is known by two 64-bit hashes of different seeds.

Only hashes move: texts are shuffled once, with the positions that each loses.
Distinct (line, document) pairs are formed by a shuffle on both, and summed to
one row a line and task before the shuffle on lines, so that a line which a third
of all documents hold reaches no task as raw rows. Lines meet the common ones in
a join of two written tables, which AQE splits.

Ids are integers. Defined results: a null or empty text is one empty line; rows
of equal id and text are one document, counted once, with equal results; a null
id is smaller than any other, and null ids are one id; a document that loses all
lines keeps an empty text; an empty table gives no rows; further columns are
dropped (``without_common_lines``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.common import quoted, shared_path, shared_table
from telvault.llm.decontamination import DOC, NO_ID, doc_keys, lower_az

LEAST_CHARS, LEAST_DOCS = 40, 5
BATCHES = 4  # that a table is fed in
FANOUT = 3  # runs of a level that are compacted into one of the next
BLANK = " \t\n\x0b\f\r"
KEY = ["h1", "h2"]


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(k1, k2, pos, h1, h2) of each line whose key has ``least_chars`` code points."""
    lines = docs.select(*doc_keys(id_col, text_col), F.posexplode(F.split(F.coalesce(quoted(text_col), F.lit("")), "\n")).alias("pos", "line"))
    lines = lines.select(*DOC, "pos", F.btrim("line", F.lit(BLANK)).alias("key")).where(F.char_length("key") >= least_chars)
    lines = lines.select(*DOC, "pos", lower_az(F.col("key")).alias("key"))
    return lines.select(*DOC, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


class Runs:
    """Levelled sorted runs of (h1, h2, n, top): a line, the documents of the batch that first held it, and the largest
    id among them. ``levels`` lists each level's runs, by table name."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.repeats: list[DataFrame] = []
        # a bucket is one sorted file: with this a merge join reads it as it is
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def write(self, rows: DataFrame) -> str:
        """A sorted run: as many buckets as a shuffle has partitions, one file each."""
        name = f"llm_run_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, *KEY).write.format("parquet").option("path", shared_path(self.spark, "run"))
         .bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name))
        return name

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take a batch of ``hashed_lines``; returns the run of those that no earlier batch held."""
        own = (lines.select(*KEY, *DOC).distinct().groupBy(*KEY)
               .agg(F.count(F.lit(1)).alias("n"), F.max("k1").alias("top")))
        name, held = self.write(own), self.tables()
        if held:
            own = new = self.spark.table(name)
            for run in held:
                new = new.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
            name = self.write(new)
            again = own.join(self.spark.table(name).select(*KEY).hint("merge"), KEY, "left_anti")
            self.repeats.append(shared_table(again.select(*KEY, "n"), "repeats"))
        self.levels[0].append(name)
        new = self.spark.table(name)
        self.compact()
        return new

    def compact(self) -> None:
        """Merge the runs of every full level into one run of the next. They share no line, so rows only come together."""
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                rows = self.spark.table(level[0])
                for name in level[1:]:
                    rows = rows.unionAll(self.spark.table(name))
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self.write(rows))
                self.levels[k] = []

    def totals(self) -> DataFrame:
        """(h1, h2, n, top) of every line, n over all batches: each run merged with the repeats."""
        if not self.tables():
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint, n bigint, top bigint")
        repeats = None
        for r in self.repeats:
            repeats = r if repeats is None else repeats.unionAll(r)
        out = None
        if repeats is not None:
            repeats = self.spark.table(self.write(repeats.groupBy(*KEY).agg(F.sum("n").alias("more"))))
        for run in self.tables():
            if repeats is not None:
                run = run.join(repeats.hint("merge"), KEY, "left").select(*KEY, (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), "top")
            out = run if out is None else out.unionAll(run)
        return out


def batch_number(docs: DataFrame, id_col: str, batches: int) -> Column:
    """0 for the rows with the largest ids, up to ``batches`` - 1, about equal in number. Equal ids share a batch."""
    shares = [k / batches for k in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(quoted(id_col).cast("bigint"), shares, 10_000)).first()[0] if shares else None
    return sum(((F.col("k1") <= F.lit(c)).cast("int") for c in cuts or ()), F.lit(0))


def common_lines(lines: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Written (h1, h2, top) of the ``lines`` (hashed, with their batch) that ``least_docs`` documents hold, and the largest
    id holding them."""
    runs = Runs(lines.sparkSession, fanout)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k))
    return shared_table(runs.totals().where(F.col("n") >= least_docs).select(*KEY, "top"), "common_lines")


def without_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                         least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id bigint, n_lines, n_dropped, text) per row: the text without the common lines that a larger id keeps."""
    number = batch_number(docs, id_col, batches)
    lines = shared_table(hashed_lines(docs, id_col, text_col, least_chars).withColumn("batch", number), "lines", "batch")
    common = common_lines(lines, batches, fanout, least_docs)
    # written tables on both sides: AQE splits a line that a third of all documents hold
    lost = lines.join(common, KEY).where("k1 <> top").select(*DOC, "pos")
    lost = shared_table(lost.groupBy(*DOC).agg(F.collect_set("pos").alias("lost")), "lost")
    rows = docs.select(*doc_keys(id_col, text_col), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    rows = rows.join(lost, DOC, "left").select("k1", "text", "lost", F.split("text", "\n").alias("lines"))
    n = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("lost"))
    text = F.when(F.col("lost").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return rows.select(F.nullif("k1", F.lit(NO_ID)).alias(id_col), n.cast("long").alias("n_lines"),
                       F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
