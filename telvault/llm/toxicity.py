"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words, their first four to seven characters (inflected
forms share weights), its word pairs, and pairs with one or two words between.
Each counts once per text, so a single abusive word weighs the same in a long
text as in a short one. L1 leaves a few thousand weights, which are broadcast.

Defined results: null and empty texts get the score of the bias alone; repeated
rows repeat; ids and labels that are null are not learned from; without labelled
rows every score is 0.5; further columns are dropped (``score``) or kept (``clean``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.common import crc32_text, fresh, quoted
from telvault.llm.ftrl import WORD, Features, Model, Rates, learn

TRAIN_ROWS = 12_000  # bound of the labelled rows that are learned from
THRESHOLD = 0.7


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def forms(word: str) -> tuple[str, ...]:
    return word, word[:4], word[:5], word[:6], word[:7]


FEATURES = Features(words, forms, ((1,), (2,), (3,)), share=False)
RATES = Rates(alpha=1.0, l1=20.0, l2=0.0, epochs=3)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", most: int = TRAIN_ROWS) -> Model:
    return learn(docs, labels.select(id_col, label_col), id_col, text_col, FEATURES, RATES, most)


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns."""
    score = fresh("_score", docs)
    return model.score(docs, docs.columns, text_col, score).where(quoted(score) < threshold).drop(score)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = crc32_text(F.col("doc_id")) % 3 == 1
    model = fit_toxicity(docs, labels.where(~held_out))
    return model.score(docs, ["doc_id"], "text").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
