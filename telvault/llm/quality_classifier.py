"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates.

Tokens are words and runs of punctuation, as written. Features are the tokens,
their outline (upper case, lower case, digits, signs) and runs of two and three
tokens, and a token that follows itself; the value is the root of the feature's share, so texts of all lengths
compare. A score is the sparse dot product with the broadcast weights.

Defined results: null and empty texts get the score of the bias alone; repeated
rows repeat; ids and labels that are null are not learned from; without labelled
rows every score is 0.5; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.common import crc32_text
from telvault.llm.ftrl import TOKEN, Features, Model, Rates, learn

TRAIN_ROWS = 12_000  # bound of the labelled rows that are learned from
THRESHOLD = 0.7


def outline(token: str) -> str:
    """Kind of a token: its case and whether it has letters, digits or signs, and a bound of its length."""
    case = "U" if token.isupper() else "l" if token.islower() else "T" if token.istitle() else "d" if token.isdigit() else "s"
    return f"{case}{min(len(token).bit_length(), 5)}"


def forms(token: str) -> tuple[str, ...]:
    return token.lower(), outline(token)


FEATURES = Features(TOKEN.findall, forms, ((1,), (1, 2)), share=True)
RATES = Rates(alpha=5.0, l1=0.1, l2=0.0, epochs=4)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", most: int = TRAIN_ROWS) -> Model:
    return learn(docs, labels.select(id_col, label_col), id_col, text_col, FEATURES, RATES, most)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = crc32_text(F.col("doc_id")) % 4 == 2
    model = fit_quality(docs, labels.where(~held_out))
    return model.score(docs, ["doc_id"], "text").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
