import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice(["ba", "ko", "ri", "tu", "né", "Zo", "ö"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def texts(words):
    """Empty, blank, very long, repeated and near-equal texts, odd white space and characters."""
    rng = random.Random(5)
    plain = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    near = plain[7].split()
    near[3:4] = ["swapped"]
    return [None, "", "   \n\t ", "one", "one two", "ONE two\x1cthree", "  a  b \n\n c ", *plain, plain[0], plain[0], plain[1], " ".join(near),
            long, "x" * 100_000, "漢字 かな 𝔘𝔫𝔦 😀 é", plain[2] + "\n" + plain[2] + "\n" + plain[2], "### $$$ " * 40, "a\x00b   c\xa0d"]


@pytest.fixture(scope="session")
def messy(spark, texts):
    """Documents with null and repeated ids, whole rows that repeat, and columns whose names the operators use themselves."""
    extra = "fp bigint, k1 string, pos int, score double, label int, id string, shard int, lines string, _row int, t string, c0 string, h int, `Text ` string, `meta.x` string, `back``tick` string, line string, rank int, _w1 int"
    n = len(extra.split(","))
    rows = [(k, t, None if k % 5 == 0 else "en" if k % 2 else "fr", "src0", len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, None, None, None, None), (None, texts[9], "en", None, 1), (None, "a text without an id", "en", None, 1),
             (9, texts[9], "en", "src0", 1), (9, texts[9], "en", "src0", 1), (9, "another text with the same id", "fr", "src0", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + extra
    return spark.createDataFrame([r + (None,) * n for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("false")
