import pytest

# Names that clash with columns the operators make themselves.
CLASHING = "anchor mark component n_words spans score shingle counts places chunk left right rule keys edits rank".split()


@pytest.fixture(scope="session")
def image_rows(spark):
    """Image rows out of (im_id, im_description), with further columns of clashing names."""

    def make(rows, kind="bigint"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, f"im_id {kind}, im_description string")
        return df.select("*", *[F.lit("x").alias(name) for name in CLASHING])

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty, blank, one-word, repeated and very long texts, repeated and NULL ids."""
    import random

    chance = random.Random(5)
    words = [f"w{n}" for n in range(400)] + ["É", "naïve", "日本語", "ﬁ", "Ⅷ"]
    long = " ".join(chance.choice(words) for _ in range(30_000))
    passage = " ".join(f"Passage{n}" for n in range(40))
    body = [" ".join(chance.choice(words) for _ in range(60)) for _ in range(8)]
    return [
        (1, body[0]),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, "word"),
        (6, "word"),
        (7, "WORD"),
        (8, long),
        (9, long + " tail"),
        (10, body[0]),
        (10, body[0]),
        (11, body[1] + " " + passage),
        (12, passage + "\n" + body[2]),
        (13, body[3] + " " + passage + " " + body[4]),
        (14, body[1] + " " + passage.replace("Passage3 ", "Other ")),
        (14, body[5]),
        (15, body[5] + " end"),
        (None, body[5]),
        (None, None),
        (16, "a b c d \x1cx é é"),
        (17, passage),
        (-3, passage.upper()),
    ]
