"""Small inputs that the tests of the text operators share."""
import random

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use themselves, and one that none does
CLASHES = "doc_id bigint, text string, lang string, source string, row_id string, size string, kept string, shard int, extra int"


def documents(spark, rows, parts=3):
    """Rows of (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENT).repartition(parts)


def clashing(spark, rows):
    return spark.createDataFrame([(r[0], r[1], "en", "s", "a", "b", "c", 1, 2) for r in rows], CLASHES)


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "x " * 3000), (905, "Ünïcode ß 中文 🎉 \u0085 \x1c end"),
       (906, "same text here"), (907, "SAME TEXT HERE"), (907, "SAME TEXT HERE"), (None, "same text here")]
