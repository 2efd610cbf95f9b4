"""Small documents with awkward cases, for all operators of the subpackage."""

import random

LINES = ["Plain words in a line", "THE SAME LINE", "a | b | c", "x\t y\x0b z ### $$$", "Ünï çödé ß Σ"]


def texts(seed: int = 7, n: int = 40) -> list[str | None]:
    rng = random.Random(seed)
    words = "the and a of idiot Thereon, onandthe. ßüä été 12 3.5 don't <|endoftext|> ||| 文字 😀".split()
    made: list[str | None] = [None, "", " ", "\n\n", "one", "one two", "One Two", "ONE TWO\n"]
    made += ["same same same same same same same same", "a b c d e f a b c d e f a b c d e f"]
    for _ in range(n):
        parts = [
            " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
            + rng.choice(["\n", " ", "\n\n", "  "])
            + rng.choice(LINES)
            for _ in range(rng.randint(1, 6))
        ]
        made.append("\n".join(parts))
    made += [made[12].upper(), made[12].lower(), made[13], made[13]]
    made.append("long " * 30_000)
    made.append("x" * 50_000)
    made.append("\n".join(["repeated line of words", "another one here"] * 400))
    return made


def rows(seed: int = 7, n: int = 40) -> list[tuple]:
    found = [(i, t) for i, t in enumerate(texts(seed, n))]
    found.append((None, "without id"))
    found.append((5, "one two"))
    found.append(found[20])
    return found


def frame(spark, made=None):
    return spark.createDataFrame(rows() if made is None else made, "doc_id long, text string")


def clashing(spark):
    """The same documents with extra columns, some named like results."""
    return frame(spark).selectExpr(
        "doc_id", "text", "'x' AS lang", "1 AS SCORE", "2 AS kept", "'y' AS spans", "3 AS n_tokens",
        "4 AS n_words", "5 AS fingerprint", "6 AS piece", "7 AS predicted", "8 AS _id",
    )
