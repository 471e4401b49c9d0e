import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, length string, host int, token long, rank string"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(i, t, lang, "s", len(t or ""), "x", "y", 1, 2, "z") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(("ka", "lo", "mi", "ter", "sun", "do")) + rng.choice(("ra", "ven", "stil", "po", "x")) + str(rng.randrange(50)) for _ in range(words))


EDGE = [
    (1, "Hello world, it's we'll fine.. and 123 more!", "en"), (2, None, "en"), (3, "", None), (4, "word " * 20_000, "en"),
    (5, "Same text twice over here now", "en"), (5, "Same text twice over here now", "en"), (6, "Same text twice over here now", "en"),
    (None, "nobody's text", "en"), (None, None, None), (8, "x" * 60_000, None), (9, "  spaces\n\n\tand   more \x0b\xa0 rare　", "en"),
    (10, "naïve Ça ǅ İ <|endoftext|> 日本語 テキスト 😀 <s> ▁ ́a", "fr"), (11, " ", "en"), (12, "\n", "en"), (13, "<|ENDOFTEXT|> q", "en"), (14, "one", "en"),
]
