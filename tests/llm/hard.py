"""A small table that holds the awkward cases, for all text operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, h int, component_id int, n_tokens string, kept string, place int"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows():
    """Null ids and texts, empty and blank texts, one word, repeated rows, equal texts, a very long text, odd characters."""
    rng = random.Random(5)
    long_, base = sentence(rng, 30_000), sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r"), (7, "word"), (8, "Two words"),
        (None, base), (None, None), (9, long_), (10, long_[1000:9000]), (11, "12 34 %% --"), (12, "ÄÖ ß   日本 \U0001f642 <|endoftext|> I'll"),
        (13, "x " * 400), (13, "x " * 400), (14, sentence(rng, 40) + "\n" + base), (15, "a\nb\na\n\nb\n"),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None, None, 0.5, "k", 1, 2, "n", "yes", 3) for k, (i, t) in enumerate(texts)]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
