"""Small tables with the awkward rows every operator has to take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, size string, queue string, fp string, kept string, _doc string, words string"


def documents(spark, rows):
    """rows: (doc_id, text, source) or (doc_id, text, source, lang); other columns clash on purpose."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2], len(r[1] or ""), *"abcdefg") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def awkward(seed=1, n=60):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(1, 120)), rng.choice(["a", "b", "c", None])) for i in range(n)]
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, " \t\n", None), (n + 3, " é ß 日本 \U0001f600", "c")]
    rows += [(n + 4, words(rng, 20_000), "a"), (n + 5, "x" * 50_000, "b"), (None, "no id", "a"), (None, None, None)]
    rows += [rows[3], rows[3], (rows[4][0], "same id, other text", "c"), (n + 6, rows[5][1], "b"), (n + 7, rows[5][1].replace(" ", " \n\t", 1), "a")]
    return rows


def collected(df):
    return [tuple(r) for r in df.collect()]
