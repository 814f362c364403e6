"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, text_key long, fingerprint string, size long, score double, label int, key string, copies int"
)
LOWER = {65 + i: 97 + i for i in range(26)}


def words(rng, n, vocabulary=400):
    return [f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(n)]


def awkward_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        lines = [" ".join(words(rng, rng.randint(1, 30))) for _ in range(rng.randint(1, 5))]
        rows.append((i, "\n".join(lines), ["a", "b", "Ω", "z", None][i % 5]))
    base = rows[3][1]
    rows += [
        (100, base, "a"),
        (101, base.replace("w1 ", "W1 ", 1), "b"),
        (102, base + " changed", None),
        (102, base + " changed", None),
        (None, base, "a"),
        (None, base, "a"),
        (None, None, None),
        (103, None, "b"),
        (104, "", "a"),
        (105, "   \n\t\x0b ", "c"),
        (106, "word", "a"),
        (106, "other text of the same id", "a"),
        (107, "ÀÉ ß İ Σ ΑΣ ασ   x　y", "c"),
        (108, " ".join(words(rng, 60_000)), "long"),
        (109, "same\nsame\nsame line here\nsame line here", "c"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), "x", 7, "f", -1, 0.5, 3, "k", 2) for i, t, s in rows]


def awkward(spark, seed=1):
    return spark.createDataFrame(awkward_rows(seed), SCHEMA).repartition(5)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
