"""Tables with the awkward cases that every operator has to stand."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, token int, id string, n int, host string, __keep boolean"

BASE = " ".join(f"word{i}" for i in range(60))


def documents(spark, more=()):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns whose names operators use."""
    rows = [
        (1, BASE, "en", "s1"),
        (2, BASE, "en", "s2"),
        (2, BASE, "en", "s2"),
        (3, BASE + " more", "en", None),
        (4, None, None, "s1"),
        (5, "", "en", "s1"),
        (6, " \n\t ", "en", "s3"),
        (7, "Two words", "en", "s3"),
        (8, "two WORDS", None, None),
        (9, "x " * 30_000, "en", "s1"),
        (None, BASE + " other", "en", "s1"),
        (10, "été\u2028ß <|endoftext|> 'll don't\x00\x0b1½²", "fr", "\U0001f600"),
        *more,
    ]
    full = [(*r, None if r[1] is None else len(r[1]), "s", 1, "i", 2, "h", True) for r in rows]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


VECTORS = "vec_id long, embedding array<float>, score double, rank int, query_id long"


def vectors(spark, n=300, dim=6, seed=1):
    import random

    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n, None), (n + 20, [1.0, None] + [0.0] * (dim - 2)), (n + 40, [float("nan")] * dim), (n + 60, [float("inf")] + [0.0] * (dim - 1)), (n + 100, [0.0] * dim), (None, [1.0] * dim)]
    rows += [rows[3], rows[3], (n + 200, rows[7][1]), (n + 201, rows[7][1])]
    return spark.createDataFrame([(*r, 0.0, 1, 2) for r in rows], VECTORS)
