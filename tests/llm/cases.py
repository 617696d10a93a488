"""Small documents with the cases that every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega äther öl über".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def documents(spark, seed=3, count=40):
    """Nulls in any column, empty, blank and long texts, exact and near copies, repeated rows and ids, and columns
    whose names clash with the operators' own."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(count)]
    texts += [None, "", "  \n\t ", "one", "two words", texts[0], texts[0], texts[1].upper()]
    near = texts[2].split()
    for k in range(4):
        own = list(near)
        if own:
            own[k % len(own)] = "changed"
        texts.append(" ".join(own))
    texts.append(prose(rng, 6000))
    texts.append("same " * 400)
    shared = prose(rng, 60)
    texts += [prose(rng, 20) + " " + shared + " " + prose(rng, 20) for _ in range(5)]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "a", "b", None]), len(t or ""), 0.5, "k", 1) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (7, "another text under a taken id " + prose(rng, 30), "en", "a", None, None, None, None), (None, prose(rng, 30), None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
