import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows and columns whose names could clash."""
    long = prose(1, 30_000)
    rows = [
        (0, prose(2, 120), "en", "s1"),
        (1, None, "en", "s1"),
        (2, "", None, None),
        (3, " \t\n ", "fr", "s2"),
        (4, "one", "en", "s2"),
        (5, "One  two\tthree", "en", "s2"),
        (6, "one two three", "en", None),
        (7, long, "en", "s1"),
        (8, long.replace(" ", "\n"), "en", "s1"),
        (9, prose(2, 120), "de", "s3"),
        (10, prose(2, 120) + " end", "de", "s3"),
        (10, prose(2, 120) + " end", "de", "s3"),
        (11, "äöü ß € 𝄞 12 34", "de", "s3"),
        (12, prose(3, 60), "en", "s4"),
        (None, prose(4, 60), "en", "s4"),
        (None, prose(4, 60), "en", "s4"),
        (13, prose(4, 60), None, "s4"),
        (14, "12 34 !!", "en", "s4"),
    ]
    extra = {"size": 1, "kept": 2, "row": 3, "id": 4, "pos": 5, "key": 6, "class": 7, "_task": 8, "root": 9, "score": 10, "u": 11, "sha": 12, "kept_id": 13, "first_id": 14, "mix_id": 15, "copies": 16}
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{k}` int" for k in extra)
    return spark.createDataFrame([(*r, *extra.values()) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
