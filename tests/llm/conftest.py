import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, size long, __lang string, a long, word string"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, equal texts, clashing column names."""
    rows = [
        (1, "The cat sat on the mat and the dog ran away quickly today.", "en", "s1"), (2, "The cat sat on the mat and the dog ran away quickly today.", "en", "s1"), (2, "The cat sat on the mat and the dog ran away quickly today.", "en", "s1"),
        (3, None, "en", "s2"), (4, "", None, "s2"), (5, " \n\t ", "en", None), (6, LONG, "la", "s3"), (None, "ohne id aber mit einem text der lang genug ist", "de", "s3"), (7, "1234 5678 !!", None, None),
        (8, "Der Hund und die Katze sind nicht im Haus, sondern im Garten.", "de", "s1"), (9, "x", "en", "s4"), (10, "schön schön SCHÖN é", "de", "s4"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "f", 1, "l", 2, "w") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
