"""Small documents used by the operator tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729) % 5003}" for i in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeats."""
    a = prose(1, 120)
    return [(1, a, "en", "s1", 3), (2, a, "en", "s1", 3), (3, a.upper(), "de", None, None), (4, None, "en", "s2", 0),
            (5, "", None, "s2", 0), (6, " \n\t ", "fr", "s2", 3), (7, prose(2, 60) + " " + a, "en", "s1", 9),
            (8, prose(3, 9000), "en", "s3", 1), (8, prose(3, 9000), "en", "s3", 1), (9, "x", "en", "s3", 1),
            (10, a + " extra words", "en", "s1", 3), (None, "no id here", "en", "s1", 4)]
