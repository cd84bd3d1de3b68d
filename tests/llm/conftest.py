import pytest


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""
    def build(rows, lang="en"):
        full = [(i, t, lang if t is None or not isinstance(lang, dict) else lang.get(i), "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return build


def prose(rng, n, syllables=("an", "er", "th", "on", "re", "ha", "ti", "es", "or", "wh", "ou", "ing", "ed")):
    """``n`` made-up words."""
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.integers(2, 5))) for _ in range(n))
