from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "Ein langer Satz über Bäume und Häuser. " * 4000


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long and repeated texts, ties and awkward characters."""
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One TWO three four five six",
        "one two three four five six",
        "à la carte ÀÉ ½ ² 日本語テキスト 🎉",
        "İstanbul ſtraße K",
        LONG,
        LONG + "Ende.",
        "no letters: 12345 -- 67",
        "\x00 null byte \x1f",
        "one two three four five six",
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from texts; ``extra`` columns have names that operators use themselves."""

    def make(texts, first_id=0, extra=False):
        rows = [
            (i + first_id, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)
        ]
        df = spark.createDataFrame(rows, DOCUMENT)
        if extra:
            for name in ("key", "label", "bands", "bucket", "n_words", "spans", "quality", "ids", "slot"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
