"""Small tables for the text operators."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that a table may bring along and that must not disturb an operator.
EXTRA = ", size long, label string, score double, key string, n long, a long, place int, content string"
EXTRA_VALUES = (1, "x", 0.5, "k", 2, 3, 4, "c")


def words(rng: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(frame, rows, extra=False):
    """frame(...) of (doc_id, text[, source]); ``extra`` adds columns with common names."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) + (EXTRA_VALUES if extra else ())
        for r in rows
    ]
    return frame(DOCUMENTS + (EXTRA if extra else ""), *full)


ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "two words",
    "a b c d",
    "A b C d",
    "  a\tb\nc\x0bd ",
    "é\u00a0ö 漢字 \U0001f600 x",
    "\\ < | <|end|>\n \\s \\l",
]
