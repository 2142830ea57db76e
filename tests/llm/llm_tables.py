"""Small tables with every awkward row: NULLs, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

VOWELS = {"en": "aeiou", "fr": "éèàou", "de": "äöüei"}


def sentence(rng: random.Random, lang: str = "en", words: int = 40) -> str:
    syllables = [c + v for c in "bdfglmnprst" for v in VOWELS[lang]]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def awkward(rng: random.Random) -> list[tuple]:
    """Rows of documents without the plain ones."""
    text = sentence(rng)
    return [
        (None, text, "en", "a", 1),
        (901, None, "en", "a", None),
        (902, "", None, None, 0),
        (903, "", "en", None, 0),
        (904, "!!! ... ???", "en", "a", 3),
        (905, "one two", "en", "b", 7),
        (906, text, "en", "a", 5),
        (907, text, "en", "a", 5),
        (907, text, "en", "a", 5),
        (908, sentence(rng, words=30_000), "en", "b", 9),
        (909, "x" * 300_000, "fr", "b", 9),
        (None, None, None, None, None),
    ]


def documents(rng: random.Random, plain: int = 60) -> list[tuple]:
    rows = [(i, sentence(rng, rng.choice("en fr de".split())), "en", rng.choice("abc"), 1) for i in range(plain)]
    return rows + awkward(rng)
