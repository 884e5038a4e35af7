"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names an operator might use itself.
CLASHES = ["_id", "_text", "kept", "score", "count", "key", "pack", "_fp", "rank", "node", "a", "u", "page", "n", "_units", "best", "size"]
WORDS = {
    "en": "the and of with from that house river stone light walking under over between morning evening".split(),
    "de": "der die das und nicht über zwischen straße häuser fluss stein licht gehen unter morgen abend".split(),
    "fr": "le la les et avec dans maison rivière pierre lumière marcher sous entre matin soir être".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def documents(rng: random.Random, n: int = 60) -> list[tuple]:
    """Rows of ``SCHEMA``: prose, copies, near copies, blanks-only differences, empty, null and long texts, null ids and labels."""
    rows: list[tuple] = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        text = sentence(rng, lang, rng.randint(5, 60))
        if rows and rng.random() < 0.35:
            text, lang = rng.choice([(r[1], r[2]) for r in rows if r[1] is not None])
            text = rng.choice([text, text + "  ", text.replace(" ", "\n", 2), text + " extra"])
        rows.append((i * 3, text, None if rng.random() < 0.1 else lang, rng.choice(["s", None]), len(text)))
    rows += [(1000, None, "en", "s", None), (1001, "", None, "s", 0), (1002, " \t\n", "en", None, 3), (1003, sentence(rng, "en", 5000), "en", "s", 9), (1004, "12345 !!", "de", "s", 8), (1005, "日本語 😀 ▁x <|endoftext|>", None, None, 1)]
    rows += [rows[0], rows[1], (None, "nobody knows this number of it", "en", "s", 1), (None, rows[2][1], "en", "s", 1)]
    rng.shuffle(rows)
    return rows


def clashing(df):
    """The table with further columns named like an operator's own."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
