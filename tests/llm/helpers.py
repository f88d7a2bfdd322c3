"""Small tables with nulls, empty and long texts, ties, repeats and extra
columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, word string, rank int"
PROSE = ("the river runs past old stone mills while children watch boats drift slowly toward a distant harbour where "
         "sailors mend nets under fading light and merchants count silver coins before supper").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + r.choice("abcdefgh") + r.choice(["", "", "s", "ed"]) for _ in range(n))


def doc(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.5, "x", 1)


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd_rows():
    """One of everything that is unusual."""
    return [doc(None, "A text whose id is missing, with seven words."), doc(1, None), doc(2, ""), doc(3, "   \n\t "),
            doc(4, "one"), doc(4, "one"), doc(5, prose(1, 40)), doc(5, prose(2, 40)), doc(6, prose(3, 30_000)),
            doc(7, "x" * 50_000), doc(8, "Ünïcode 文字 \U0001f600 ́ İ."), doc(9, prose(4, 60), None, None),
            doc(10, "\x00 control \x1f bytes \r\n and   more words here")]
