"""Small tables with the awkward cases that every operator defines."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, key int, component_id bigint"

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of violet fog "
         "and nobody in the village notices that the moon has turned green again").split()


def prose(k: int, n: int = 24) -> str:
    """A line of n words, different for each k."""
    rng = random.Random(k)
    return " ".join(rng.choice(PROSE) + rng.choice("abcdefghij") for _ in range(n))


def doc(i, text, lang="en", source="s0", n_chars=0):
    return (i, text, lang, source, n_chars if text is None else len(text), "clash", 1, -1)


def awkward() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, a null id, one very long text."""
    return [
        doc(1, prose(1)), doc(2, None), doc(3, ""), doc(4, " \t\n \v"), doc(5, prose(5)), doc(5, prose(5)),
        doc(None, prose(9)), doc(6, prose(1), None, None), doc(7, "word " * 400_000), doc(8, "x" * 300_000),
        doc(9, "12 34 !!"), (10, "ünï cödé 東京 ☃", None, "", None, None, None, None),
    ]


def frame(spark, rows, schema=DOC_SCHEMA):
    return spark.createDataFrame(rows, schema)


def write(spark, folder, **tables) -> str:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
