"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, and clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import SparkSession

TABLES = "/root/testdata/sf0.001"
TEXT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, `row` int, token long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "ka lo mi ne tu ra si po ve du".split()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(seed: int, n: int) -> str:
    random_ = random.Random(seed)
    return " ".join("".join(random_.choices(SYLLABLES, k=random_.randint(1, 4))) for _ in range(n))


def texts() -> list[str | None]:
    base = prose(1, 120)
    changed = base.split()
    changed[60] = "changed"
    return [
        base,
        base,
        " ".join(changed),
        base + " " + prose(2, 10),
        None,
        "",
        " \n\t ",
        "one two",
        "One TWO",
        "1234 5678 !!",
        "é" * 99 + "ß" * 120,
        "ab" * 4000,
        prose(3, 20_000),
        "line one here\nline one here\n\nother\x0bline\x1cend\u2003x",
        'password = "hunter2hunter2" and token: ab AKIA' + "Q" * 16 + " " + "0123456789abcdef" * 2,
        "nul\x00byte \U0001f600 " * 30,
    ]


def rows() -> list[tuple]:
    out = []
    for i, text in enumerate(texts()):
        lang = (None, "aa", "bb")[i % 3]
        source = (None, "s1", "s2", "s1")[i % 4]
        out.append((i, text, lang, source, None if text is None else len(text), 0.5, "x", 1, 7))
    out.append((3, texts()[3], "aa", "s1", 1, 0.5, "x", 1, 7))
    out.append((None, texts()[0], None, None, None, None, None, None, None))
    return out


def edge_documents(spark: SparkSession):
    return spark.createDataFrame(rows(), TEXT_SCHEMA)


def no_documents(spark: SparkSession):
    return spark.createDataFrame([], TEXT_SCHEMA)


def null_documents(spark: SparkSession):
    return spark.createDataFrame([(None,) * 9] * 3, TEXT_SCHEMA)


def documents(spark: SparkSession):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def components(nodes, links) -> dict:
    """Least node of every component, by brute force."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
