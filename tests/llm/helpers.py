"""Small tables with every awkward case, and plain restatements of what the operators promise."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

LOWER_CASE = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, e int, h string, n int, family int, src int, tokens int, key string"


def prose(n: int, seed: int, words: int = 400) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgéñ") for _ in range(r.randint(1, 7))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def edge_texts() -> list[str | None]:
    a, b = prose(120, 1), prose(90, 2)
    passage = prose(40, 3)
    return [
        None, "", " ", "\n\n", "a", "é", "a b", "12 34", "a b c", "A B C", a, a, a, a.upper(), a.replace(" ", "  ", 3),
        a + " more words at the end", b, b + " " + passage, passage + " " + a, passage, "x" * 500, "x" * 380, "ab " * 300,
        passage + "\n" + passage, "".join(chr(c) for c in range(1, 64)) + "　\xa0 \u2028z", prose(4000, 4) + passage,
    ]


def edge_docs(spark: SparkSession) -> DataFrame:
    """Ids out of order, one null id, one id on two texts, one row twice; other columns have the names operators use inside."""
    rows = []
    for i, text in enumerate(edge_texts()):
        lang = [None, "en", "fr"][i % 3]
        rows.append((1000 - 7 * i, text, lang, ["s0", "s0", None, "s1"][i % 4], None, i, i, "h", i, i, i, i, "k"))
    rows.append((None, prose(60, 5), "en", "s0", 1, 0, 0, "h", 0, 0, 0, 0, "k"))
    rows.append((1000 - 7 * 16, prose(70, 6), "en", "s0", 1, 0, 0, "h", 0, 0, 0, 0, "k"))
    rows.append(rows[17])
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def given(docs: DataFrame) -> list[tuple[int | None, str]]:
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


class Groups:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def thue_morse(n: int) -> tuple[str, str]:
    """Two different texts of n letters, a power of two, whose sums of bytes times powers of any odd base agree modulo 2^64."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))
