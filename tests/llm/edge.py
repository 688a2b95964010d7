"""Hard rows for the operators of tablework.llm, and plain-Python twins."""

import re

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30000))
SHARED = "This very line is shared by several documents"
EDGE = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (4, "one", None), (5, LONG, "b"), (6, LONG, "b"),
    (7, f"alpha beta\n{SHARED}\nÉtat É", "a"), (8, f"{SHARED.upper()}  \ngamma", "a"), (9, f"\t{SHARED}\ndelta\n", None),
    (9, f"\t{SHARED}\ndelta\n", None), (None, f"{SHARED}\nnobody", "c"), (10, "a\u00a0b c\x85d  e's 12 !?", "c"),
    (11, "日本語 текст 😀 it's\r\nline", "c"), (12, "same words here again and again", "c"),
    (13, "Same WORDS here again and again", "c"),
]
#: Further columns, named like columns that operators add or use.
EXTRA = ["size", "target", "copies", "kept", "level", "host", "verdict", "n_lines", "score", "ids", "row", "key",
         "_id", "_hash", "stratum", "maybe", "good", "sid", "gone"]


def documents(spark, rows=EDGE, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(EXTRA)])
    return df


def words(text):
    return WORD.findall(text or "")


def grams(text, n):
    w = words((text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def groups(rows, n, num, den):
    """{doc_id: (set size, smallest linked doc_id)} by comparing all pairs."""
    sets = {i: grams(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets, key=lambda i: len(sets[i]))
    for x, i in enumerate(ids):
        if sets[i]:
            for j in ids[x + 1:]:
                if den * len(sets[i]) < num * len(sets[j]):
                    break
                k = len(sets[i] & sets[j])
                if den * k >= num * (len(sets[i]) + len(sets[j]) - k):
                    a, b = top(i), top(j)
                    up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}
