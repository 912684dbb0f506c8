"""Small tables that the tests share."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("_text", "_h", "size", "spans", "base", "score", "shard", "length", "token", "n", "sid", "keys", "key", "rank", "host", "words")


def words(seed: int, n: int) -> str:
    """Invented prose, the same for the same seed."""
    out, x = [], seed * 2654435761 % 2**32
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("abcdefghijklmnopqrstuvwxyz"[(x >> s) % 26] for s in (3, 8, 13, 18)))
    return " ".join(out)


def documents(spark, texts, clash: bool = True):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASH if clash else ():
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def empty(spark):
    return documents(spark, [])


def edge_texts():
    """Null, empty, blank, one word, a tie, and one very long text."""
    return [None, "", " \n\t ", "one", "one", words(1, 40), words(1, 40), words(2, 30_000), "É à ß  ñ", "token = abc"]
