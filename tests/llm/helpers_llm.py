"""Rows that every operator must take."""

import sys
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators might use themselves.
CLASHING = ["id", "ids", "key", "path", "rid", "size", "words", "items", "score", "rejected", "n_tokens", "host", "comp", "good"]

WORDS = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "ra", "se", "ti") for b in ("lor", "men", "dak", "vis", "ton", "per")]


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def odd_rows() -> list[tuple]:
    long_text = prose(1, 60_000)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4), (4, "one", "en", "a", 3),
        (5, prose(2, 80), "en", "a", 1), (5, prose(2, 80), "en", "a", 1), (6, prose(2, 80), "fr", "b", 1),
        (None, prose(3, 50), "en", "a", 1), (7, long_text, "en", "a", 1), (8, "x" * 50_000, "en", "a", 1),
        (9, "日本語 テスト 🙂  ▁x <s> </s> <|endoftext|>", "ja", "a", 1), (10, "a\0b\x1cc d", None, None, None),
        (11, "word " * 2000, "en", "a", 1), (None, None, None, None, None),
    ]
    return rows


def docs(spark, rows=None, clashing=True):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    return df


def fold(doc_id, k: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % k


def same_rows(a, b) -> bool:
    return sorted(map(repr, a)) == sorted(map(repr, b))


sys.modules.setdefault("helpers_llm", sys.modules[__name__])
