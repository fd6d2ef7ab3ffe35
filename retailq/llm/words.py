"""Words and word hashes as Spark expressions that stay inside generated code."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything but digits, a-z and what lies beyond ASCII parts words (A-Z are lowered before).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``words`` in place of the text: its words in order, A-Z lowered; NULL and empty texts have none."""
    pieces = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), SEPARATORS)
    kept = [c for c in rows.columns if c != text]
    rows = rows.select(*kept, pieces.alias("pieces"))
    # A text that begins or ends with separators has an empty piece there, and nowhere else.
    size = F.size("pieces")
    head = F.when(F.get("pieces", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((size > 1) & (F.get("pieces", size - 1) == ""), 1).otherwise(0)
    return rows.select(*kept, F.slice("pieces", head + 1, size - head - tail).alias("words"))


def word_runs(rows: DataFrame, length: int, words: str = "words") -> DataFrame:
    """One row for each run of ``length`` words: the row's columns, pos (from 0) and token (64-bit hash of the run)."""
    # The outer form: for the inner one the optimizer adds a filter on the array's size, which would split each text again.
    at = rows.select("*", F.posexplode_outer(words).alias("pos", "word")).where(F.col("pos") + length <= F.size(words))
    return at.select("*", F.xxhash64(F.col("word"), *[F.get(words, F.col("pos") + i) for i in range(1, length)]).alias("token"))
