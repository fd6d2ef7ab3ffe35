"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows are sets of word pairs (single words for one-word windows) that a document must hold whole, so by the
prefix filter one pair of each window is enough to find every candidate: the rarest one over all documents. Documents
meet these pairs position by position; the window's place follows from the pair's offset, windows that would reach over
an end of the document are dropped, and the words are then compared one by one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .words import with_words, word_runs

WINDOW_WORDS = 13
# Windows in one broadcast: about 13 words and some numbers each, 0.5 KB at most for ordinary words.
BROADCAST_WINDOWS = 100_000


def _item_windows(items: DataFrame, window_words: int) -> DataFrame:
    """One row for each distinct window of an item: item_id, window (its words), len, grain (words of a token)."""
    words = with_words(items.select("item_id", "text")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window_words, F.lit(0))
    starts = words.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    windows = starts.select("item_id", F.slice("words", F.col("start") + 1, F.lit(window_words)).alias("window")).distinct()
    size = F.size("window")
    return windows.select("item_id", "window", size.alias("len"), F.least(size, F.lit(2)).alias("grain"))


def _tokens(windows: DataFrame, grain: int) -> DataFrame:
    """One row for each token of the windows of one grain: item_id, joined (the window's words), len, offset, token."""
    rows = word_runs(windows.where(F.col("grain") == grain), grain, "window")
    return rows.select("item_id", F.concat_ws(" ", "window").alias("joined"), "len", F.col("pos").alias("offset"), "token")


def _blocks(rows: DataFrame, count: int, key: Column) -> list[DataFrame]:
    """The rows in blocks of about BROADCAST_WINDOWS, each small enough to broadcast."""
    blocks = -(-count // BROADCAST_WINDOWS)
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == b) if blocks > 1 else rows for b in range(blocks)]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def find_hits(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Every occurrence of an item's window: doc_id, text_hash, start (word from 0), len, item_id.

    Items with NULL or wordless texts have no windows. A benchmark of any size is met in blocks, each behind a counted
    bound, so the documents are never shuffled for it.
    """
    texts = with_words(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"))
    windows = stored(_item_windows(items, window_words), "benchmark-windows")
    found = []
    for grain in (1, 2):
        tokens = stored(_tokens(windows, grain), "benchmark-tokens")
        distinct = stored(tokens.select("token").distinct(), "benchmark-vocabulary")
        n = distinct.count()
        if not n:
            continue
        at = word_runs(texts.select("words"), grain).select("token")
        met = _union([at.join(F.broadcast(block), "token") for block in _blocks(distinct, n, F.col("token"))])
        rarity = stored(met.groupBy("token").agg(F.count(F.lit(1)).alias("occurrences")), "token-rarity")
        # A window with a token that no document holds can't occur; of the others, the rarest token is the prefix.
        order = Window.partitionBy("item_id", "joined").orderBy("occurrences", "token", "offset")
        known = tokens.join(rarity, "token", "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
        prefix = known.withColumn("nth", F.row_number().over(order)).where((F.col("nth") == 1) & (F.col("occurrences") > 0))
        prefix = stored(prefix.select("item_id", "joined", "len", "offset", "token"), "window-prefixes")
        n = prefix.count()
        if not n:
            continue
        start = F.col("pos") - F.col("offset")
        fits = (start >= 0) & (start + F.col("len") <= F.size("words"))
        # Words hold no space, so the joined words are equal where the words are. All of this stays in one generated
        # loop over a document's positions: its words are never copied to a candidate's row.
        same = F.concat_ws(" ", F.slice("words", start + 1, F.col("len"))) == F.col("joined")
        for block in _blocks(prefix, n, F.col("token")):
            candidates = word_runs(texts, grain).join(F.broadcast(block), "token").where(fits & same)
            found.append(candidates.select("doc_id", "text_hash", start.alias("start"), "len", "item_id"))
    if found:
        return _union(found)
    none = F.lit(None).cast(items.schema["item_id"].dataType)
    return texts.where(F.lit(False)).select("doc_id", "text_hash", F.lit(0).alias("start"), F.lit(0).alias("len"), none.alias("item_id"))


def scan(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    NULL and empty texts have no words and no hits. Repeated rows get a row each; rows are told apart by doc_id and a
    hash of the text, so NULL ids are no case of their own. Items without an id mark words but are not listed.
    """
    hits = find_hits(docs, items, window_words)
    spans = hits.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "len")).alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    marked = spans.select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.size("ids").cast("long").alias("n_items"),
        F.concat_ws(",", F.array_sort("ids")).alias("items"))
    rows = with_words(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")).select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"))
    joined = rows.join(marked, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Rows that are not contaminated; the columns stay as they are."""
    flagged = scan(docs, items, window_words).where("contaminated").select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(flagged["hit_id"]) & (F.xxhash64(docs["text"]) == flagged["hit_hash"])
    return docs.join(flagged, same, "left_anti")
