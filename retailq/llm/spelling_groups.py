"""Spelling variants: words that one inserted, deleted or replaced letter turns into a far more frequent word.

Method: k-d trees over letter-count vectors. One edit moves the vector by an L1 distance of at most two: a replaced letter
takes one unit from one letter and gives it to another, an inserted one adds one unit. So a search from a word prunes every
box that lies more than one unit above or below it (words of its own length), or that does not hold it plus one unit (words
one letter longer). Candidates left in a bucket are verified by the order of their letters.

Trees are grown for each word length. The upper levels of a length with many words are fitted on a bounded sample
(``SAMPLE_PER_LEAF`` words for each of at most ``MAX_LEAVES`` leaves) and only deal out the work: every word lies in exactly
one leaf, and asks in each leaf that its search box touches, so no pair is lost however well or badly the sample splits.
A leaf's words (in shards of bounded bytes, should a leaf be larger) get a tree of their own inside one task.

Defined results: NULL text has no words; a NULL id counts as empty text in the damage key; repeated rows count again; an
empty table gives no rows; other columns are never read. Ties of the most frequent near word: smallest in code-point order.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_ROWS, FORM_FACTOR = 7, 2, 10
LEAF_WORDS, MAX_LEAVES, SAMPLE_PER_LEAF = 16_384, 1024, 64
SHARD_BYTES = 1 << 20  # letters of the words of one task's tree, and of the words that ask it
BUCKET = 24
ROOT_ROUNDS = 5  # each doubles the steps; a form is ten times as frequent, so fewer than 19 steps fit into a long


# ---- words ------------------------------------------------------------------------------------------------------

def damaged(doc_id: Column, run: Column, one_in: int = 31) -> Column:
    """The lower-cased run without code point h % length where ``one_in`` divides h, the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """word, n of the damaged runs that have enough letters and occurrences, over whole texts.

    A run can only lose a letter, so shorter runs are passed over at once; hot words are summed before the shuffle.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"{RUN}{{{least_letters},}}"), F.lit(0))
    rows = docs.select("doc_id", F.explode(runs).alias("run")).select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    counted = rows.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_rows)


# ---- trees ------------------------------------------------------------------------------------------------------

def letters(words: list[str], length: int) -> np.ndarray:
    """One row of code points for each word; all have the same length and lie below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(rows: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Count of every letter of the alphabet in every row, as int16."""
    place = np.zeros(256, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    flat = place[rows] + np.arange(len(rows))[:, None] * len(alphabet)
    return np.bincount(flat.ravel(), minlength=len(rows) * len(alphabet)).reshape(len(rows), -1).astype(np.int16)


@dataclass
class Tree:
    """Nodes in arrays. Inner node: letter and threshold, children ``low`` (count <= threshold) and ``high``; leaf: rows."""
    letter: list
    threshold: list
    low: list
    high: list
    rows: list

    @property
    def leaves(self) -> int:
        return sum(rows is not None for rows in self.rows)


def grow(counts: np.ndarray, most: int, alphabet: np.ndarray) -> Tree:
    """Split at the median of the letter whose counts vary most until a leaf holds ``most`` rows or equal vectors."""
    tree = Tree([], [], [], [], [])

    def node() -> int:
        for column, start in ((tree.letter, -1), (tree.threshold, 0), (tree.low, -1), (tree.high, -1), (tree.rows, None)):
            column.append(start)
        return len(tree.letter) - 1

    todo = [(node(), np.arange(len(counts)))]
    while todo:
        at, rows = todo.pop()
        part = counts[rows]
        if len(rows) > most:
            dim = int(part.var(axis=0).argmax())
            values = part[:, dim]
            threshold = int(np.floor(np.median(values)))
            if threshold >= values.max():
                threshold = int(values[values < values.max()].max()) if values.min() < values.max() else threshold
            right = values > threshold
            if right.any():
                tree.letter[at], tree.threshold[at] = int(alphabet[dim]), threshold
                tree.low[at], tree.high[at] = node(), node()
                todo += [(tree.low[at], rows[~right]), (tree.high[at], rows[right])]
                continue
        tree.rows[at] = rows
    return tree


def visits(tree: Tree, counts: np.ndarray, alphabet: np.ndarray, above: int, below: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf with the queries whose box search reaches it.

    A query reaches a box if the box lies at most ``above`` units over it and ``below`` units under it, summed over letters.
    """
    place = np.full(256, -1)
    place[alphabet] = np.arange(len(alphabet))
    none = np.zeros(len(counts), np.int16)
    todo = [(0, np.arange(len(counts)), none, none, {}, {})]
    while todo:
        at, rows, over, under, floor, ceiling = todo.pop()
        if not len(rows):
            continue
        if tree.rows[at] is not None:
            yield at, rows
            continue
        letter, threshold = tree.letter[at], tree.threshold[at]
        have = counts[rows, place[letter]] if place[letter] >= 0 else np.zeros(len(rows), np.int16)
        was = np.maximum(floor.get(letter, 0) - have, 0)
        now_over = over - was + np.maximum(threshold + 1 - have, 0)
        keep = now_over <= above
        todo.append((tree.high[at], rows[keep], now_over[keep], under[keep], {**floor, letter: threshold + 1}, ceiling))
        was = np.maximum(have - ceiling[letter], 0) if letter in ceiling else 0
        now_under = under - was + np.maximum(have - threshold, 0)
        keep = now_under <= below
        todo.append((tree.low[at], rows[keep], over[keep], now_under[keep], floor, {**ceiling, letter: threshold}))


# ---- verification -----------------------------------------------------------------------------------------------

def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The common prefix and the common suffix together cover the shorter word."""
    prefix = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    suffix = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return prefix + suffix >= short.shape[1]


def near_rows(data: np.ndarray, asking: np.ndarray, own: bool, pairs_at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (asking, data) at one edit, by a tree over the data. ``own``: both have one length, else data is one longer."""
    alphabet = np.unique(np.concatenate([np.unique(data), np.unique(asking)]))
    counts, asked = letter_counts(data, alphabet), letter_counts(asking, alphabet)
    tree = grow(counts, BUCKET, alphabet)
    for at, queries in visits(tree, asked, alphabet, 1, 1 if own else 0):
        bucket = tree.rows[at]
        step = max(1, pairs_at_once // len(bucket))
        for begin in range(0, len(queries), step):
            some = queries[begin:begin + step]
            distance = np.abs(asked[some][:, None, :] - counts[bucket][None, :, :]).sum(axis=2)
            q, d = np.nonzero(distance == (2 if own else 1))
            q, d = some[q], bucket[d]
            good = one_replaced(asking[q], data[d]) if own else one_inserted(asking[q], data[d])
            if good.any():
                yield q[good], d[good]


# ---- Spark ------------------------------------------------------------------------------------------------------

def upper_trees(words: DataFrame, leaf_words: int = LEAF_WORDS, max_leaves: int = MAX_LEAVES) -> dict[int, Tree]:
    """The dealing tree of every length with more than ``leaf_words`` words; fitted on a bounded sample, by hash of the word."""
    sizes = {r["length"]: r["rows"] for r in words.groupBy(F.length("word").alias("length")).agg(
        F.count(F.lit(1)).alias("rows")).where(F.col("rows") > leaf_words).collect()}  # one row a large length
    if not sizes:
        return {}
    leaves = {length: min(max_leaves, -(-rows // leaf_words)) for length, rows in sizes.items()}
    share = F.create_map(*[F.lit(x) for length, rows in sizes.items()
                           for x in (length, min(1.0, leaves[length] * SAMPLE_PER_LEAF / rows))])
    place = F.shiftrightunsigned(F.xxhash64("word"), 1) / float(2 ** 63)
    sample = words.select("word", F.length("word").alias("length")).where(place < F.try_element_at(share, F.col("length")))
    by_length: dict[int, list[str]] = {}
    for row in sorted(sample.collect()):  # about SAMPLE_PER_LEAF words for each of at most MAX_LEAVES leaves a length
        by_length.setdefault(row["length"], []).append(row["word"])
    trees = {}
    for length, some in by_length.items():
        rows = letters(some, length)
        alphabet = np.unique(rows)
        tree = grow(letter_counts(rows, alphabet), max(1, len(some) // leaves[length]), alphabet)
        tree.rows = [None if r is None else True for r in tree.rows]
        trees[length] = tree
    return trees


DEALT = "length int, leaf int, asks boolean, word string, n long, home int"


def deal(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every word once as data of its leaf, and as a query of each leaf of its own length from its own leaf on and of
    each leaf of the next length that its box search reaches.

    Two words of one length meet in the larger of their two leaves, or in their common one.
    """
    one = Tree([-1], [0], [-1], [-1], [True])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("length", pa.int32()), ("leaf", pa.int32()), ("asks", pa.bool_()), ("word", pa.string()),
                            ("n", pa.int64()), ("home", pa.int32())])
        for batch in batches:
            words_here, n = batch.column(0), batch.column(1)
            of_length: dict[int, list[int]] = {}
            for i, size in enumerate(pa.compute.utf8_length(words_here).to_pylist()):
                of_length.setdefault(size, []).append(i)
            for length, index in of_length.items():
                picked = words_here.take(pa.array(index))
                rows = letters(picked.to_pylist(), length)
                alphabet = np.unique(rows)
                counts = letter_counts(rows, alphabet)
                tree, longer = trees.get(length, one), trees.get(length + 1, one)
                home = np.zeros(len(rows), np.int32)
                for leaf, here in visits(tree, counts, alphabet, 0, 0):
                    home[here] = leaf
                parts = [(length, home, False, np.arange(len(rows)))]
                parts += [(length, np.full(len(here), leaf, np.int32), True, here)
                          for leaf, found in visits(tree, counts, alphabet, 1, 1) for here in [found[home[found] <= leaf]]]
                parts += [(length + 1, np.full(len(here), leaf, np.int32), True, here)
                          for leaf, here in visits(longer, counts, alphabet, 1, 0)]
                numbers = n.take(pa.array(index))
                for size, leaf, asks, here in parts:
                    take = pa.array(here)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(here), size, np.int32)), pa.array(leaf), pa.array(np.full(len(here), asks)),
                         picked.take(take), numbers.take(take), pa.array(home[here])], schema=schema)

    return words.select("word", "n").mapInArrow(dealt, DEALT)


def in_shards(dealt: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Bound a task's group: data and queries of a leaf in shards of about ``shard_bytes`` letters, each met with each.

    A leaf within the bound is one shard. Leaves are few thousand at most for each length: Spark picks the join by size.
    """
    sizes = dealt.groupBy("length", "leaf").agg(
        *[F.ceil((F.count_if(flag) * F.col("length") + 1) / shard_bytes).cast("int").alias(name)
          for name, flag in (("data_shards", ~F.col("asks")), ("query_shards", F.col("asks")))])
    own = lambda shards: F.array(F.pmod(F.xxhash64("word"), F.col(shards)).cast("int"))
    every = lambda shards: F.sequence(F.lit(0), F.col(shards) - 1)
    asks = F.col("asks")
    return dealt.join(sizes, ["length", "leaf"]).withColumn(
        "d", F.explode(F.when(asks, every("data_shards")).otherwise(own("data_shards")))).withColumn(
        "q", F.explode(F.when(asks, own("query_shards")).otherwise(every("query_shards")))).drop("data_shards", "query_shards")


def near_pairs(dealt: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair at one edit."""

    def search(table: pa.Table) -> pa.Table:
        schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
        length, leaf = table.column("length")[0].as_py(), table.column("leaf")[0].as_py()
        asks = table.column("asks")
        data = table.filter(pa.compute.invert(asks))
        asking = table.filter(asks)
        out = []
        sizes = pa.compute.utf8_length(asking.column("word"))
        for own in (True, False):
            some = asking.filter(pa.compute.equal(sizes, length if own else length - 1))
            if not len(some) or not len(data):
                continue
            names, others = some.column("word").to_pylist(), data.column("word").to_pylist()
            home = some.column("home").to_numpy()
            for q, d in near_rows(letters(others, length), letters(names, length if own else length - 1), own):
                if own:  # inside one leaf both words ask: each pair once
                    once = np.array([home[i] != leaf or names[i] < others[j] for i, j in zip(q, d)])
                    q, d = q[once], d[once]
                a, b = some.take(pa.array(q)), data.take(pa.array(d))
                for x, y in ((a, b), (b, a)):
                    out.append(pa.Table.from_arrays([x.column("word"), y.column("word"), y.column("n")], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return dealt.groupBy("length", "leaf", "d", "q").applyInArrow(search, "word string, near string, near_n long")


def with_roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word along forms, by doubling the steps. A form is at least ten times as frequent as its word,
    so a chain has no circle and ROOT_ROUNDS rounds reach the end of the longest one."""
    links = forms.select("word", F.col("form").alias("root"))
    for _ in range(ROOT_ROUNDS):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return links


def group_spellings(docs: DataFrame, factor: int = FORM_FACTOR, leaf_words: int = LEAF_WORDS, max_leaves: int = MAX_LEAVES,
                    shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text)."""
    words = stored(count_words(docs), "spelling-words")
    dealt = stored(deal(words, upper_trees(words, leaf_words, max_leaves)), "spelling-dealt")
    pairs = near_pairs(in_shards(dealt, shard_bytes))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(
        F.struct((-F.col("near_n")).alias("fewer"), F.col("near").alias("near"))).alias("best"))
    judged = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.fewer") >= factor * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.fewer")).alias("form_n"))).alias("f"))
        .select("word", "n", "n_near", "f.form", "f.form_n"), "spelling-forms")
    roots = with_roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
