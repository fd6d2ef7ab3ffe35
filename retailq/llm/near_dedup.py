"""Near-duplicate groups: MinHash signatures joined by a multi-index Hamming join, links confirmed on whole shingle sets.

Each distinct shingle set has a signature of 32 MinHash values of 16 bits. Two sets of Jaccard similarity s differ in about
32 * (1 - s) of them. All pairs with at most 13 differing values are found: the signature is cut into 7 chunks, by the
pigeonhole principle some chunk of such a pair has at most one differing value (7 * 2 > 13), so with each value of a chunk
left out once, some key of that chunk is the same in both. Pairs further apart are found as well where a chunk allows it; at
s = 0.85 no chunk does with a probability of about 1e-6.

Sets that share a key are not paired with each other. Every key's sets are first compared with that of its smallest doc_id; what that
links becomes a component. Only keys that still hold two components or more are then searched whole, in square cells of
bounded size, for pairs across components. There a longer signature (512 values of 8 bits) tells which pairs can reach the
similarity: those within five deviations of its estimate (a miss has a probability below 1e-6) are confirmed on the whole
sets. A pair is met in the first key that it shares and in no other. So links between different components are seen, and
links inside a component can change nothing.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, stored
from .components import connected_components
from .shingles import min_hashes, mix, shingle_sets


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 85          # 100 * intersection >= percent * union links two sets
    values: int = 32
    distance: int = 13         # differing values up to which all pairs are found
    chunks: int = 7            # chunks * 2 > distance
    cell: int = 512            # rows on a side of a cell of the second search
    fine_values: int = 512
    deviations: float = 5.0

    def __post_init__(self) -> None:
        if self.chunks * 2 <= self.distance:
            raise ValueError("too few chunks: a pair within the distance could differ twice in each")

    @property
    def fine_distance(self) -> int:
        """Differing values of the longer signature up to which a pair may still be similar enough."""
        differ = (1 - self.percent / 100) * 255 / 256
        return int(self.fine_values * differ + self.deviations * (self.fine_values * differ * (1 - differ)) ** 0.5) + 1


def set_digests(sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each whole set, in two signed halves; zeros for an empty set."""
    own = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[own]
    high, low = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
    if len(own):
        high[own] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts)
        low[own] = np.add.reduceat(mix(sets + np.uint64(0x14057B7EF767814F)), starts)
    return high.view(np.int64), low.view(np.int64)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: doc_id, n_shingles, set_high, set_low (128-bit digest of the whole set), signature (empty set: NULL)."""
    size, values = settings.words, settings.values

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 2 << 20):
            sets, sizes = shingle_sets(batch.column("text"), size)
            high, low = set_digests(sets, sizes)
            signed: list = [None] * len(sizes)
            for row, values_of in zip(np.flatnonzero(sizes).tolist(), min_hashes(sets, sizes, values)):
                signed[row] = values_of.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(high), pa.array(low), pa.array(signed, pa.binary())], names=["doc_id", "n_shingles", "set_high", "set_low", "signature"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, set_high long, set_low long, signature binary")


def chunk_keys(values: np.ndarray, chunks: int) -> np.ndarray:
    """(rows, keys): for each chunk and each of its values, a hash of the chunk without that value."""
    keys = []
    for number, columns in enumerate(np.array_split(np.arange(values.shape[1]), chunks)):
        for left_out in range(len(columns)):
            key = np.full(len(values), number * 256 + left_out + 1, np.uint64)
            for column in np.delete(columns, left_out):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, column])
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64) if len(values) else np.zeros((0, len(keys)), np.int64)


def first_slot(differ: np.ndarray, chunks: int) -> np.ndarray:
    """For pairs given by which values differ: the first key that both have (its slot)."""
    columns = np.array_split(np.arange(differ.shape[1]), chunks)
    starts = np.array([c[0] for c in columns])
    count = np.add.reduceat(differ, starts, axis=1, dtype=np.int64)
    chunk = (count <= 1).argmax(axis=1)
    rows = np.arange(len(differ))
    # With one differing value the key that leaves it out is shared, with none the chunk's first key.
    inside = differ & (np.repeat(np.arange(chunks), [len(c) for c in columns])[None] == chunk[:, None])
    return np.where(count[rows, chunk] == 0, starts[chunk], inside.argmax(axis=1))


def _keys(classes: DataFrame, settings: Settings) -> DataFrame:
    """key, slot (its place among a signature's keys), id, n, doc: one row for each key of each class."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 4096):
                batch = whole.slice(begin, 4096)
                values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, settings.values)
                keys = chunk_keys(values, settings.chunks)
                slots = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                again = [np.repeat(batch.column(c).to_numpy(), keys.shape[1]) for c in ("id", "n", "doc")]
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(slots), *map(pa.array, again)],
                                                 names=["key", "slot", "id", "n", "doc"])

    return classes.select("id", "n", "doc", "signature").mapInArrow(emit, "key long, slot int, id long, n long, doc long")


def _shared_keys(classes: DataFrame, settings: Settings) -> DataFrame:
    """The keys that several ids have: key, slot, id, n, and as a with its n_a the key's id of the smallest doc_id: the text
    that came first, which most of its later copies are nearest to, so copies that share many keys share one centre."""
    keys = _keys(classes, settings)
    centres = stored(keys.groupBy("key").agg(F.min(F.struct("doc", "id", "n")).alias("least"), F.min("id").alias("low"), F.max("id").alias("high")).where(
        F.col("low") < F.col("high")).select("key", F.col("least.id").alias("a"), F.col("least.n").alias("n_a")), "key-centres")
    return keys.join(centres, "key").select("key", "slot", "id", "n", "a", "n_a")


def _texts(docs: DataFrame, classes: DataFrame, ids: DataFrame, repeats: DataFrame | None, settings: Settings) -> DataFrame:
    """id, text and the longer signature of the given classes: of the row with a class's smallest doc_id and its set."""
    wanted = classes.join(ids, "id", "left_semi").select("id", F.col("doc").alias("doc_id"), "set_high", "set_low")
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 2 << 20):
            sets, sizes = shingle_sets(batch.column("text"), settings.words)
            fine: list = [None] * batch.num_rows
            for row, values in zip(np.flatnonzero(sizes).tolist(), min_hashes(sets, sizes, settings.fine_values) >> 8):
                fine[row] = values.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(fine, pa.binary()), *map(pa.array, set_digests(sets, sizes))],
                names=["doc_id", "text", "fine", "set_high", "set_low"])

    met = rows.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
        sign, "doc_id long, text string, fine binary, set_high long, set_low long").join(wanted, ["doc_id", "set_high", "set_low"])
    if repeats is None:
        return met.select("id", "text", "fine")
    # Rows that repeat a doc_id with one text are one row here; other ids have a single row and need no shuffle for it.
    again = met.join(repeats, "doc_id", "left_semi").groupBy("id").agg(F.first("text").alias("text"), F.first("fine").alias("fine"))
    return met.join(repeats, "doc_id", "left_anti").select("id", "text", "fine").unionByName(again)


def _similar_size(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def confirm(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of ids whose whole shingle sets are similar enough."""
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in byte_slices(byte_slices(batches, "text_a", 2 << 20), "text_b", 2 << 20):
            flat, sizes = shingle_sets(batch.column("text_b"), settings.words)
            ends = np.cumsum(sizes)
            good = np.zeros(batch.num_rows, bool)
            for row, text in enumerate(batch.column("text_a")):
                if last is None or not text.equals(last):  # the pairs of one a stand together
                    last, own = text, shingle_sets(pa.array([text.as_py()]), settings.words)[0]
                other = flat[ends[row] - sizes[row]:ends[row]]
                shared = len(np.intersect1d(own, other, assume_unique=True))
                good[row] = shared > 0 and 100 * shared >= settings.percent * (len(own) + len(other) - shared)
            rows = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(rows)), batch.column("b").take(pa.array(rows))],
                                             names=["a", "b"])

    return both.mapInArrow(check, "a long, b long").distinct()


def _crossing_pairs(shared: DataFrame, classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of one key, of different components, of similar size and near enough by the longer signature."""
    placed = shared.select("key", "slot", "id", "n").join(classes.select("id", "component"), "id")
    mixed = stored(placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                             F.count(F.lit(1)).alias("rows")).where(F.col("low") != F.col("high")).select(
        "key", F.ceil(F.col("rows") / settings.cell).cast("int").alias("blocks")), "mixed-keys")
    members = stored(placed.join(mixed, "key"), "mixed-members").join(classes.select("id", "signature"), "id").join(
        texts.select("id", "fine"), "id")
    # A key of many rows is cut into blocks; every two blocks meet in a cell of their own.
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), "block",
                         "slot", "id", "n", "component", "signature", "fine")
    dealt = cells.repartition("key", "row", "col").sortWithinPartitions("key", "row", "col")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def pairs(table: pa.Table) -> pa.RecordBatch:
            place = np.stack([table.column(c).to_numpy() for c in ("key", "row", "col")], axis=1)
            bounds = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]).any(axis=1), [True])))
            ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
            component, block = table.column("component").to_numpy(), table.column("block").to_numpy()
            values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, settings.values)
            fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(-1, settings.fine_values)
            slot = table.column("slot").to_numpy()
            low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for begin, end in zip(bounds[:-1], bounds[1:]):
                left = np.flatnonzero(block[begin:end] == place[begin, 1]) + begin
                right = np.flatnonzero(block[begin:end] == place[begin, 2]) + begin
                near = component[left][:, None] != component[right][None]
                smaller, larger = np.minimum(n[left][:, None], n[right][None]), np.maximum(n[left][:, None], n[right][None])
                near &= 100 * smaller >= settings.percent * larger
                i, j = np.nonzero(near)
                for part in range(0, len(i), 1 << 16):
                    x, y = left[i[part:part + (1 << 16)]], right[j[part:part + (1 << 16)]]
                    here = first_slot(values[x] != values[y], settings.chunks) == slot[begin]
                    x, y = x[here], y[here]
                    here = (fine[x] != fine[y]).sum(axis=1) <= settings.fine_distance
                    low.append(np.minimum(ids[x], ids[y])[here])
                    high.append(np.maximum(ids[x], ids[y])[here])
            found = np.unique(np.stack((np.concatenate(low), np.concatenate(high)), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            place = np.stack([table.column(c).to_numpy() for c in ("key", "row", "col")], axis=1)
            ahead = np.flatnonzero((place != place[-1]).any(axis=1))
            full = int(ahead[-1]) + 1 if len(ahead) else 0
            if full:
                yield pairs(table.slice(0, full).combine_chunks())
            rest = table.slice(full)
        if rest is not None and rest.num_rows:
            yield pairs(rest.combine_chunks())

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _linked(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(signed rows, classes, repeated doc_ids: None where no id repeats). A class is a distinct shingle set: its own id, the smallest doc_id with that
    set as ``doc``, and ``component``, the smallest class id reachable over links between sets."""
    signed = stored(signatures(docs, settings), "signatures")
    linkable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    repeats = stored(signed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where(
        F.col("rows") > 1).select("doc_id"), "repeated-ids")
    repeats = None if repeats.isEmpty() else repeats
    # Classes are numbered once, where they are written: a doc_id with several texts is the smallest of several classes.
    classes = stored(linkable.groupBy("set_high", "set_low", "n_shingles").agg(
        F.min("doc_id").alias("doc"), F.first("signature").alias("signature")).withColumnRenamed("n_shingles", "n").withColumn(
        "id", F.monotonically_increasing_id()).withColumn("component", F.col("id")), "classes")

    def labelled(links: DataFrame) -> DataFrame:
        found = connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("joined"))
        plain = classes.drop("component").join(found, "id", "left")
        return stored(plain.withColumn("component", F.coalesce("joined", "id")).drop("joined"), "classes")

    shared = stored(_shared_keys(classes, settings), "shared-keys")
    star = shared.where(F.col("id") != F.col("a")).where(_similar_size("n", "n_a", settings.percent))
    texts = stored(_texts(docs, classes, shared.select("id").distinct(), repeats, settings), "key-texts")
    links = stored(confirm(stored(star.select("a", F.col("id").alias("b")).distinct(), "star-pairs"), texts, settings), "links")
    first = labelled(links)
    crossing = stored(_crossing_pairs(shared, first, texts, settings), "crossing-pairs")
    more = stored(confirm(crossing, texts, settings), "links")
    return signed, first if more.isEmpty() else labelled(links.unionByName(more)), repeats


_SET = ["set_high", "set_low", "n_shingles"]


def groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links, itself included), kept.

    NULL, empty and wordless texts have no shingles and are linked with nothing. Rows with equal sets form a class, so
    copies are linked however many there are. Rows with NULL doc_id take no part in linking: component NULL, kept. Rows
    that repeat a doc_id with different texts are one node of the links, so their classes are reachable from each other.
    Other columns are ignored; an empty table gives no rows.
    """
    signed, classes, repeats = _linked(docs, settings)
    of_class = classes.select("set_high", "set_low", F.col("n").alias("n_shingles"), "component", "doc")
    if repeats is not None:
        named = signed.join(repeats, "doc_id", "left_semi").join(of_class, _SET).select("doc_id", "component").distinct()
        ends = named.groupBy("doc_id").agg(F.min("component").alias("a"))
        bridges = named.join(ends, "doc_id").where(F.col("a") != F.col("component")).select("a", F.col("component").alias("b")).distinct()
        over = connected_components(bridges).select(F.col("node").alias("component"), F.col("component").alias("joined"))
        of_class = of_class.join(over, "component", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined")
    least = of_class.groupBy("component").agg(F.min("doc").alias("least"))
    of_class = stored(of_class.join(least, "component").select(*_SET, "least"), "class-components")
    joined = signed.join(of_class, _SET, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each group of linked texts, that of the smallest doc_id, and all rows linked with nothing.

    Groups are of texts: a doc_id that repeats with different texts joins no groups, so no text goes without a similar one
    that stays. Of rows equal in doc_id and set one stays.
    """
    signed, classes, repeats = _linked(docs, settings)
    first = classes.groupBy("component").agg(F.min(F.struct("doc", "set_high", "set_low")).alias("kept"))
    stays = stored(first.select("kept.doc", "kept.set_high", "kept.set_low"), "kept-classes")
    own = [F.col("doc_id") == F.col("doc"), signed["set_high"] == stays["set_high"], signed["set_low"] == stays["set_low"]]
    gone = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).join(stays, own, "left_anti").select(F.col("doc_id").alias("gone"))
    if repeats is None:
        return docs.join(stored(gone, "dropped-ids"), docs["doc_id"].cast("long") == F.col("gone"), "left_anti")
    once = docs.join(repeats.select(F.col("doc_id").alias("again")), docs["doc_id"].cast("long") == F.col("again"), "left_anti")
    single = once.join(stored(gone, "dropped-ids"), once["doc_id"].cast("long") == F.col("gone"), "left_anti")
    return single.unionByName(_kept_repeats(docs, repeats, stays, settings))


def _kept_repeats(docs: DataFrame, repeats: DataFrame, stays: DataFrame, settings: Settings) -> DataFrame:
    """The rows with a repeated doc_id that stay; they are told by their set, computed again for them alone."""
    columns = docs.columns
    some = docs.join(repeats.select(F.col("doc_id").alias("again")), docs["doc_id"].cast("long") == F.col("again"), "left_semi")
    framed = some.select(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    schema = framed.select("row", "doc", F.lit(0).cast("long").alias("set_high"), F.lit(0).cast("long").alias("set_low"), F.lit(0).cast("long").alias("n")).schema

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 2 << 20):
            sets, sizes = shingle_sets(batch.column("text"), settings.words)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc"), *map(pa.array, set_digests(sets, sizes)), pa.array(sizes)],
                                             names=["row", "doc", "set_high", "set_low", "n"])

    signed = framed.mapInArrow(sign, schema)
    wordless = signed.where(F.col("n") == 0).select("row")
    one = signed.where(F.col("n") > 0).join(stays, ["doc", "set_high", "set_low"], "left_semi").groupBy("doc", "set_high", "set_low").agg(
        F.first("row").alias("row")).select("row")
    return wordless.unionByName(one).select("row.*")
