"""Toxicity by compression distance: windows are encoded with an ordinary and a toxic zstandard dictionary.

Fitting, on a bounded sample of labelled rows, whole texts, near copies left out:
  1. Half of the sample tells which character 5-grams are met far more often in toxic documents than chance allows.
  2. The ordinary dictionary is trained on words without such grams, the toxic one on words that hold one. The toxic
     compressor's history is the ordinary content with the toxic content behind it, so ordinary passages cost the same
     in both and a difference of lengths tells of toxic content alone.
  3. The other half calibrates: counts of windows whose difference passes 1 to 6 bytes, weighed by a logistic fit.
The sample is bounded by its rows alone. Its texts stay on the executors: the driver gets three hashes and one row of
features for each document, the telling grams and the words that may enter a dictionary.
Scoring encodes every window of the whole text. A text of more windows than any that calibrated is judged in equal parts
of no more windows than that, by its most toxic part, so no length is judged by extrapolation.
"""
from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import byte_slices, letters_only, sampled_ids, stored
from .compression import compressor, trained_content
from .shingles import mix


@dataclass(frozen=True)
class Settings:
    toxic_docs: int = 2000        # bounds of the labelled sample
    ordinary_docs: int = 6000
    gram: int = 5
    evidence: float = 11.0        # nats against chance that a gram must show
    share: float = 0.6            # of the documents with the gram that must be toxic
    toxic_words: int = 1500
    toxic_bytes: int = 16_384
    ordinary_bytes: int = 98_304
    ordinary_words: int = 200_000
    level: int = 7
    min_match: int = 5
    window: int = 12              # words of a window
    step: int = 6                 # words from one window to the next
    thresholds: int = 6           # differences of 1 .. thresholds bytes are counted


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    settings: Settings = field(default_factory=Settings)
    longest: int = 0              # most windows of a text that calibrated; 0: none did

    def windows(self, words: list[str]) -> int:
        s = self.settings
        return len(range(0, max(1, len(words) - (s.window - s.step)), s.step))

    def features(self, words: list[str]) -> list[float]:
        s = self.settings
        if not hasattr(self, "_pair"):
            self._pair = (compressor(self.ordinary, s.level, s.min_match).compress,
                          compressor(self.ordinary + self.toxic, s.level, s.min_match).compress)
        ordinary, toxic = self._pair
        counts = [0] * (s.thresholds + 1)
        windows = self.windows(words)
        for i in range(0, windows * s.step, s.step):
            data = (" " + " ".join(words[i:i + s.window]) + " ").encode()
            counts[max(0, min(s.thresholds, len(ordinary(data)) - len(toxic(data))))] += 1
        passed = np.cumsum(counts[:0:-1])[::-1]
        return [*np.log1p(passed), *np.sqrt(passed / windows), math.log1p(windows)]

    def score(self, letters: str) -> float:
        s, words = self.settings, letters.split(" ")
        windows = self.windows(words) if self.longest else 1
        parts = -(-windows // max(1, self.longest))
        each = -(-windows // parts) * s.step if parts > 1 else len(words)
        # A part's last window reaches into the next part, so the windows are those of the whole text.
        return max(self._score(words[i:i + each + s.window - s.step] if parts > 1 else words)
                   for i in range(0, windows * s.step if parts > 1 else 1, each))

    def _score(self, words: list[str]) -> float:
        x = (np.asarray(self.features(words)) - self.mean) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.weights[0] + float(x @ self.weights[1:]))))))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}


def _marks(letters: str) -> list[int]:
    """Three smallest hashes of the text's three-word runs, each by a hash order of its own."""
    words = letters.split()
    runs = np.array([zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))], np.uint64)
    return [3 * int(mix(runs + np.uint64((k + 1) << 32)).min() >> np.uint64(3)) + k for k in range(3)]


def _without_near_copies(sample: list[Row]) -> list[Row]:
    """One of each group of near copies: documents that share a smallest hash of three-word runs are left out."""
    seen: set[int] = set()
    kept = []
    for doc in sample:
        if not any(m in seen for m in doc.marks):
            kept.append(doc)
        seen.update(doc.marks)
    return kept


def _grams(word: str, n: int) -> set[str]:
    word = f" {word} "
    return {word[i:i + n] for i in range(max(1, len(word) - n + 1))}


def _mapped(sample: DataFrame, chosen: dict[int, int], make: Callable[[Iterator[tuple[str, int, int]]], Iterator[tuple]],
            schema: str) -> DataFrame:
    """What ``make`` gives for the (letters, label, place) of the sample's rows whose number is in ``chosen``: number to place."""
    shared = sample.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((letters.as_py(), label.as_py(), shared.value[row.as_py()]) for batch in byte_slices(batches, "letters")
                for row, label, letters in zip(*(batch.column(c) for c in ("row", "label", "letters"))) if row.as_py() in shared.value)
        made = make(rows)
        while some := list(islice(made, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)

    empty = sample.sparkSession.createDataFrame([], schema).schema
    names, types = empty.names, [to_arrow_type(f.dataType) for f in empty]
    return sample.select("row", "label", "letters").mapInArrow(run, schema)


def _item_counts(sample: DataFrame, first: dict[int, int], s: Settings) -> DataFrame:
    """is_word, item, ordinary, toxic: in how many documents of each class each gram and each word is."""
    def count(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple]:
        met: dict[tuple[bool, str], list[int]] = {}
        for letters, label, _ in rows:
            words = set(letters.split())
            for key in [(True, w) for w in words] + [(False, g) for g in set().union(*(_grams(w, s.gram) for w in words))]:
                met.setdefault(key, [0, 0])[label] += 1
            if len(met) > 200_000:  # summed by Spark
                yield from ((*key, *n) for key, n in met.items())
                met = {}
        yield from ((*key, *n) for key, n in met.items())

    partial = _mapped(sample, first, count, "is_word boolean, item string, ordinary long, toxic long")
    return partial.groupBy("is_word", "item").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _telling_grams(counts: DataFrame, size: list[int], s: Settings) -> set[str]:
    """Grams that toxic documents have more often than chance allows; size: documents of each class."""
    base = (size[1] + 1) / (size[0] + size[1] + 2)
    n = F.col("ordinary") + F.col("toxic")
    # No document can show more evidence than -log(base): rarer grams stay on the executors.
    able = counts.where(~F.col("is_word") & (F.col("toxic") > 0) & (n >= s.evidence / -math.log(base) - 1e-6)
                        & (F.col("toxic") >= n * (s.share - 1e-6)))
    telling = set()
    for row in able.collect():
        n = row.toxic + row.ordinary
        q = row.toxic / n
        if q > base and q >= s.share:
            nats = q * math.log(q / base) + ((1 - q) * math.log((1 - q) / (1 - base)) if q < 1 else 0.0)
            if n * nats >= s.evidence:
                telling.add(row["item"])
    return telling


def _dictionaries(counts: DataFrame, telling: set[str], s: Settings) -> tuple[bytes, bytes]:
    """Ordinary content from words without a telling gram, toxic content from words of toxic documents that hold one."""
    shared = counts.sparkSession.sparkContext.broadcast(telling)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tells = [not shared.value.isdisjoint(_grams(w, s.gram)) for w in batch.column("item").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("toxic"), pa.array(tells, pa.bool_())],
                                             names=["item", "toxic", "tells"])

    judged = stored(counts.where("is_word").select("item", "toxic").mapInArrow(judge, "item string, toxic long, tells boolean"),
                    "toxicity-words")
    place = F.crc32(F.concat(F.lit(" "), "item", F.lit(" ")).cast("binary"))
    plain = judged.where(~F.col("tells"))
    # The first words by their hash; a bound on it keeps all but slightly more than that many on the executors.
    bound = 2 ** 32 * min(1.0, 1.1 * s.ordinary_words / max(1, plain.count()))
    words = sorted((f" {r['item']} ".encode() for r in plain.where(place <= bound).select("item").collect()),
                   key=lambda w: (zlib.crc32(w), w))
    ordinary = trained_content(words[:s.ordinary_words], s.ordinary_bytes)
    common = judged.where(F.col("tells") & (F.col("toxic") > 0)).orderBy(F.col("toxic").desc(), "item").limit(s.toxic_words)
    toxic = [(f" {r['item']} ".encode(), r.toxic) for r in common.collect()]
    if sum(len(w) for w, _ in toxic) > s.toxic_bytes:
        return ordinary, trained_content([w for w, n in toxic for _ in range(n)], s.toxic_bytes)
    return ordinary, b"".join(w for w, _ in toxic[::-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 80) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first weight is the free intercept."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    penalty = ridge * (np.arange(len(w)) > 0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x / len(y) + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(sample: DataFrame, settings: Settings = Settings()) -> ToxicityModel:
    """Model from rows of letters and label, in a fixed order of its own. One label only, or none: a constant score."""
    s = settings
    # Rows are numbered once, where they are written.
    sample = stored(sample.select(F.monotonically_increasing_id().alias("row"), "label", "letters"), "toxicity-sample")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "letters"):
            marks = [_marks(t) for t in batch.column("letters").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "label", "place", "digest")),
                                              pa.array(marks, pa.list_(pa.int64()))], names=["row", "label", "place", "digest", "marks"])

    placed = sample.select("*", F.crc32(F.col("letters").cast("binary")).alias("place"), F.xxhash64("letters").alias("digest"))
    marked = placed.mapInArrow(mark, "row long, label int, place long, digest long, marks array<long>").collect()
    docs = _without_near_copies(sorted(marked, key=lambda d: (d.place, d.digest, d.label, d.row)))
    first, second = docs[::2], docs[1::2]
    width = 2 * s.thresholds + 1
    rate = (sum(d.label for d in docs) + 0.5) / (len(docs) + 1.0)
    constant = np.concatenate(([math.log(rate / (1 - rate))], np.zeros(width)))
    model = ToxicityModel(b"", b"", np.zeros(width), np.ones(width), constant, s)
    if len({d.label for d in first}) < 2 or len({d.label for d in second}) < 2:
        return model
    counts = stored(_item_counts(sample, {d.row: i for i, d in enumerate(first)}, s), "toxicity-counts")
    toxic_docs = sum(d.label for d in first)
    telling = _telling_grams(counts, [len(first) - toxic_docs, toxic_docs], s)
    model.ordinary, model.toxic = _dictionaries(counts, telling, s)
    shared = sample.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def measure(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple]:
        own = pickle.loads(shared.value)
        for letters, label, place in rows:
            words = letters.split(" ")
            yield place, label, own.windows(words), own.features(words)

    measured = sorted(_mapped(sample, {d.row: i for i, d in enumerate(second)}, measure,
                              "place long, label int, windows long, features array<double>").collect())
    x = np.array([r.features for r in measured])
    y = np.array([r.label for r in measured], float)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic((x - model.mean) / model.scale, y)
    model.longest = max(r.windows for r in measured)
    return model


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, settings: Settings = Settings()) -> ToxicityModel:
    """Fit on a bounded labelled sample: the first rows of each class by a hash of doc_id.

    ``learnable`` is a condition on doc_id. Conflicting labels of one id count as toxic; NULL labels, ids and texts teach
    nothing. The ids are picked first, then their texts fetched through a broadcast of at most that many ids.
    """
    s = settings
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(learnable)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    most = F.when(F.col("label") == 1, s.toxic_docs).otherwise(s.ordinary_docs)
    picked = sampled_ids(known, "label", most)
    sample = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        letters_only(F.col("text")).alias("letters"), "label")
    return train(sample, s)


def score_toxicity(docs: DataFrame, model: ToxicityModel, columns: list[str]) -> DataFrame:
    """The named columns with score (0 to 1) and predicted (1 from 0.5 on). NULL texts are scored as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    framed = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), letters_only(F.col("text")).alias("letters"))
    schema = framed.select("row", F.lit(0.0).alias("score")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for batch in byte_slices(batches, "letters"):
            scores = [own.score(t) for t in batch.column("letters").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    return framed.mapInArrow(judge, schema).select(
        "row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows that are not judged toxic; the columns stay as they are."""
    columns = docs.columns
    return score_toxicity(docs, model, columns).where(F.col("predicted") == 0).select(*columns)
