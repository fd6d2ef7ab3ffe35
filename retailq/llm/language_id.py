"""Language identification by compression: the language whose raw-content dictionary encodes the text shortest.

``fit`` learns from a sample. A language's dictionary holds every sampled text of it: each gives the same number of bytes, as
word-aligned pieces spread over the whole text, and texts stand in the order of a hash. So no text, however long or early in any
order, crowds out others. ``narrow_margin`` learns from all texts: its dictionaries hold the words that most texts have.
"""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_slices, letters_only, sampled_ids, stored
from .compression import compressor

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    docs_per_language: int = 600      # bound of fit's training sample, per language
    held_out_docs: int = 300          # without effect: narrow_margin learns from all rows and judges all
    dictionary_bytes: int = 110_000   # raw content of a language
    piece: int = 48                   # bytes of a piece, about
    level: int = 9
    window: int = 512                 # bytes encoded at a time, so that the dictionary decides and not the text itself
    close: float = 0.02               # margins below this are judged again, with a stronger level and short windows
    close_level: int = 19
    close_window: int = 96


@dataclass
class LanguageModel:
    contents: dict[str, bytes]
    settings: Settings = field(default_factory=Settings)

    def __post_init__(self) -> None:
        self._open: dict[tuple[str, int], object] = {}

    def __getstate__(self) -> dict:
        return {"contents": self.contents, "settings": self.settings}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._open = {}

    def _size(self, language: str, data: bytes, level: int, window: int) -> int:
        if (language, level) not in self._open:
            self._open[language, level] = compressor(self.contents[language], level)
        encode = self._open[language, level].compress
        return sum(len(encode(data[i:i + window])) for i in range(0, len(data), window))

    def predict(self, letters: str) -> tuple[str, float]:
        """Language and margin: 1 - smallest length / second smallest (1 with one language). No letter: 'und', 0."""
        if not letters or not self.contents:
            return UNKNOWN, 0.0
        s, data = self.settings, letters.encode()
        sizes = {name: self._size(name, data, s.level, s.window) for name in self.contents}
        if len(sizes) > 1:
            ranked = sorted(sizes.values())
            if ranked[0] >= ranked[1] * (1 - s.close):
                for name in sizes:
                    sizes[name] += self._size(name, data, s.close_level, s.close_window)
        ranked = sorted((size, name) for name, size in sizes.items())
        return ranked[0][1], 1.0 - ranked[0][0] / ranked[1][0] if len(ranked) > 1 else 1.0


def pieces(letters: str, share: int, size: int) -> bytes:
    """``share`` bytes of the text, about: all of it, or whole words at evenly spread places, as many pieces as fit."""
    data = letters.encode()
    if len(data) <= share:
        return data
    count = max(1, share // (size + 1))
    out = []
    for i in range(count):
        at = (2 * i + 1) * (len(data) - size) // (2 * count)
        begin = data.rfind(b" ", 0, at + 1) + 1  # back to the word's begin
        end = data.find(b" ", begin + size)
        out.append(data[begin:end if 0 <= end <= begin + 2 * size else begin + size])
    return b" ".join(out)


def fit(docs: DataFrame, learnable: Column | None = None, settings: Settings = Settings()) -> LanguageModel:
    """Dictionaries from a bounded sample: up to ``docs_per_language`` rows of each language, by a hash of doc_id.

    Rows with NULL lang, text or doc_id teach nothing, nor do letterless texts. The sample is picked without its texts, then
    met with the table again through a broadcast of that bound; whole texts stay on the executors, which cut the pieces.
    Texts that are equal in letters teach once.
    """
    s = settings
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(learnable) if learnable is not None else rows
    return train(_sampled(docs, sampled_ids(rows, "lang", s.docs_per_language)), s)


def _sampled(docs: DataFrame, picked: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").join(F.broadcast(picked), ["doc_id", "lang"], "left_semi").where(
        F.col("text").isNotNull()).select("doc_id", "lang", letters_only(F.col("text")).alias("letters")).where(F.col("letters") != "")


def train(sample: DataFrame, settings: Settings = Settings()) -> LanguageModel:
    """The model of rows (lang, letters), in any order."""
    s = settings
    distinct = sample.groupBy("lang", F.sha2("letters", 256).alias("digest")).agg(F.first("letters").alias("letters"))
    counts = {r["lang"]: r["rows"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}  # a row a language
    shares = {lang: max(1, s.dictionary_bytes // rows) for lang, rows in counts.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "letters"):
            found = [pieces(t, shares[lang], s.piece) for lang, t in zip(batch.column("lang").to_pylist(), batch.column("letters").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("digest"), pa.array(found, pa.binary())], names=["lang", "digest", "content"])

    rows = distinct.mapInArrow(cut, "lang string, digest string, content binary").collect()  # dictionary_bytes a language, about
    contents: dict[str, list[bytes]] = {}
    for row in sorted(rows):  # by digest: an order that says nothing about the text
        contents.setdefault(row["lang"], []).append(bytes(row["content"]))
    return LanguageModel({lang: b" ".join(parts) for lang, parts in contents.items()}, s)


def narrow_margin(docs: DataFrame, quantile: float = 0.005, settings: Settings = Settings()) -> tuple[LanguageModel, float]:
    """A model of all rows of known language, and the margin below which it should reject: a ``quantile`` of their margins at
    most lies below it. So about that share of ordinary texts goes, mostly the shortest, and with them most texts that are
    half in one language and half in another.

    Nothing is sampled. Dictionaries hold the words that are in most texts, counted over all of them. For the margins the
    texts are halved by a hash of their letters, and each row is judged by a model of the other half. Rows with NULL lang or
    text teach nothing and do not count, nor do letterless texts; nor do rows whose language is told wrongly.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[\p{L}\p{M}]")).select(
        "lang", letters_only(F.col("text")).alias("letters"))
    first, second, whole = counted_models(stored(_word_counts(known), "language-words"), settings)
    told = known.select("lang", _judge(docs.sparkSession, [second, first])("letters", _half()).alias("told"))
    right = told.where(F.col("told.lang_pred") == F.col("lang")).select("told.score")
    if len(whole.contents) > 1:  # a half with one language only has nothing to compare, and tells it with a margin of 1
        right = right.where("score < 1")
    margins = stored(right, "language-margins")
    return whole, _lowest(margins, quantile)


def _half() -> Column:
    """0 or 1, the half that a text belongs to; equal texts share it."""
    return F.pmod(F.xxhash64("letters"), F.lit(2)).cast("int")


def _word_counts(known: DataFrame) -> DataFrame:
    """lang, word, first, second: the number of texts with the word, of each half. Texts that are equal in letters count once.

    A run of letters without a space is words of up to 24 letters, so scripts that set no spaces give bounded words too.
    """
    texts = known.groupBy("lang", F.sha2("letters", 256).alias("digest")).agg(F.first("letters").alias("letters"))
    words = F.array_distinct(F.regexp_extract_all("letters", F.lit("[^ ]{1,24}"), F.lit(0)))
    return texts.select("lang", _half().alias("half"), F.explode(words).alias("word")).groupBy("lang", "word").agg(
        F.count(F.when(F.col("half") == 0, 1)).alias("first"), F.count(F.when(F.col("half") == 1, 1)).alias("second"))


def counted_models(counts: DataFrame, settings: Settings = Settings()) -> list[LanguageModel]:
    """Models of the first half, of the second and of all texts, from rows of ``_word_counts``.

    A dictionary is filled from the most common words down. Words stand on levels, eight for each doubling of the number of
    texts; of the one level that does not fit as a whole, a hash of the word says which get the room that is left. So no task
    orders words: there are some hundred levels at most, and ``dictionary_bytes`` a language, about, reach the driver.
    """
    each = counts.select("lang", "word", F.posexplode(F.array("first", "second", F.col("first") + F.col("second"))).alias("model", "n"))
    each = each.where("n > 0").select("*", F.floor(F.log2("n") * 8).alias("level"), F.xxhash64("word").alias("hash"))
    levels = each.groupBy("model", "lang", "level").agg(F.sum(F.octet_length("word") + 1).alias("bytes"))
    above = Window.partitionBy("model", "lang").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    room = settings.dictionary_bytes - F.coalesce(F.sum("bytes").over(above), F.lit(0))
    levels = levels.select("model", "lang", "level", F.least(room / F.col("bytes"), F.lit(1.0)).alias("share")).where("share > 0")
    chosen = each.join(F.broadcast(levels), ["model", "lang", "level"]).where(
        F.shiftrightunsigned("hash", 1) <= F.col("share") * float(2 ** 63))
    words = F.transform(F.sort_array(F.collect_list(F.struct("n", "hash", "word"))), lambda w: w["word"])
    contents: list[dict[str, bytes]] = [{}, {}, {}]
    for row in chosen.groupBy("model", "lang").agg(F.array_join(words, " ").alias("content")).collect():  # a row a language and model
        contents[row["model"]][row["lang"]] = row["content"].encode()
    return [LanguageModel(found, settings) for found in contents]


def _lowest(margins: DataFrame, share: float) -> float:
    """The largest margin (0 to 1) with ``share`` of all rows at most below it; without rows 0.

    Found by counting rows in steps of 2 ** -12, then in ever smaller ones inside the step that holds it, down to 2 ** -36.
    """
    place = F.floor(F.col("score") * float(2 ** 36))
    inside, below, found = margins, -1, 0
    for bits in (24, 12, 0):
        step = F.shiftright(place, bits)
        counts = sorted(map(tuple, inside.groupBy(step).agg(F.count(F.lit(1))).collect()))  # 4,097 rows at most
        if not counts:
            return 0.0
        if below < 0:
            below = int(share * sum(n for _, n in counts))
        for found, n in counts:
            if below < n:
                break
            below -= n
        inside = inside.where(step == found)
    return found / 2 ** 36


def identify(docs: DataFrame, model: LanguageModel, columns: list[str]) -> DataFrame:
    """The named columns with lang_pred and score (the margin, 0 to 1). Whole texts; NULL or letterless: 'und', 0.

    Each row is judged by itself, so repeated rows and extra columns are no case of their own. Only the letters go to the
    Python workers; the named columns, often whole texts, stay where they are.
    """
    # The rows' own columns stand in one struct, so that none can clash with those that are added.
    framed = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), letters_only(F.col("text")).alias("letters"))
    told = framed.select("row", _judge(docs.sparkSession, [model])("letters", F.lit(0)).alias("told"))
    return told.select("row.*", "told.lang_pred", "told.score")


def _judge(spark: SparkSession, models: list[LanguageModel]) -> Callable[..., Column]:
    """A function of letters and a model's number: struct of lang_pred and score.

    It counts as nondeterministic, so that a filter over its result does not make Spark judge each row twice.
    """
    shared = spark.sparkContext.broadcast(pickle.dumps(models))

    @F.arrow_udf("lang_pred string, score double")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = pickle.loads(shared.value)
        for letters, numbers in batches:
            found = [own[n].predict(t.as_py()) for t, n in zip(letters, numbers.to_pylist())]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang_pred", "score"])

    return judge.asNondeterministic()


def keep_identified(docs: DataFrame, model: LanguageModel, min_margin: float) -> DataFrame:
    """Rows whose language is told with at least the margin; the columns stay as they are."""
    columns = docs.columns
    told = identify(docs.select("*"), model, columns)
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_margin)).select(*columns)
