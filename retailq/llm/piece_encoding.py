"""SentencePiece BPE encoding and decoding by suffix-array matching.

For the distinct words of a batch: their bytes are laid end to end and indexed by a suffix array; every vocabulary piece is
searched in it by bisection, which gives the range of all its occurrences; the occurrences are the edges (begin, end, piece)
of the words' lattices and are sorted by position. Relaxation then joins neighbouring symbols along edges, in each word the
edge of the best score first and of equal ones the leftmost, until no edge fits. That is the order in which the model's own
merges are done, so ids equal those of the sentencepiece library. Characters without a piece become byte pieces.

A word is a run of spaces with what follows up to the next space; the model has no piece with a space behind another
character (this is checked), so words are encoded each by itself, and a worker keeps the encodings of common words.
"""
from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices

SPACE = "▁"
WORDS = re.compile(r" +[^ ]*")
MATCH_CHARS = 200_000  # about as many characters are indexed at a time, which bounds the arrays of the matching
LONG_WORD = 200  # characters from which a word is relaxed with a queue of its own


class PieceModel:
    def __init__(self, path: str, max_words: int = 250_000):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normalizer = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE or normalizer.precompiled_charsmap \
                or normalizer.remove_extra_whitespaces or not normalizer.add_dummy_prefix:
            raise ValueError("only BPE models with identity normalisation and a dummy prefix are supported")
        kind = model.trainer_spec.byte_fallback and {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.BYTE} or {}
        self.byte_ids = np.array([kind.get(f"<0x{b:02X}>", -1) for b in range(256)], np.int64)
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == p.UNKNOWN)
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type in (p.NORMAL, p.USER_DEFINED)]
        if any(SPACE in piece.lstrip(SPACE) for _, piece, _ in normal):
            raise ValueError("a piece holds a space behind another character")
        scores = sorted({s for _, _, s in normal}, reverse=True)
        order = {s: r for r, s in enumerate(scores)}
        self.piece_ids = np.array([i for i, _, _ in normal], np.int64)
        self.ranks = np.array([order[s] for _, _, s in normal], np.int64)
        texts = [piece.encode() for _, piece, _ in normal]
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.levels = -(-int(self.lengths.max()) // 8)
        padded = b"".join(t.ljust(8 * self.levels, b"\0") for t in texts)
        self.keys = np.frombuffer(padded, ">u8").astype(np.uint64).reshape(len(texts), self.levels)
        self.decoded = [p.piece.encode() if p.type in (p.NORMAL, p.USER_DEFINED) else b"" for p in model.pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            if i >= 0:
                self.decoded[i] = bytes([b])
        self.decoded[self.unknown] = " ⁇ ".encode()
        self.max_words = max_words
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    # -- matching ---------------------------------------------------------------------------------------------------

    def edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of pieces in the bytes (zero bytes part words): begin, length and piece row, by position."""
        levels, size = self.levels, len(data)
        word_end = np.append(np.flatnonzero(data == 0), size)
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        begins = begins[data[begins] != 0]
        left = word_end[np.searchsorted(word_end, begins)] - begins
        padded = np.concatenate((data, np.zeros(8 * levels + 8, np.uint8)))
        at = np.zeros(size + 8 * levels, np.uint64)  # the eight bytes from each place, most significant first
        for i in range(8):
            at |= padded[i:i + len(at)].astype(np.uint64) << np.uint64(56 - 8 * i)
        suffix = []
        for level in range(levels):
            rest = np.clip(left - 8 * level, 0, 8)
            mask = np.where(rest == 0, 0, np.uint64(0xFFFFFFFFFFFFFFFF) << (np.minimum(8 - rest, 7) * 8).astype(np.uint64))
            suffix.append(at[begins + 8 * level] & mask.astype(np.uint64))
        order = np.lexsort(suffix[::-1])
        suffix = [s[order] for s in suffix]
        low, high = np.zeros(len(self.lengths), np.int64), np.full(len(self.lengths), len(begins), np.int64)
        for level in range(levels):
            live = np.flatnonzero((self.lengths > 8 * level) & (low < high))
            if not len(live):
                break
            rest = np.clip(self.lengths[live] - 8 * level, 0, 8)
            first = self.keys[live, level]
            fill = np.where(rest == 8, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> (rest * 8 % 64).astype(np.uint64))
            for bound, value, past in ((low, first, False), (high, first | fill, True)):
                a, b = low[live].copy(), high[live].copy()
                if bound is high:
                    a = low[live].copy()
                while (a < b).any():
                    open_ = a < b
                    middle = (a + b) >> 1
                    key = suffix[level][np.minimum(middle, max(0, len(begins) - 1))]
                    right = open_ & ((key <= value) if past else (key < value))
                    a, b = np.where(right, middle + 1, a), np.where(open_ & ~right, middle, b)
                bound[live] = a
        count = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        begin = begins[order[low[piece] + nth]] if len(piece) else np.zeros(0, np.int64)
        rank = np.argsort(begin * 256 + self.lengths[piece], kind="stable")
        return begin[rank], self.lengths[piece][rank], piece[rank]

    # -- relaxation -------------------------------------------------------------------------------------------------

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words laid end to end (spaces already written as U+2581), and their number for each word."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"\0".join(r.replace(b"\0", b"\xff") for r in raw), np.uint8)
        starts = np.cumsum(sizes + 1) - sizes - 1
        begin, length, piece = self.edges(data)
        known = begin * 256 + length
        rank = self.ranks[piece]
        never = np.int64(1 << 40)

        def rank_of(a: np.ndarray, c: np.ndarray) -> np.ndarray:
            """Rank of the edge from a to c; ``never`` where there is none."""
            wanted = a * 256 + np.minimum(c - a, 255)
            at = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
            return np.where((known[at] == wanted) & (c - a < 256), rank[at], never) if len(known) else np.full(len(a), never)

        symbol = np.flatnonzero(((data & 0xC0) != 0x80) & (data != 0))
        of_word = np.searchsorted(starts, symbol, side="right") - 1
        ends = starts + sizes
        finish = np.where(np.diff(of_word, append=-1) != 0, ends[of_word], np.append(symbol[1:], 0))
        width = np.bincount(of_word, minlength=len(words))
        done_begin, done_end = [], []
        for word in np.flatnonzero(width > LONG_WORD):
            rows = np.flatnonzero(of_word == word)
            a, b = self._queue(symbol[rows], finish[rows], known, rank)
            done_begin.append(a), done_end.append(b)
        short = width[of_word] <= LONG_WORD
        symbol, finish, of_word = symbol[short], finish[short], of_word[short]
        pair = np.full(len(symbol), never)
        if len(symbol):
            same = of_word[1:] == of_word[:-1]
            pair[:-1][same] = rank_of(symbol[:-1][same], finish[1:][same])
        while len(symbol):
            first = np.flatnonzero(np.diff(of_word, prepend=-1))
            many = np.diff(first, append=len(symbol))
            best = np.minimum.reduceat(pair, first)
            ended = best == never
            if ended.any():
                out = np.repeat(ended, many)
                done_begin.append(symbol[out]), done_end.append(finish[out])
                symbol, finish, of_word, pair = symbol[~out], finish[~out], of_word[~out], pair[~out]
                if not len(symbol):
                    break
                first = np.flatnonzero(np.diff(of_word, prepend=-1))
                best, many = best[~ended], many[~ended]
            # The leftmost best pair of each word joins: its right symbol goes.
            hit = np.flatnonzero(pair == np.repeat(best, many))
            hit = hit[np.diff(of_word[hit], prepend=-1) != 0]
            finish[hit] = finish[hit + 1]
            stay = np.ones(len(symbol), bool)
            stay[hit + 1] = False
            place = np.cumsum(stay) - 1
            symbol, finish, of_word, pair = symbol[stay], finish[stay], of_word[stay], pair[stay]
            joined = place[hit]
            for left in (joined, joined[joined > 0] - 1):
                follows = left + 1 < len(symbol)
                follows[follows] = of_word[left[follows] + 1] == of_word[left[follows]]
                pair[left] = never
                inner = left[follows]
                pair[inner] = rank_of(symbol[inner], finish[inner + 1])
        a = np.concatenate([np.zeros(0, np.int64), *done_begin])
        b = np.concatenate([np.zeros(0, np.int64), *done_end])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        wanted = a * 256 + np.minimum(b - a, 255)
        at = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
        met = (known[at] == wanted) if len(known) else np.zeros(len(a), bool)
        ids = np.where(met, self.piece_ids[piece[at]] if len(known) else 0, -1)
        # Characters without a piece: a byte piece for each byte, or the unknown piece.
        copies = np.where(met, 1, b - a) if (self.byte_ids >= 0).all() else np.ones(len(a), np.int64)
        flat = np.repeat(ids, copies)
        nth = np.arange(len(flat)) - np.repeat(np.cumsum(copies) - copies, copies)
        raw_data = np.frombuffer(b"\0".join(raw), np.uint8)
        byte = self.byte_ids[raw_data[np.repeat(a, copies) + nth]] if len(flat) else np.zeros(0, np.int64)
        flat = np.where(flat >= 0, flat, np.where(byte >= 0, byte, self.unknown))
        per_word = np.bincount(np.searchsorted(starts, a, side="right") - 1, weights=copies, minlength=len(words))
        return flat.astype(np.uint32), per_word.astype(np.int64)

    @staticmethod
    def _queue(begin: np.ndarray, end: np.ndarray, known: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same relaxation for one long word, with a priority queue of edges."""
        low, high = np.searchsorted(known, begin[0] * 256), np.searchsorted(known, (end[-1] + 1) * 256)
        edge = dict(zip(known[low:high].tolist(), rank[low:high].tolist()))
        starts, ends = begin.tolist(), end.tolist()
        n = len(starts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and ends[j] - starts[i] < 256:
                r = edge.get(starts[i] * 256 + ends[j] - starts[i])
                if r is not None:
                    heapq.heappush(queue, (r, starts[i], ends[j], i))

        for i in range(n):
            offer(i)
        live = [True] * n
        while queue:
            _, a, c, i = heapq.heappop(queue)
            j = after[i]
            if not live[i] or j < 0 or starts[i] != a or ends[j] != c:
                continue
            ends[i], live[j] = c, False
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        rows = [i for i in range(n) if live[i]]
        return np.array([starts[i] for i in rows], np.int64), np.array([ends[i] for i in rows], np.int64)

    # -- texts ------------------------------------------------------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and their number for each text. NULL and empty texts have none."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), SPACE, " ")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        # The usual text: words with a single space before each, the dummy prefix included.
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        usual = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        usual_words, usual_at = usual.dictionary.to_pylist(), usual.indices.to_numpy()
        offsets = offsets - offsets[0]
        special = [WORDS.findall(" " + texts[i].as_py()) for i in np.flatnonzero(odd).tolist()]
        extra = list(dict.fromkeys(w for ws in special for w in ws))
        place = {w: len(usual_words) + i for i, w in enumerate(extra)}
        numbers = self._numbers([SPACE + w for w in usual_words] + [w.replace(" ", SPACE) for w in extra])
        rows, odd_at = [], iter(special)
        for i in range(len(texts)):
            if empty[i]:
                rows.append(np.zeros(0, np.int64))
            elif odd[i]:
                rows.append(np.fromiter((place[w] for w in next(odd_at)), np.int64))
            else:
                rows.append(usual_at[offsets[i]:offsets[i + 1]])
        per_text = np.array([len(r) for r in rows], np.int64)
        words = numbers[np.concatenate([np.zeros(0, np.int64), *rows])]
        counts = self.counts[words]
        total = int(counts.sum())
        flat = self.ids[np.repeat(self.starts[words] - (np.cumsum(counts) - counts), counts) + np.arange(total)]
        ends = np.concatenate(([0], np.cumsum(counts)))
        last = np.cumsum(per_text)
        return flat, ends[last] - ends[last - per_text]

    def _numbers(self, words: list[str]) -> np.ndarray:
        kept = len(self.known)
        if len(self.counts) > kept:  # drop what the last batch added beyond the table
            self.ids = self.ids[:int(self.starts[kept])]
            self.starts, self.counts = self.starts[:kept], self.counts[:kept]
        words_at = dict(zip(words, range(len(words))))  # a usual and an odd word may be the same
        distinct = list(words_at)
        numbers = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            cuts = np.flatnonzero(np.diff(np.cumsum([len(w) for w in new]) // MATCH_CHARS, prepend=0)).tolist()
            found = [self.encode_words(new[a:b]) for a, b in zip([0, *cuts], [*cuts, len(new)]) if a < b]
            flat, counts = (np.concatenate(parts) for parts in zip(*found))
            begin = int(self.starts[-1] + self.counts[-1]) if kept else 0
            self.starts = np.concatenate((self.starts, begin + np.cumsum(counts) - counts))
            self.counts = np.concatenate((self.counts, counts))
            self.ids = np.concatenate((self.ids, flat))
            numbers[missing] = kept + np.arange(len(new))
            room = max(0, self.max_words - kept)
            self.known.update(zip(new[:room], range(kept, kept + len(new))))
        if len(distinct) == len(words):
            return numbers
        of = dict(zip(distinct, numbers.tolist()))
        return np.array([of[w] for w in words], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, byte pieces as raw bytes, U+2581 as a space, the dummy prefix taken off."""
        text = b"".join([self.decoded[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_OPEN: dict[str, PieceModel] = {}


def open_model(path: str) -> PieceModel:
    """One model for each file and Python worker."""
    if path not in _OPEN:
        _OPEN[path] = PieceModel(path)
    return _OPEN[path]


ENCODED = "doc_id long, n_ids long, ids array<int>, ids_crc32 long, decoded_crc32 long, round_trip boolean"


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_ids, ids, ids_crc32 (as little-endian 32-bit), decoded_crc32 (UTF-8 of the decoded ids), round_trip.

    Whole texts; NULL and empty ones have no ids and decode to an empty text. round_trip tells whether the decoded text is
    the row's own, with U+2581 read as a space. Rows are judged each by itself; other columns are ignored.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = open_model(model_path)
        for batch in byte_slices(batches, "text", 1 << 20):
            flat, counts = model.encode(batch.column("text"))
            ends = np.cumsum(counts)
            data = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
            ids_crc, text_crc, same = [], [], []
            for text, end, count in zip(batch.column("text").to_pylist(), ends.tolist(), counts.tolist()):
                decoded = model.decode(flat[end - count:end])
                ids_crc.append(zlib.crc32(data[4 * (end - count):4 * end]))
                text_crc.append(zlib.crc32(decoded.encode()))
                same.append(decoded == text.replace(SPACE, " "))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), lists, pa.array(ids_crc, pa.int64()), pa.array(text_crc, pa.int64()),
                 pa.array(same)], names=["doc_id", "n_ids", "ids", "ids_crc32", "decoded_crc32", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(encode, ENCODED)
