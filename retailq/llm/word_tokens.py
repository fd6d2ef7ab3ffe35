"""Whole-text encoding with the tokenizers library, one call per distinct space-led word.

A text may be cut before a space that follows a character other than white space: the pre-tokenizers of the two
supported files always begin a new pre-token there, no special token holds a space, and no normaliser composes over
a space. So a text's ids are the ids of its words laid end to end, and a worker encodes each distinct word once.
Texts with white space before a space have no such cuts and are encoded whole.
"""
from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space (ASCII, Unicode separators, and the control characters that some libraries count as such) before a space.
ODD_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


class WordTokenizer:
    """Keeps the first ``max_words`` distinct words with their ids; later ones are encoded once a batch (same results)."""

    def __init__(self, path: str, keep_ids: bool = True, max_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.max_words = max_words
        self.keep_ids = keep_ids
        form = json.loads(self.tokenizer.to_str())
        self.led_by_space = None
        if (form["pre_tokenizer"] or {}).get("type") == "ByteLevel" and not form["pre_tokenizer"]["add_prefix_space"] \
                and form["normalizer"] is None:
            # In such a vocabulary a space is written U+0120, and only the first id of a space-led word begins with it.
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.led_by_space = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}  # a word behind its space: its number in the three arrays
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words laid end to end, and their number for each word."""
        if not self.keep_ids:
            found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            return np.zeros(0, np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        if self.led_by_space is not None:
            # Space-led words can be joined: one call for many, cut again where an id begins with a space.
            step = 1000
            runs = self._encode(["".join(words[i:i + step]) for i in range(0, len(words), step)])
            flat = np.concatenate([np.asarray(r, np.uint32) for r in runs])
            leads = np.flatnonzero(self.led_by_space[flat])
            if len(leads) == len(words):
                return flat, np.diff(leads, append=len(flat))
        found = self._encode(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum())), lengths

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """Number of each word (its space left out) in this worker's arrays; new words are encoded and added."""
        kept = len(self.known)
        if len(self.lengths) > kept:  # drop what the last batch added beyond the table
            self.ids = self.ids[:int(self.starts[kept])] if self.keep_ids else self.ids
            self.starts, self.lengths = self.starts[:kept], self.lengths[:kept]
        numbers = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            flat, lengths = self._encode_words([" " + w for w in new])
            begin = int(self.starts[-1] + self.lengths[-1]) if kept else 0
            self.starts = np.concatenate((self.starts, begin + np.cumsum(lengths) - lengths))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.ids = np.concatenate((self.ids, flat))
            numbers[missing] = kept + np.arange(len(new))
            room = max(0, self.max_words - kept)
            self.known.update(zip(new[:room], range(kept, kept + len(new))))
        return numbers

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
        """Word numbers of all texts laid end to end, the position of each text's first word, those words' encodings."""
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        firsts = offsets[:-1] - offsets[0]
        encoded = words.dictionary_encode()
        numbers = self._numbers(encoded.dictionary.to_pylist())[encoded.indices.to_numpy()]
        heads = self.tokenizer.encode_batch_fast(words.take(pa.array(firsts)).to_pylist(), add_special_tokens=False)
        return numbers, firsts, heads

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end (uint32), and the number of ids of each text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        counts = np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        whole = {int(i): None for i in np.flatnonzero(odd)}
        for i, ids in zip(whole, self._encode([texts[i].as_py() for i in whole])):
            whole[i] = np.asarray(ids, np.uint32)
        plain = np.flatnonzero(~odd)
        pieces: list[np.ndarray] = [np.zeros(0, np.uint32)]
        if len(plain):
            numbers, firsts, heads = self._plain(texts.take(pa.array(plain)))
            lengths = self.lengths[numbers]
            lengths[firsts] = 0  # a text's first word has no space before it and is encoded by itself
            rest = np.add.reduceat(lengths, firsts)
            total = int(lengths.sum())
            flat = self.ids[np.repeat(self.starts[numbers] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)]
            ends = np.cumsum(rest)
        row = 0
        for i in range(len(texts)):
            if i in whole:
                pieces.append(whole[i])
                counts[i] = len(whole[i])
            else:
                head = np.asarray(heads[row].ids, np.uint32)
                pieces += [head, flat[ends[row] - rest[row]:ends[row]]]
                counts[i] = len(head) + rest[row]
                row += 1
        return np.concatenate(pieces), counts

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        whole, plain = np.flatnonzero(odd).tolist(), np.flatnonzero(~odd)
        if whole:
            counts[whole] = [len(ids) for ids in self._encode([texts[i].as_py() for i in whole])]
        if len(plain):
            numbers, firsts, heads = self._plain(texts.take(pa.array(plain)))
            lengths = self.lengths[numbers]
            lengths[firsts] = np.fromiter(map(len, heads), np.int64, len(heads))
            counts[plain] = np.add.reduceat(lengths, firsts)
        return counts


_OPEN: dict[tuple[str, bool], WordTokenizer] = {}


def open_tokenizer(path: str, keep_ids: bool = True) -> WordTokenizer:
    """One tokenizer for each file, use and Python worker."""
    if (path, keep_ids) not in _OPEN:
        _OPEN[path, keep_ids] = WordTokenizer(path, keep_ids)
    return _OPEN[path, keep_ids]
