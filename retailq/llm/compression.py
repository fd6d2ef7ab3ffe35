"""Zstandard compressors over dictionaries, made for comparing lengths: no header fields, one level."""
from __future__ import annotations

import zstandard


def compressor(content: bytes, level: int, min_match: int = 0) -> zstandard.ZstdCompressor:
    """A compressor whose history begins with the raw content."""
    parameters = zstandard.ZstdCompressionParameters.from_level(
        level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0,
        **({"min_match": min_match} if min_match else {}))
    if len(content) < 8:
        return zstandard.ZstdCompressor(compression_params=parameters)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def trained_content(samples: list[bytes], size: int) -> bytes:
    """A dictionary that zstandard's trainer cuts from the samples; too few for the trainer: the distinct samples."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]
