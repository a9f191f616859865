"""Compression of message values.

Spark has no built-in function that inflates a binary column, so gzip and snappy take one
Arrow-batched step. `none` needs no Python at all. The step returns bytes; checking that they are
UTF-8 is left to the JVM, so every codec treats bad text alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CODECS = ("none", "gzip", "snappy")

# Arrow arrays handed back to Spark are cut at about this size, so memory follows the text of a few
# envelopes and not the number of rows in an input batch. A slice stands twice, as objects and as an
# array, in each of a task's Python steps.
_SLICE_BYTES = 2 << 20

# Longest value a Spark cell can hold; longer text cannot be represented and counts as undecodable.
_CELL_BYTES = (1 << 31) - 64

_FIRST_STEP = 4096  # bytes of a gzip member that are fed first; each further step doubles
_GZIP = 31  # zlib's window setting for the gzip container
_GZIP_LEVEL = 4  # two to three times as fast as the usual 6, for a few percent more bytes

# Container magic and header length of the stream variant of snappy.
_SNAPPY_STREAM_MAGIC = b"\x82SNAPPY\x00"
_SNAPPY_STREAM_HEADER = 16

# The densest snappy element makes 64 bytes out of 3, so a block claiming more is corrupt.
_SNAPPY_MAX_OUT, _SNAPPY_MAX_IN = 64, 3


def decompress(value: Column, codec: str) -> Column:
    """Text of a compressed binary column; null where the bytes cannot be decoded."""
    _check(codec)
    data = value if codec == "none" else _inflate_udf(codec)(value)
    return F.try_validate_utf8(data.cast("string"))


def compress(text: Column, codec: str) -> Column:
    """Binary column holding compressed text."""
    _check(codec)
    data = text.cast("binary")
    return data if codec == "none" else _deflate_udf(codec)(data)


def compressor(codec: str) -> Callable[[bytes], bytes]:
    """Plain function for use inside a task that already holds the bytes."""
    _check(codec)
    return {"none": bytes, "gzip": _gzip, "snappy": _snap}[codec]


def _check(codec: str) -> None:
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}; expected one of {', '.join(CODECS)}")


def _inflate_udf(codec: str):
    decode = {"gzip": _gunzip, "snappy": _unsnap}[codec]

    def inflate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _map_bytes(batches, decode)

    # Non-deterministic keeps Catalyst from copying the call into filters pushed below it.
    return F.arrow_udf(inflate, "binary").asNondeterministic()


def _deflate_udf(codec: str):
    encode = compressor(codec)

    def deflate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _map_bytes(batches, encode)

    return F.arrow_udf(deflate, "binary").asNondeterministic()


def _map_bytes(batches, fn):
    for batch in batches:
        done, size = [], 0
        for item in batch:
            # One value at a time becomes an object, not all of the batch at once.
            result = fn(item.as_py()) if item.is_valid else None
            done.append(result)
            size += len(result or b"")
            if size >= _SLICE_BYTES:
                yield pa.array(done, pa.binary())
                done, size = [], 0
        if done:
            yield pa.array(done, pa.binary())


def _gunzip(block: bytes) -> bytes | None:
    """Text of all members of a gzip block; None when damaged, cut short or followed by junk."""
    view, at, parts, room = memoryview(block), 0, [], _CELL_BYTES
    while True:
        stream, step = zlib.decompressobj(_GZIP), _FIRST_STEP
        while not stream.eof:
            # What a member leaves of its last step is copied, so steps begin small.
            piece = view[at : at + step]
            if not piece or room <= 0:
                return None
            try:
                parts.append(stream.decompress(piece, room))
            except zlib.error:
                return None
            if stream.unconsumed_tail:
                return None
            room -= len(parts[-1])
            at += len(piece) - len(stream.unused_data)
            step *= 2
        while at < len(view) and not view[at]:
            at += 1
        if at == len(view):
            return parts[0] if len(parts) == 1 else b"".join(parts)


def _gzip(data: bytes) -> bytes:
    return zlib.compress(data, _GZIP_LEVEL, wbits=_GZIP)


def _unsnap(data: bytes) -> bytes | None:
    """Text of a snappy block, or of a stream of length-prefixed blocks after the magic header."""
    if not data.startswith(_SNAPPY_STREAM_MAGIC):
        return _unsnap_block(data)
    parts, at, room = [], _SNAPPY_STREAM_HEADER, _CELL_BYTES
    while at < len(data):
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        part = _unsnap_block(data[at + 4 : end]) if end <= len(data) else None
        if part is None or len(part) > room:
            return None
        parts.append(part)
        room -= len(part)
        at = end
    return b"".join(parts) if at == len(data) else None


def _unsnap_block(block: bytes) -> bytes | None:
    size = _snappy_size(block)
    if size is None or size * _SNAPPY_MAX_IN > len(block) * _SNAPPY_MAX_OUT or size > _CELL_BYTES:
        return None
    try:
        return pa.Codec("snappy").decompress(block, decompressed_size=size, asbytes=True)
    except (OSError, pa.ArrowException):
        return None


def _snappy_size(block: bytes) -> int | None:
    """Uncompressed length, a little-endian varint of at most five bytes ahead of the block."""
    size = 0
    for i, byte in enumerate(block[:5]):
        size |= (byte & 0x7F) << (7 * i)
        if byte < 0x80:
            return size
    return None


def _snap(data: bytes) -> bytes:
    return pa.Codec("snappy").compress(data, asbytes=True)
