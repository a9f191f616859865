"""Small envelopes for tests."""

import gzip

import pyarrow as pa

import breachline as bl

PACK = {
    "none": lambda data: data,
    "gzip": lambda data: gzip.compress(data, mtime=0),
    "snappy": lambda data: pa.Codec("snappy").compress(data, asbytes=True),
}


def packed(text, codec="gzip"):
    return PACK[codec](text.encode() if isinstance(text, str) else text)


def envelopes(spark, values):
    """Envelopes with the given values (bytes or None) at offsets 0, 1, …"""
    rows = [
        (None, None if v is None else bytearray(v), "t", 0, i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, bl.ENVELOPE)


def texts(spark, *lists, codec="gzip"):
    """The given JSON texts as decompressed envelopes."""
    return bl.decompress_envelopes(envelopes(spark, [packed(t, codec) for t in lists]), codec)
