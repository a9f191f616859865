import gzip
import json
import time
import tracemalloc

import pyarrow as pa
import pytest
from envelopes import PACK, envelopes, packed, texts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import breachline as bl
from breachline.functions import codecs


def found(frame):
    return [(r.offset, r.pos, r.requesturl) for r in bl.decode_events(frame).collect()]


def reasons(frame):
    return [(r.offset, r.pos, r.reason) for r in bl.quarantine(frame).collect()]


@pytest.mark.parametrize("codec", codecs.CODECS)
def test_codecs_give_the_same_events(spark, codec):
    frame = texts(spark, '[{"requesturl":"a"},{"requesturl":"é漢😀"}]', "[]", '[{}]', codec=codec)
    assert found(frame) == [(0, 0, "a"), (0, 1, "é漢😀"), (2, 0, None)]
    assert reasons(frame) == []


@pytest.mark.parametrize("codec", codecs.CODECS)
def test_invalid_utf8_and_missing_values(spark, codec):
    values = [PACK[codec](b'[{"a":"\xff"}]'), None, packed('[{"requesturl":"ok"}]', codec)]
    frame = bl.decompress_envelopes(envelopes(spark, values), codec)
    assert reasons(frame) == [(0, None, "decompress"), (1, None, "decompress")]
    assert found(frame) == [(2, 0, "ok")]


def test_damaged_gzip(spark):
    whole = packed('[{"requesturl":"x"}]')
    garbled = whole[:12] + b"\0\0" + whole[14:]
    values = [b"", b"junk", whole[:-9], whole[:-1], whole + b"junk", garbled]
    frame = bl.decompress_envelopes(envelopes(spark, values), "gzip")
    assert reasons(frame) == [(i, None, "decompress") for i in range(len(values))]


def test_gzip_of_several_members_and_padding(spark):
    parts = gzip.compress(b'[{"requesturl":') + gzip.compress(b'"two"}]') + b"\0\0\0"
    empty = gzip.compress(b"")
    frame = bl.decompress_envelopes(envelopes(spark, [parts, empty]), "gzip")
    assert found(frame) == [(0, 0, "two")]
    assert reasons(frame) == [(1, None, "parse")]


def test_damaged_snappy(spark):
    whole = packed('[{"requesturl":"x"}]', "snappy")
    huge = b"\xff\xff\xff\xff\x07" + whole[1:]
    values = [b"", b"\xff\xff\xff\xff\xff\xff", whole[:-3], huge]
    frame = bl.decompress_envelopes(envelopes(spark, values), "snappy")
    assert reasons(frame) == [(i, None, "decompress") for i in range(len(values))]


def test_snappy_accepts_very_dense_blocks(spark):
    text = '[{"requesturl":"' + "a" * 500_000 + '"}]'
    (row,) = bl.decode_events(texts(spark, text, codec="snappy")).collect()
    assert row.requesturl == "a" * 500_000


def test_snappy_stream_of_blocks(spark):
    blocks = [pa.Codec("snappy").compress(p, asbytes=True) for p in (b'[{"requesturl":', b'"s"}]')]
    body = b"".join(len(b).to_bytes(4, "big") + b for b in blocks)
    stream = b"\x82SNAPPY\x00" + (1).to_bytes(4, "big") * 2 + body
    frame = bl.decompress_envelopes(envelopes(spark, [stream, stream[:-2]]), "snappy")
    assert found(frame) == [(0, 0, "s")]
    assert reasons(frame) == [(1, None, "decompress")]


def test_unknown_codec(spark):
    with pytest.raises(ValueError, match="lzo"):
        bl.decompress_envelopes(envelopes(spark, []), "lzo")


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"requesturl":"solo"}', "not_array"),
        ("null", "not_array"),
        ("5", "not_array"),
        ("not json", "parse"),
        ('[{"a":1},{bad]', "parse"),
        ('[{"a":1}', "parse"),
        ("", "parse"),
        ('[{"a":1,"a":2}]', "parse"),
        ("[{'a':1}]", "parse"),
        ('[{"a":NaN}]', "parse"),
        ('[{"a":1},]', "parse"),
    ],
)
def test_bad_text(spark, text, reason):
    frame = texts(spark, text, '[{"requesturl":"good"}]')
    (row,) = bl.quarantine(frame).collect()
    assert (row.offset, row.pos, row.reason) == (0, None, reason)
    assert bytes(row.value) == packed(text)
    assert found(frame) == [(1, 0, "good")]


def test_elements_that_are_not_objects(spark):
    frame = texts(spark, '[1,"a",null,{"requesturl":"z"},[{"b":1}],"{\\"requesturl\\":1}"]')
    assert found(frame) == [(0, 3, "z")]
    rows = bl.quarantine(frame).orderBy("pos").collect()
    assert [(r.pos, r.reason) for r in rows] == [(p, "not_object") for p in (0, 1, 2, 4, 5)]
    strays = [json.loads(bytes(r.value)) for r in rows]
    assert strays == [1, "a", None, [{"b": 1}], '{"requesturl":1}']


def test_text_after_the_list_is_ignored(spark):
    assert found(texts(spark, '[{"requesturl":"t"}] trailing')) == [(0, 0, "t")]


def test_repeated_keys_are_accepted_where_the_session_allows_them(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        assert found(texts(spark, '[{"requesturl":"1","requesturl":"2"}]')) == [(0, 0, "2")]
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


def test_unknown_fields_are_kept(spark):
    event = {"requesturl": "u", "z": {"q": [1, None, {"é": True}]}, "big": 12345678901234567890123}
    (row,) = bl.decode_events(texts(spark, json.dumps([event]))).collect()
    assert json.loads(row.event.toJson()) == event


def test_typed_fields(spark):
    text = '[{"n":"5","u":7},{"n":"bad","u":{"x":1}},{"N":1},{"n":1,"d":{"e":[2,3]}}]'
    fields = "n bigint, u string, d struct<e:array<int>>"
    rows = bl.decode_events(texts(spark, text), fields).collect()
    assert [(r.n, r.u) for r in rows] == [(5, "7"), (None, '{"x":1}'), (None, None), (1, None)]
    assert rows[3].d.e == [2, 3]
    assert "n" not in bl.decode_events(texts(spark, text), "").columns
    assert bl.decode_events(texts(spark, text, "[1]"), "").count() == 4
    with pytest.raises(ValueError, match="offset"):
        bl.decode_events(texts(spark, text), "Offset bigint")


def test_on_bad_fail(spark):
    good = bl.decompress_envelopes(envelopes(spark, [b"junk", packed('[{"requesturl":"a"}]')]))
    rows = bl.decode_events(good, on_bad="fail").collect()
    assert [r.requesturl for r in rows] == ["a"]
    with pytest.raises(PySparkException, match="bad event list at t/0/1: parse"):
        bl.decode_events(texts(spark, "[{}]", "nope"), on_bad="fail").collect()
    with pytest.raises(ValueError):
        bl.decode_events(good, on_bad="ignore")


def test_long_strings_lists_and_numbers_are_read_whole(spark):
    half = "x" * (21 << 20)
    number = "[{}, {" + '"requesturl":' + "1" * 1200 + "}]"
    frame = texts(spark, json.dumps([{"requesturl": half}, {"requesturl": half}]), number)
    lengths = bl.decode_events(frame).select("offset", F.length("requesturl").alias("n")).collect()
    assert [(r.offset, r.n) for r in lengths[:3]] == [(0, len(half)), (0, len(half)), (1, None)]
    assert reasons(frame) == []


def test_event_larger_than_a_variant_is_set_aside_whole(spark):
    text = json.dumps([{"requesturl": "x" * (129 << 20)}])
    frame = texts(spark, text, '[{"requesturl":"near"}]')
    events = bl.decode_events(frame).select("offset", F.length("requesturl").alias("n"))
    assert [tuple(r) for r in events.collect()] == [(1, 4)]
    (row,) = bl.quarantine(frame).collect()
    assert (row.reason, bytes(row.value)) == ("parse", packed(text))


def test_codec_output_is_cut_into_slices(monkeypatch):
    monkeypatch.setattr(codecs, "_SLICE_BYTES", 10)
    batches = [pa.array([b"aaaa", None, b"bbbbbbb", b"c"]), pa.array([], pa.binary())]
    slices = list(codecs._map_bytes(iter(batches), bytes))
    assert [s.to_pylist() for s in slices] == [[b"aaaa", None, b"bbbbbbb"], [b"c"]]


def test_codec_memory_follows_a_few_values():
    """Neither the batch as a whole nor large slices become objects, in steps of which a task has several."""
    many = pa.array([bytes([i]) * (64 << 10) for i in range(256)])
    tracemalloc.start()
    try:
        sizes = [s.nbytes for s in codecs._map_bytes(iter([many]), lambda data: data[::-1])]
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sum(sizes) >= 16 << 20 and max(sizes) < 4 << 20
    assert most < 8 << 20


def test_many_slices_per_input_batch(spark):
    """Small compressed values whose text exceeds one slice many times over."""
    block = packed('[{"requesturl":"' + "u" * (1 << 20) + '"}]')
    frame = spark.range(100).coalesce(1).select(
        F.lit(bytearray(block)).alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    events = bl.decode_events(bl.decompress_envelopes(frame)).select(
        "offset", F.length("requesturl").alias("n")
    )
    assert [(r.offset, r.n) for r in events.orderBy("offset").collect()] == [
        (i, 1 << 20) for i in range(100)
    ]


def test_label_does_not_depend_on_size(spark):
    long = '{"a":"' + "x" * 25_000_000 + '"}'
    number = '{"a":' + "1" * 1200 + "}"
    got = bl.quarantine(texts(spark, long, number, '{"a":1}', codec="none")).collect()
    assert [r["reason"] for r in got] == ["not_array"] * 3


def test_many_gzip_members_take_time_in_proportion(spark):
    from breachline.functions.codecs import _gunzip

    member = gzip.compress(b"[]", mtime=0)

    def seconds(n):
        start = time.perf_counter()
        assert _gunzip(member * n) == b"[]" * n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(64_000) < 40 * max(seconds(4_000), 0.005)
    assert _gunzip(member + b"\0" * 100) == b"[]" and _gunzip(member + b"x") is None
    assert _gunzip(b"") is None and _gunzip(member[:-3]) is None
