"""Decoding of whole batches."""

import base64

import pyarrow as pa
import pytest

from tidewater.llm import byte_bpe


@pytest.mark.parametrize("ranks", [None, "sparse"])
def test_a_batch_is_decoded_at_once(ranks):
    tokens = {bytes([b]): b * (7 if ranks else 1) for b in range(256)} | {b"ab": 5000 if ranks else 256}
    lines = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in tokens.items())
    codec = byte_bpe.Codec(lines, r"\S+|\s+", {})
    lists = pa.array([[0], [tokens[b"ab"], tokens[b"c"]], None, [], [tokens[b"\xff"]]], pa.list_(pa.int32())).slice(1)
    assert codec.decode_lists(lists).to_pylist() == [b"abc", b"", b"", b"\xff"]
    assert codec.decode_lists(lists.slice(1, 2)).to_pylist() == [b"", b""] and codec.decode_lists(lists.slice(0, 0)).to_pylist() == []
    with pytest.raises(KeyError):
        codec.decode_lists(pa.array([[6001]], pa.list_(pa.int32())))
