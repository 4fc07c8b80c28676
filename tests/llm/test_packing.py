import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywatch.llm import packing
from tests.llm.edges import clashing, edge_docs, edge_rows, empty_docs


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_json_vocabulary(text):
    assert packing.encoder(packing.ranks_file()).encode_ordinary(text) == reference_ids(text)[:-1]


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_are_exact(spark):
    df = clashing(edge_docs(spark), "piece", "start", "item", "sequence_id")
    rows = packing.pack(df, max_tokens=64).collect()
    check(rows, 64)
    want = []
    for doc_id, text, *_ in edge_rows():
        ids = reference_ids(text)
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids), 64), len(ids)]
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            raw = np.array(ids[low:high], "<u4").tobytes()
            want.append((doc_id, k, low, high - low, zlib.crc32(raw)))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("group_items,over", [(50, 1.08), (100_000, 1.03)])
def test_few_sequences(spark, group_items, over):
    """Of groups of 50 little fits together any more; real ones hold 25,000."""
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(1, 100, 2000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    rows = packing.pack_items(items, 100, group_items).join(items, "item").collect()
    assert len(rows) == 2000
    assert check(rows, 100) <= over * sum(lengths) / 100


def test_items_that_never_fit_together_end(spark):
    items = spark.range(500).selectExpr("id as item", "60L as length")
    rows = packing.pack_items(items, 100, group_items=20).collect()
    assert len({r.sequence_id for r in rows}) == 500


def test_best_fit_takes_the_fullest_bin():
    bins, offsets = packing.best_fit(np.array([60, 50, 40, 50]), 100)
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 60, 50]


def test_empty(spark):
    assert packing.pack(empty_docs(spark)).count() == 0
