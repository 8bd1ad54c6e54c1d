"""Packing against the tokenizers library and against lower bounds."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from geoweave.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packed(rows, out, capacity=1024, end_id=2):
    tok = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, end_id]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    key = repr
    assert sorted(got, key=key) == sorted(want, key=key)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_documents(spark, real_docs):
    rows = [(r["doc_id"], r["text"]) for r in real_docs]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    bins = check_packed(rows, out)
    least = -(-sum(r.length for r in out) // 1024)
    assert len(bins) <= 1.02 * least + 2


def test_nasty_rows(nasty, empty):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    check_packed(rows, packing.pack(nasty, PATH).collect())
    assert packing.pack(empty, PATH).collect() == []


def test_small_capacity_and_repeats(spark):
    rows = [(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (2, None), (3, "a"), (3, "a")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, capacity=4).collect()
    check_packed(rows, out, capacity=4)


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    for _ in range(30):
        counts = {x: rng.randrange(1, 50) for x in rng.sample(range(1, 101), rng.randrange(1, 40))}
        used = {}
        for times, bin_ in packing.plan_bins(counts, 100):
            assert sum(bin_) <= 100 and times > 0
            for x in bin_:
                used[x] = used.get(x, 0) + times
        assert used == counts


def test_two_replace_the_smallest_piece():
    # best fit alone closes 6 + 3 with one unit of room; 6 + (2 + 2) fills the bin
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])
