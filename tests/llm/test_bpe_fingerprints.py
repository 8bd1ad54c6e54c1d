"""BPE against the tokenizers library; fingerprints against direct hashing."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from geoweave.llm import bpe, fingerprints as fp
from geoweave.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_round_trip_of_documents(spark, sf, real_docs):
    tok = Tokenizer.from_file(PATH)
    want = []
    for r in real_docs:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, QUERIES["op2_bpe_round_trip"](spark, sf).collect())) == sorted(want)


@pytest.mark.parametrize("block_bytes", [1, 200, 12 << 20])
def test_nasty_texts_in_blocks_of_any_size(spark, nasty, empty, block_bytes):
    tok = Tokenizer.from_file(PATH)
    odd = [(100 + i, t) for i, t in enumerate(["<|ENDOFTEXT|>", " <|endoftext|> ", "J̌ Å K K", "a b c　d",
                                               "x" * 5000, "Don't I'LL we've 'S 's!'s", "ß ẞ ſ İ ı Σ Ά", "1234 ٣ Ⅷ ²", "ábc\x00d", "​ ﻿", "👩‍👩‍👧"])]
    rows = [(r.doc_id, r.text) for r in nasty.collect()] + odd
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).persist()
    out = bpe.decode(bpe.encode(docs, PATH, block_bytes=block_bytes), PATH).collect()
    want = [(i, tok.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted(((r.doc_id, list(r.ids)) for r in out), key=repr) == sorted(want, key=repr)
    texts = {(r.doc_id, tuple(r.ids)): r.text for r in out}
    assert all(texts[i, tuple(x)] == tok.decode(x, skip_special_tokens=False) for i, x in want)
    both = bpe.encode(docs, PATH, block_bytes=block_bytes, decoded=True).collect()
    assert {(r.doc_id, tuple(r.ids)): r.decoded for r in both} == texts and len(both) == len(out)
    assert bpe.encode(empty, PATH, decoded=True).collect() == []


def test_blocks_hold_the_words_of_every_slice(real_docs):
    import pyarrow as pa
    rows = [r["text"] for r in real_docs]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], names=["doc_id", "text"])
    seen = {}
    for _, ids, lens, codes, words in bpe._Blocks(100_000, True)([batch.slice(0, 50), batch.slice(50)]):
        words.validate(full=True)
        known, at = words.to_pylist(), 0
        for i, n in zip(ids, lens.tolist()):
            seen[i] = [known[c] for c in codes[at:at + n] if known[c]]
            at += n
    assert seen == {i: "".join(c.lower() if c.isascii() else c for c in t).split() for i, t in enumerate(rows)}


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        bpe.check_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def _direct(codes, start, end):
    out = 0
    for base in fp.BASES:
        out = (out << 31) | sum((int(c) + 1) * pow(base, i, int(fp.MOD)) for i, c in enumerate(codes[start:end])) % int(fp.MOD)
    return out


def test_span_hashes_equality_and_extensions():
    rng = random.Random(2)
    a = "".join(rng.choice("ab") for _ in range(300)) + "é🙂" * 20
    b = a[40:200] + "zz" + a[10:150]
    x, y = fp.PrefixHash(fp.codes_of(a)), fp.PrefixHash(fp.codes_of(b))
    for _ in range(200):
        i, j = sorted(rng.randrange(len(a) + 1) for _ in range(2))
        assert int(x.spans(i, j)[0]) == _direct(fp.codes_of(a), i, j)
        k, m = rng.randrange(len(a)), rng.randrange(len(b))
        n = 0
        while k + n < len(a) and m + n < len(b) and a[k + n] == b[m + n]:
            n += 1
        assert fp.common_extension(x, k, y, m) == n
        assert fp.span_equal(x, k, y, m, n) and not fp.span_equal(x, k, y, m, n + 1)
    w = x.windows(5, 100, 7)
    assert [int(v) for v in w] == [int(x.spans(i, i + 7)[0]) for i in range(5, 100)]


def _expect(rows):
    rows = sorted(((i, t or "") for i, t in rows))
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        yield i, t, t[:len(t) - q] + nxt[:q], nxt


def test_edited_texts_and_likeness(spark, real_docs):
    rows = [(r["doc_id"], r["text"]) for r in real_docs]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for per in (4000, 7):
        out = {r.doc_id: r for r in fp.fingerprints(docs, rows_per_bucket=per).collect()}
        assert len(out) == len(rows)
        for i, t, edited, nxt in _expect(rows):
            r = out[i]
            assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
            a, e, n = (fp._Print(x) for x in (t, edited, nxt))
            assert (r.fingerprint, r.edited_fingerprint) == (fp.as_text(a.values), fp.as_text(e.values))
            assert r.near_edited == fp.likeness(a.values, e.values) and r.near_next == fp.likeness(a.values, n.values)
            assert (r.prefix_edited, r.prefix_next) == (len(os.path.commonprefix([t, edited])), len(os.path.commonprefix([t, nxt])))
        long = [r for r in out.values() if r.n_chars > 400]
        assert np.mean([r.near_edited for r in long]) > 0.5 and np.median([r.near_next for r in long]) < 0.1


def _brute_print(text):
    """The smallest mixed hashes of a text's spans, each hashed on its own."""
    codes, width = fp.codes_of(text), min(fp.SPAN, len(text))
    spans = [_direct(codes, i, i + width) for i in range(len(text) - width + 1)] if text else []
    return sorted({int(v) for v in fp._mixed(np.array(spans, np.uint64))})[:fp.KEEP]


def test_likeness_of_short_texts_equals_direct_comparison(spark):
    """Texts around the span's length, compared span by span without prefix arrays."""
    rng = random.Random(4)
    texts = ["", "a", "ab", "abcdefghijk", "abcdefghijkl", "abcdefghijkl", "abcdefghijklm", "abcdefghijklX", "x" * 40, "x" * 41,
             *("".join(rng.choice("ab ") for _ in range(rng.randrange(9, 90))) for _ in range(25))]
    rows = list(enumerate(texts))
    out = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, t, edited, nxt in _expect(rows):
        a, e, n = (_brute_print(x) for x in (t, edited, nxt))

        def like(x, y):
            union = sorted(set(x) | set(y))[:fp.KEEP]
            return sum(v in x and v in y for v in union) / len(union) if x and y else float(len(x) == len(y))
        assert abs(out[i].near_edited - like(a, e)) < 1e-12 and abs(out[i].near_next - like(a, n)) < 1e-12
        assert out[i].fingerprint == "".join(f"{v:08x}" for v in a)
        assert (out[i].prefix_edited, out[i].prefix_next) == (len(os.path.commonprefix([t, edited])), len(os.path.commonprefix([t, nxt])))


def test_fingerprints_of_nasty_rows(spark, nasty, empty):
    out = fp.fingerprints(nasty).collect()
    assert len(out) == nasty.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[5][0].fingerprint == by[5][1].fingerprint == by[40][0].fingerprint
    assert by[0][0].fingerprint == "" and by[0][0].near_edited == 1.0 and by[0][0].near_next == 1.0  # doc 1 is null
    assert by[0][0].edited_sha256 == sha("")
    one = fp.fingerprints(spark.createDataFrame([(9, "abcdefgh")], "doc_id long, text string")).collect()[0]
    assert one.edited_sha256 == sha("abcdefab") and one.near_next == 1.0
    assert fp.fingerprints(empty).collect() == []
