"""Near duplicates against all pairs by brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from geoweave.llm import minhash
from geoweave.llm.components import connected_components


def _shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def brute(rows, k, percent):
    """{doc_id: (n_shingles, component)} over all pairs."""
    sets = [(i, _shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (i, a), (j, b) in itertools.combinations([s for s in sets if s[1]], 2):
        both = len(a & b)
        if 100 * both >= percent * (len(a) + len(b) - both):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def _got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_all_pairs_on_documents(spark, real_docs):
    rows = [(r["doc_id"], r["text"]) for r in real_docs]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 85), (5, 80)):
        assert _got(minhash.near_duplicates(docs, words=k, percent=percent)) == brute(rows, k, percent)


def test_links_that_no_star_finds(spark):
    """Chains and rings of near copies around the threshold, with large buckets cut into blocks."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice((0, 2, 4, 6, 8, 10))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (70, 80, 85):
        assert _got(minhash.near_duplicates(docs, words=3, percent=percent, bucket_block=7)) == brute(rows, 3, percent)


@pytest.mark.parametrize("shingles", [50, 300, 1000, 3000, 20000])
def test_signature_estimates_likeness_at_every_length(shingles):
    a, b = minhash.hash_family(308, 11)
    rng = np.random.default_rng(shingles)

    def sig(x):
        return np.frombuffer(minhash.signature(minhash.minima(np.sort(x), a, b)), np.uint8)
    x, y = (rng.integers(0, 2 ** 63, shingles).astype(np.uint64) for _ in range(2))
    assert abs(minhash._likeness(sig(x), sig(y))) < 0.05          # disjoint
    half = np.concatenate([x[: shingles // 2], y[: shingles - shingles // 2]])
    assert abs(minhash._likeness(sig(x), sig(half)) - 1 / 3) < 0.12
    assert minhash._likeness(sig(x), sig(x)) == 1.0


def test_hub_with_more_partners_than_a_block(spark):
    """One document links with hundreds; some of its partners are too short or too different."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = [(0, " ".join(base))]
    for i in range(1, 700):
        words = list(base[: rng.choice((80, 80, 78, 60))])
        for _ in range(rng.choice((1, 2, 3, 12))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(minhash.near_duplicates(docs, words=3, percent=80)) == brute(rows, 3, 80)


def test_nulls_blanks_ties_and_extra_columns(nasty, empty):
    out = minhash.near_duplicates(nasty, words=3, percent=85).collect()
    assert len(out) == nasty.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[0][0].n_shingles == by[1][0].n_shingles == by[2][0].n_shingles == 0
    assert by[0][0].component_id == 0 and by[0][0].kept
    assert by[40][0].component_id == 5 and not by[40][0].kept        # tie with doc 5
    assert len(by[5]) == 2 and all(r.component_id == 5 for r in by[5])  # repeated row
    assert by[None][0].component_id is None and by[None][0].kept
    none = minhash.near_duplicates(empty)
    assert none.collect() == [] and none.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (7, 7)] + [(500, k) for k in range(501, 540)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41))
    assert got[300] == got[200] == got[100] == 100
    assert all(got[k] == 500 for k in range(500, 540))
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
