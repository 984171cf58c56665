"""The join on four-word shingles against plain versions."""

import collections
import random

import numpy as np
import pytest

from tallyfold.llm import ngram_join

COLUMNS = ["doc_id", "text"]


def plain_shingles(text, width=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    n = min(width, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def plain_components(rows):
    sets = {i: plain_shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    met = {(a, b) for found in holders.values() for k, a in enumerate(found) for b in found[k + 1 :]}
    for a, b in met:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def found_of(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked_components(docs).collect()}


def variants(rng, base, n, edits, first):
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append((first + k, " ".join(words[rng.randrange(2) :])))
    return out


@pytest.mark.parametrize("tile", [8192, 5])
def test_join_matches_plain_version(spark, small, monkeypatch, tile):
    """With blocks of five sets, tiles are compared block by block."""
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rng = random.Random(tile)
    word = lambda: f"w{rng.randrange(3000)}"
    made = []
    for family in range(14):
        made += variants(rng, [word() for _ in range(rng.choice((5, 9, 16, 40, 120, 400)))], 14, rng.choice((1, 2, 5)), 10_000 + 100 * family)
    shared = [word() for _ in range(60)]  # a passage in many documents
    made += [(30_000 + k, " ".join([word() for _ in range(12)] + shared + [word() for _ in range(2)])) for k in range(60)]
    docs = small.select(*COLUMNS).unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    assert found_of(docs) == plain_components([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("size", [20, 55, 400])
def test_pairs_at_the_threshold(spark, size):
    """Pairs just above and just below 0.85, of equal sizes and of one inside the other."""
    rows, at = [], 0
    for k in range(40):
        own = [f"p{k}x{j}" for j in range(size + 3)]
        for drop in range(max(0, size // 8 - 6), size // 6 + 3):
            for other in (own[: len(own) - drop], own[: len(own) - drop // 2] + [f"q{k}d{drop}x{j}" for j in range(drop // 2)]):
                names = {w: f"{w}v{drop}" for w in own}
                rows += [(at, " ".join(names[w] for w in own)), (at + 1, " ".join(names.get(w, w) for w in other))]
                at += 2
        if len(rows) > 900:
            break
    # The longer variant's words are its own for each pair, so only the two can link.
    rows = [(i, " ".join(f"{w}i{i // 2}" for w in t.split())) for i, t in rows]
    found = found_of(spark.createDataFrame(rows, "doc_id long, text string"))
    wanted = plain_components(rows)
    assert found == wanted
    linked = sum(i != c for i, (_, c) in wanted.items())
    assert 0 < linked < len(rows) // 2


def test_links_inside_a_template(spark, monkeypatch):
    """1,500 documents share nine tenths of their shingles without being linked; pairs among them are."""
    monkeypatch.setattr(ngram_join, "TILE", 400)
    template = [f"t{k}" for k in range(183)]
    rows = [(k, " ".join(template + [f"o{k}x{j}" for j in range(22)])) for k in range(1500)]
    for k in range(15):
        pair = template + [f"p{k}x{j}" for j in range(16)]
        rows += [(10_000 + 2 * k + side, " ".join(pair + [f"q{k}s{side}x{j}" for j in range(6)])) for side in (0, 1)]
    found = found_of(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == {i: (202, i - i % 2 if i >= 10_000 else i) for i, _ in rows}


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 4000, np.uint64)
    for _ in range(200):
        base = rng.choice(pool, rng.integers(1, 600), replace=False)
        keep = rng.random(len(base)) < rng.choice([0.5, 0.9, 0.99])
        two = np.unique(np.concatenate([base[keep], rng.choice(pool, rng.integers(0, 60))]))
        one = np.unique(base)
        if not len(two):
            continue
        marks = ngram_join._stacked([ngram_join.bitmap(one), ngram_join.bitmap(two)])
        differ = int(np.bitwise_count(marks[0] ^ marks[1]).sum())
        assert (len(one) + len(two) - differ) // 2 >= len(np.intersect1d(one, two))


def test_join_of_odd_and_empty_tables(odd_docs, no_docs):
    rows = ngram_join.linked_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((r["n_shingles"], r["component_id"]))
    assert by_id[1] == [(7, 1)] and by_id[2] == [(7, 1)] * 2
    assert by_id[3] == [(0, 3)] and by_id[4] == [(0, 4)] and by_id[5] == [(0, 5)]
    assert by_id[10] == [(1, 10)] and by_id[11] == [(1, 10)]
    assert by_id[7][0][1] == 6 and by_id[None] == [(7, None)]
    assert ngram_join.linked_components(no_docs).count() == 0
