"""Mixing, packing, sharding and search against plain versions."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import mixing, packing, sharding, topk
from tallyfold.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, repeats=2):
    """Shares by weight; what passes a source's cap is shared again until nothing does."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= repeats * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("which", ["odd_docs", "small"])
def test_mix_meets_targets(request, which):
    docs = request.getfixturevalue(which)
    rows = mixing.per_document(docs).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    wanted = plain_targets(dict(sizes))
    by_source = {(r["doc_id"], r["size"]): r for r in rows}
    assert len(rows) == docs.count()
    assert sorted({round(r["target"], 3) for r in rows}) == sorted({round(t, 3) for t in wanted.values()})
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows) and by_source
    goals = collections.defaultdict(int)
    for d, r in mixing.per_document(docs).join(docs.select("doc_id", "source").dropDuplicates(["doc_id"]), "doc_id").select("source", "taken").collect():
        goals[d] += r
    for source, goal in wanted.items():
        if source is not None:  # documents without an id are not in the join
            assert abs(goals[source] - goal) <= 1
    again = mixing.per_document(docs.repartition(5)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, rows))


def test_mix_order_interleaves(spark):
    rows = [(k, "a b c d", "s1") for k in range(300)] + [(1000 + k, "a b c d", "s2") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = mixing.mix(docs, weights=(3.0, 1.0), share=0.5).orderBy("position").select("source").limit(100).collect()
    assert 70 <= sum(r[0] == "s1" for r in order) <= 80
    assert mixing.mix(docs, weights=(3.0, 1.0), share=0.5).agg(F.sum("served")).first()[0] in range(1198, 1201)


def test_mixed_documents_keep_columns(odd_docs, no_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() > 0
    # Rows without an id and repeated rows are documents like others.
    taken = collections.Counter((r["doc_id"], r["size"]) for r in mixing.mix(odd_docs).collect())
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == collections.Counter({k: n for (k, _), n in taken.items()})
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"])
    assert mixing.mixed_documents(no_docs).count() == 0 and mixing.per_document(no_docs).count() == 0


@pytest.mark.parametrize("which", ["odd_docs", "small"])
def test_packing_round_trip(request, which):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.packed(docs, tokenizer_path()).collect()
    wanted = collections.Counter(
        (r["doc_id"], bytes(np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4"))) for r in docs.collect()
    )
    by_doc = collections.defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    for (doc_id, ids), times in wanted.items():
        if sum(n for (d, _), n in wanted.items() if d == doc_id) == 1:
            parts = sorted(by_doc[doc_id])
            assert b"".join(p for _, p, _ in parts) == ids and all(n == len(ids) // 4 for *_, n in parts)
        else:
            assert sum(len(p) for _, p, _ in by_doc[doc_id]) == times * len(ids)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 2048 + 16 * len(sequences)


def test_packing_of_nothing(no_docs):
    assert packing.packed(no_docs, tokenizer_path()).count() == 0


def test_word_ids_equal_the_tokenizer():
    words = packing.WordIds(tokenizer_path())
    texts = [
        "Don't STOP İstanbul ΑΣ naïve x́y é ́x K ﬁ", "<|endoftext|> a<|startoftext|>b", "",
        "x\x1cy\x85z it's, they're! 12½ ²a", "日本語, テスト! a,b.c;d 's's I'M, 1.2.3.",
    ]
    for _ in range(2):
        for text, ids in zip(texts, words.read(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_texts_with_special_strings_and_white_space():
    """The plain tokenizer reads the strings of its special tokens as these, also inside words."""
    from tokenizers import Tokenizer

    plain, words = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    texts = [
        "<|endoftext|> y.", "a<|startoftext|>b <|endoftext|>", "<|ENDOFTEXT|> <|", "<|endoftext|>", "", " \n", "\tx ",
        "é, ß. Ünï! x\x00y\u3000z", "w" * 3000, "one. two, three",
    ]
    wanted = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert wanted[0][0] == 49407 and wanted[3] == [49407]
    for some in (texts, texts[4:], texts):
        expected = wanted if some is texts else wanted[4:]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in words.read(some)] == expected
        flat, bounds = words.flat(some, 1)
        assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [[*ids, 1] for ids in expected]


def test_packing_of_special_strings(spark):
    docs = spark.createDataFrame([(1, "<|endoftext|> y."), (2, "z <|STARTOFTEXT|>")], "doc_id long, text string")
    rows = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.packed(docs, tokenizer_path()).collect()}
    assert rows[1][0] == 49407 and rows[1][-1] == 1 and 49406 not in rows[2]


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(5)
    histogram = dict(collections.Counter(np.minimum(2048, rng.lognormal(6, 1.2, 20_000).astype(int) + 1).tolist()))
    histogram[700] = 9_000
    places = packing.plan(histogram)
    laid = collections.Counter()
    for p in places:
        assert p.first == laid[p.length]
        laid[p.length] += p.count
    assert laid == histogram
    tokens = sum(k * n for k, n in histogram.items())
    used = 1 + max(p.base + -(-p.count // p.per) - 1 for p in places if not p.stream)
    end = max((p.offset + p.count * p.length for p in places if p.stream), default=used * 2048)
    assert -(-end // 2048) * 2048 <= tokens * 1.008 + 2048


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            used, at = (used, at + s) if at + s <= middle else (used + 1, s)
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 16])
@pytest.mark.parametrize("which", ["odd_docs", "small"])
def test_shards_are_minimax(request, which, shards):
    docs = request.getfixturevalue(which)
    rows = sharding.sharded(docs, shards).collect()
    assert len(rows) == docs.count() and {r["shard"] for r in rows} <= set(range(shards))
    source = docs.select("doc_id", "text").collect()
    groups = collections.defaultdict(list)
    for r in source:
        groups[r["text"] or ""].append(r["doc_id"])
    lowest = min(r["doc_id"] for r in source if r["doc_id"] is not None) - 1
    order = collections.Counter()
    for text, ids in groups.items():
        order[min((i for i in ids if i is not None), default=lowest)] += len(ids) * (len(text.encode()) + 1)
    sizes = [n for _, n in sorted(order.items())]
    by_shard, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        by_shard[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(by_shard.values()) == best_capacity(sizes, shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    crcs = collections.Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in rows)
    assert crcs == collections.Counter((r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 1) for r in source)
    together = collections.defaultdict(set)
    for r in rows:
        together[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in together.values())


def test_sharding_of_nothing(no_docs):
    assert sharding.sharded(no_docs).count() == 0


@pytest.mark.parametrize("parts", [2, 7, 512])
def test_cuts_by_refinement(spark, monkeypatch, parts):
    monkeypatch.setattr(sharding, "PARTS", parts)
    rng = np.random.default_rng(parts)
    sizes = rng.lognormal(3, 2, 3_000).astype(int) + 1
    ids = np.sort(rng.choice(1 << 40, len(sizes), replace=False)) - (1 << 39)
    items = spark.createDataFrame(list(zip(ids.tolist(), sizes.tolist(), strict=True)), "first long, bytes long")
    cuts = sharding.minimax_cuts(items, 8)
    shard = np.searchsorted(cuts, ids, side="right")
    assert np.bincount(shard, sizes).max() == best_capacity(sizes.tolist(), 8)


@pytest.mark.parametrize("place", [0, 10_000, 30_000, 59_999])
def test_cuts_beside_a_large_group(spark, monkeypatch, place):
    """A group of a third of the bytes does not send the other groups to the driver."""
    monkeypatch.setattr(sharding, "PARTS", 64)
    rng = np.random.default_rng(place)
    sizes = rng.lognormal(3, 1, 60_000).astype(int) + 1
    sizes[place] = sizes.sum() // 2
    ids = np.sort(rng.choice(1 << 62, len(sizes), replace=False)) - (1 << 61)
    items = spark.createDataFrame(list(zip(ids.tolist(), sizes.tolist(), strict=True)), "first long, bytes long").repartition(8).localCheckpoint()
    collected, plain = [], sharding._split

    def counted(*given):
        found = plain(*given)
        collected.append(sum(map(len, found)))
        return found

    monkeypatch.setattr(sharding, "_split", counted)
    cuts = sharding.minimax_cuts(items, 16)
    shard = np.searchsorted(cuts, ids, side="right")
    assert np.bincount(shard, sizes).max() == best_capacity(sizes.tolist(), 16) == sizes[place]
    assert sum(collected) < 6_000


def plain_top(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable[i] = min(usable.get(i, v), v)
    ints = {i: [int(np.floor(64 * float(x))) for x in v] for i, v in usable.items()}
    out = []
    for q, v in ints.items():
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints.items() if i != q and len(w) == len(v))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_matches_plain_version(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    found = topk.top_k(vectors, F.col("vec_id") % 20 == 0)
    assert dict(found.dtypes)["rank"] == "int"
    assert sorted(map(tuple, found.collect())) == plain_top(rows, 20)


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in np.round(rng.normal(0, 1, 3) * 2) / 2], 1) for k in range(60)]  # many ties
    rows += [(100, None, 1), (120, [1.0, None, 2.0], 1), (140, [nan, 1.0, 1.0], 1), (160, [inf, 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(180, [0.5, 0.25], 1), (181, [1.0, -0.1], 1), (200, [], 1), (201, [], 1), (20, rows[20][1], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dims int")
    found = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()))
    assert found == plain_top([r[:2] for r in rows], 20)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_beyond_doubles(spark):
    rows = [(0, [2e6, 1.0]), (1, [2e6, 3.0]), (2, [2e6, 2.0]), (3, [1e300, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(vectors, F.col("vec_id") == 0).collect()
    assert [r["vec_id"] for r in found] == [3, 1, 2] and found[1]["score"] - found[2]["score"] == 64 * 64


def test_letters_go_to_the_model(monkeypatch):
    """Words of small Latin letters are looked up in the model itself; before, all went through the whole tokenizer."""
    words = packing.WordIds(tokenizer_path())
    whole = words.tokenizer
    asked = []
    monkeypatch.setattr(words, "_encode", lambda found: asked.extend(found) or packing.WordIds._encode(words, found))
    monkeypatch.setattr(words, "_encode_plain", lambda found: asked.extend(found) or packing.WordIds._encode_plain(words, found))
    texts = ["brond flimsel ok. zzzzqqx", "Brond CAPS x1 né don't", "q" * 3000, ""]
    found = [np.frombuffer(x, "<u4").tolist() for x in words.read(texts)]
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(set(asked)) == sorted({".", "x1", "don't"})


def test_ids_travel_in_two_bytes(spark, odd_docs):
    docs = odd_docs.where("doc_id > 0").dropDuplicates(["doc_id"])
    wide, narrow = (
        {(r.doc_id, r.start): r.ids for r in packing.pieces(docs, tokenizer_path(), width=w).collect()} for w in (4, 2)
    )
    assert packing._width(tokenizer_path(), packing.END) == 2 and packing._width(tokenizer_path(), 1 << 16) == 4
    assert {k: np.frombuffer(v, "<u2").tolist() for k, v in narrow.items()} == {k: np.frombuffer(v, "<u4").tolist() for k, v in wide.items()}
    read = {}
    for r in packing.packed(docs, tokenizer_path()).orderBy("doc_id", "start").collect():
        read[r.doc_id] = read.get(r.doc_id, b"") + r.ids
    whole = {}
    for (doc_id, _), ids in sorted(wide.items()):
        whole[doc_id] = whole.get(doc_id, b"") + ids
    assert read == whole
