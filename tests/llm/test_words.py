"""Spelling variants and token alignment against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import alignment, spelling
from tallyfold.llm.queries import op12_spelling, op13_alignment, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def plain_counts(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_groups(counts):
    """Neighbours by trying every letter at every place."""
    letters = {c for w in counts for c in w}
    near = collections.defaultdict(set)
    for w in counts:
        for k in range(len(w) + 1):
            tries = {w[:k] + c + w[k:] for c in letters} | {w[:k] + w[k + 1 :]}
            if k < len(w):
                tries |= {w[:k] + c + w[k + 1 :] for c in letters}
            near[w] |= {t for t in tries if t != w and t in counts}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, counts[w], len(near[w]), counts.get(forms[w]))
    return out


def groups_of(found):
    rows = found.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_query_matches_plain_version(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    wanted = plain_groups(plain_counts([tuple(r) for r in rows]))
    assert len(wanted) > 50 and any(v[0] for v in wanted.values())
    assert groups_of(op12_spelling(spark, FOLDER)) == wanted


@pytest.mark.parametrize("node", [2000, 40, 1])
def test_spelling_of_made_words(spark, node):
    """Words a few edits apart, long ones, other letters; a trie cut at any depth gives the same."""
    rng = random.Random(7)
    counts = {}
    for _ in range(60):
        base = "".join(rng.choice("abcdeéß÷") for _ in range(rng.choice((6, 7, 9, 300))))
        for k in range(6):
            counts[base] = rng.choice((5, 6, 30, 200, 4000))
            at = rng.randrange(len(base))
            base = rng.choice((base[:at] + "x" + base[at:], base[:at] + base[at + 1 :], base[:at] + "é" + base[at + 1 :], base[1:] + "a"))
            base = base if len(base) >= 6 else base + "zzz"
    counts |= {"a" * 600: 5, "a" * 601: 25, "a" * 602: 125, "b" + "a" * 600: 7}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert groups_of(spelling.grouped(words, node=node)) == plain_groups(counts)


def test_spelling_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    counts = {r["word"]: r["n"] for r in spelling.vocabulary(odd_docs, 5).collect()}
    assert counts == plain_counts(rows) and "shared" in counts
    copies = odd_docs.unionByName(odd_docs)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(copies, 10).collect()} == {w: 2 * n for w, n in counts.items()}
    assert spelling.grouped(spelling.vocabulary(no_docs)).count() == 0


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}

    def bytes_b(i):
        piece = two.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    found, counts = [], collections.Counter()
    for doc_id, text in rows:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        spelled = [[bytes(byte_of[c] for c in one.id_to_token(i)) for i in a], [bytes_b(i) for i in b]]
        if not text or any(b"".join(x) != (" " + text).encode() for x in spelled):
            found.append((doc_id, [], [], [], []))
            continue
        ends = []
        for x in spelled:
            at, each = 0, []
            for token in x:
                at += len(token)
                each.append(at)
            ends.append(each)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for cut in cuts:
            p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sum(counts[x] for x in links), sha))
    return collections.Counter(out)


ODD_TEXTS = [
    "<|endoftext|> is text, and so are <s> and </s>, <unk>, <0x41>.", "  two  spaces \n\n and\ttabs ", " ", "\n", "a\x00b",
    "▁lower block", "é ﬁ Å \U0001f600\U0001f468‍\U0001f469", "日本語とテスト", "don't I'LL 12½ x²", " nbsp　wide", "x" * 5000, " " * 3000, "é" * 3000,
]


def test_lanes_of_any_length_give_the_same(monkeypatch):
    one, two = alignment.ByteLevel(tokenizer_path("byte_bpe_50k.json")), alignment.Pieces(tokenizer_path("piece_bpe_32k.model"))
    texts = ["", *ODD_TEXTS, " ".join(ODD_TEXTS) * 3]
    wanted = alignment._aligned_rows(one, two, list(range(len(texts))), texts)
    for lane in (1, 7, 100_000):
        monkeypatch.setattr(alignment, "LANE", lane)
        assert alignment._aligned_rows(one, two, list(range(len(texts))), texts).equals(wanted)


@pytest.mark.parametrize("sent", [10**6, 0])
def test_alignment_matches_plain_version(spark, odd_docs, sent):
    small = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(50_000 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    docs = small.unionByName(odd).unionByName(odd_docs.select("doc_id", "text"))
    docs = spark.createDataFrame(docs.collect(), "doc_id long, text string")
    found = alignment.aligned(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    scored = alignment.scored(found, pairs_sent=sent)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("sha")
    rows = scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest).collect()
    assert collections.Counter(map(tuple, rows)) == plain_alignment([tuple(r) for r in docs.collect()])


def test_alignment_query_and_empty_table(spark, no_docs):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = op13_alignment(spark, FOLDER)
    assert dict(found.dtypes) == {c: "bigint" for c in found.columns if c != "groups_sha256"} | {"groups_sha256": "string"}
    assert collections.Counter(map(tuple, found.collect())) == plain_alignment([tuple(r) for r in rows])
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    assert alignment.scored(alignment.aligned(no_docs, *paths)).count() == 0
