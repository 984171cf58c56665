"""Row-wise operators against plain versions: secrets, licences, quality, toxicity."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import licenses, quality, secret_scan, toxicity

FOLDER = "/root/testdata/sf0.001"


def plain_spans(text):
    out = []
    key = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    for m in re.finditer(key + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def as_versions(docs):
    return docs.select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text")


PLANTED = [
    "Api_Key: 'abcdefg' then TOKEN=short1 and token = \"x\"",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "c" + "0123456789abcdef" * 3,
    "paſsword: abcdefgh Key secret=secret=abcdef passwd   :   zzzzzz",
    "é token=\U0001f600 token='aaaaaaaaa'",
    "-----BEGIN RSA PRIVATE KEY----- eyJabcdefghij.abcdefghij.abcdefghij ghp_" + "a" * 36,
]


def test_secrets_match_plain_version(spark, odd_docs, small):
    planted = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(PLANTED)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(planted).unionByName(small.select("doc_id", "text"))
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = {r.kind for r in secret_scan.BASE}
    wanted = collections.Counter((i, tuple(plain_spans(t or ""))) for i, t in texts)
    rows = secret_scan.scan(as_versions(docs)).collect()
    found = collections.Counter((r["path"], tuple(tuple(f) for f in r["found"] if f["kind"] in base)) for r in rows)
    assert found == wanted
    kinds = {f["kind"] for r in rows for f in r["found"]}
    assert {"pem", "jwt", "forge"} <= kinds


def test_ledger_is_incremental(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame([(1, 1, "token = 'abcdef1'"), (2, 1, "nothing")], "path long, version int, text string")
    rules = secret_scan.BASE
    first = secret_scan.scan(one, rules, ledger).count()
    rows = lambda: spark.read.parquet(ledger).selectExpr("blob", "explode(rules) AS rule")
    assert (first, rows().count()) == (2, 6)
    two = one.unionByName(spark.createDataFrame([(1, 2, "nothing"), (3, 1, "AKIA" + "Z" * 16)], one.schema))
    found = secret_scan.scan(two, rules, ledger)
    assert found.count() == 4 and rows().count() == 9  # only the new blob was scanned
    newer = [rules[0], secret_scan.Rule("access", "AKIA[A-Z0-9]+", least=21, version=2), rules[2]]
    again = {(r["path"], r["version"]): len(r["found"]) for r in secret_scan.scan(two, newer, ledger).collect()}
    assert rows().count() == 12 and rows().distinct().count() == 12  # one more pair per blob
    assert again == {(1, 1): 1, (2, 1): 0, (1, 2): 0, (3, 1): 0}


def plain_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses_match_plain_version(spark, odd_docs, small):
    planted = ["CC BY cc-by, (c) All Rights  Reserved", "GNU General Public License.\nCC_BY", "xcc by cc byx General. Public? LICENSE"]
    extra = spark.createDataFrame([(2000 + k, t) for k, t in enumerate(planted)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra).unionByName(small.select("doc_id", "text"))
    wanted = collections.Counter((r["doc_id"], *plain_license(r["text"] or "")) for r in docs.collect())
    rows = licenses.scan(docs).collect()
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert collections.Counter(tuple(r[c] for c in columns) for r in rows) == wanted
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in rows)


@pytest.mark.parametrize(
    ("expression", "grade", "names"),
    [
        ("MIT", 2, ["mit"]),
        ("MIT OR GPL-3.0-only AND Apache-2.0", 2, ["mit", "gpl-3.0-only", "apache-2.0"]),
        ("(MIT OR GPL-3.0) AND LGPL-2.1", 1, ["mit", "gpl-3.0", "lgpl-2.1"]),
        ("GPL-2.0 WITH Classpath-exception-2.0 and mit", 2, ["gpl-2.0", "mit"]),
        ("((Unknown-1))", 0, ["unknown-1"]),
        ("MIT prose goes on", 2, ["mit"]),
    ],
)
def test_license_expressions(expression, grade, names):
    assert licenses.evaluate(expression) == (grade, names)


@pytest.mark.parametrize("expression", ["", "AND MIT", "MIT OR", "(MIT", ")", "MIT AND (OR)"])
def test_malformed_expressions(expression):
    with pytest.raises(licenses.Malformed):
        licenses.evaluate(expression)


def test_tags_are_read(spark):
    docs = spark.createDataFrame([(1, "x\nSPDX-License-Identifier: (MIT OR GPL-2.0)\ny"), (2, "spdx-license-identifier: AND")], "doc_id long, text string")
    one, two = licenses.scan(docs).orderBy("doc_id").collect()
    assert (one["labels"], one["grade"], one["score"]) == ("gpl-2.0,mit", 2, 1.0)
    assert (two["labels"], two["grade"], two["score"]) == ("", None, 0.0)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_counts_match_plain_version(odd_docs, small):
    columns = ["doc_id", "text", "lang", "source"]
    docs = odd_docs.select(*columns).unionByName(small.select(*columns))
    wanted = collections.Counter((r["doc_id"], *plain_counts(r["text"] or "")) for r in docs.collect())
    signals = quality.with_signals(docs)
    judged = quality.judged(signals, quality.fences(signals)).collect()
    names = quality.COUNTS[:5]
    assert collections.Counter((r["doc_id"], *(r[c] for c in names)) for r in judged) == wanted
    for r in judged:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_with_odd_columns(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        signals = quality.with_signals(docs)
        judged = quality.judged(signals, quality.fences(signals))
        assert judged.count() == docs.count() and set(docs.columns) <= set(judged.columns)


def test_fences_adapt_and_merge(spark):
    """A source whose documents all hold symbols keeps them; elsewhere the same share is rejected."""
    plain, marked = " ".join(["word"] * 3 + [f"w{k}" for k in range(30)]), " ".join(f"w{k}|" for k in range(30))
    rows = [(k, f"{marked} d{k}", "en", "tables") for k in range(200)] + [(1000 + k, f"{plain} d{k}", "en", "prose") for k in range(300)]
    rows += [(5000, marked + " x", "en", "prose"), (5001, marked + " y", "en", "new source"), (5002, plain, "en", "new source")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    signals = quality.with_signals(docs)
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(signals, quality.fences(signals)).collect()}
    assert all(kept[k] for k in range(200)) and all(kept[1000 + k] for k in range(300))
    assert not kept[5000] and kept[5002]


def test_fences_follow_the_data(spark):
    """Junk beyond a wide gap goes, whatever its number; where texts vary, outliers of the words' length go; copies count once."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    prose = [" ".join(word(int(rng.integers(3, 8))) for _ in range(60)) for _ in range(400)]
    rows = [(k, t, "en", "web") for k, t in enumerate(prose)]
    rows += [(1000 + k, " ".join(word(4) + "|" for _ in range(60)), "en", "web") for k in range(30)]
    rows += [(2000 + k, " ".join(word(14) for _ in range(60)), "en", "web") for k in range(10)]
    copy = " ".join(word(4) + "&" for _ in range(40))
    rows += [(3000 + k, copy, "en", "web") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    signals = quality.with_signals(docs)
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(signals, quality.fences(signals)).collect()}
    assert sum(kept[k] for k in range(400)) >= 398
    assert not any(kept[k] for k in kept if k >= 1000)


def test_sketch_quantiles_are_near(spark):
    rng = np.random.default_rng(3)
    n = rng.integers(40, 4000, 500)
    rows = [("en", "s", int(k), int(k * 5), 0, 0, 0, 10, False) for k in n]
    signals = spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean")
    cells = quality.sketches(signals).where("signal = 'mean_word'")
    assert cells.agg(F.sum("n")).first()[0] == 500 and cells.count() == 1
    halves = [quality.sketches(part) for part in signals.randomSplit([0.5, 0.5], 1)]
    merged = quality.merged(halves[0].unionByName(halves[1]), ["lang"])
    whole = quality.merged(quality.sketches(signals), ["lang"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    training, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = toxicity.train(docs, training)
    assert len(model.weights) == 3
    scored = toxicity.score(docs.join(held, "doc_id"), model).withColumnRenamed("toxic", "verdict")
    counts = {(r[0], r[1]): r[2] for r in scored.join(held, "doc_id").groupBy("toxic", "verdict").count().collect()}
    caught, missed, false = counts.get((1, True), 0), counts.get((1, False), 0), counts.get((0, True), 0)
    assert caught / (caught + missed) > 0.75 and false / counts[(0, False)] < 0.02


def test_toxicity_odd_input(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (6, None), (8, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd_docs, toxicity.train(odd_docs, labels)).count() == odd_docs.count()
    empty = toxicity.score(odd_docs, toxicity.train(odd_docs, labels.limit(0))).collect()
    assert len(empty) == odd_docs.count() and not any(r["toxic"] for r in empty)
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels)).count() == 0


def test_scans_of_odd_and_empty_tables(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        assert secret_scan.scan(as_versions(docs)).count() == docs.count()
        assert licenses.scan(docs).count() == docs.count()


def test_base_hash_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_chain_scores_match_plain_version(spark, odd_docs, small):
    """Probabilities by plain sums over distinct words, from the weights of the chain."""
    docs = small.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    chain = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    place = {int(f): k for k, f in enumerate(chain.features)}
    read = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

    def plain(text):
        ids = {zlib.crc32(w) % 2**20 for w in (text or "").encode().translate(read).split()}
        found = []
        for w in chain.weights:
            z = sum(w[place[i]] for i in ids if i in place) + sum(p * w[len(place) + k] for k, p in enumerate(found)) + w[-1]
            found.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
        return tuple(round(p, 9) for p in found), found[-1] >= chain.threshold

    wanted = collections.Counter((r["doc_id"], *plain(r["text"])) for r in docs.collect())
    scored = toxicity.score(docs, chain).collect()
    names = ("p_severe", "p_strong", "p_toxic")
    assert collections.Counter((r["doc_id"], tuple(round(r[n], 9) for n in names), r["toxic"]) for r in scored) == wanted


def test_labels_are_chosen_among_documents_that_there_are(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(1000, 1200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1200)], "doc_id long, toxic int")
    for sample in (50, 500):
        rows = toxicity.training_rows(docs, labels, sample).collect()
        assert len({r["doc_id"] for r in rows}) == min(sample, 200) == len(rows) and min(r["doc_id"] for r in rows) >= 1000


def test_folds_learn_nothing_from_noise():
    """With labels that have nothing to do with the texts, held-out probabilities do not tell them."""
    rng = np.random.default_rng(11)
    texts = [np.unique(rng.integers(0, 3000, 60)).astype(np.int32) for _ in range(600)]
    toxic = (rng.random(600) < 0.3).astype(float)
    held_out = toxicity.out_of_fold(texts, toxic)[:, -1]
    ranks = np.argsort(np.argsort(held_out))
    area = (ranks[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (len(toxic) - toxic.sum())
    assert 0.4 < area < 0.6
