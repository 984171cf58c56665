"""Line de-duplication and near copies against plain versions; the pipeline."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfold.llm import line_dedup, near_copies

COLUMNS = ["doc_id", "text"]
BLANKS = " \t\n\x0b\x0c\r"


def plain_line_dedup(rows):
    """rows: (doc_id, text); rows equal in both are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for doc_id, text in order:
        lines = text.split("\n") if text is not None else []
        covered = set()
        for k in range(len(lines) - 2):
            window = tuple(x.strip(BLANKS) for x in lines[k : k + 3])
            if any(window):
                if window in seen:
                    covered |= {k, k + 1, k + 2}
                seen.add(window)
        kept = "\n".join(x for k, x in enumerate(lines) if k not in covered) if text is not None else None
        out[(doc_id, text)] = (kept, len(lines), len(covered))
    return collections.Counter((r[0], *out[r]) for r in rows)


def lines_of(docs):
    found = line_dedup.deduplicated(docs)
    return collections.Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found.collect())


def test_line_dedup_matches_plain_version(spark, odd_docs, small):
    rng = random.Random(4)
    pool = [f"line {k} of the pool" for k in range(12)] + ["", "  "]
    made = [(5000 + k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for k in range(150)]
    made += [(9000, "a\nb\nc\na\nb\nc\na\nb\nc"), (9001, " a\nb \n\tc\r"), (9002, "x\nx\nx\nx\nx")]
    docs = odd_docs.select(*COLUMNS).unionByName(small.select(*COLUMNS)).unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    # Which of two texts of one id comes first is open, so ids differ here but for repeated rows.
    docs = docs.dropDuplicates(["doc_id"]).unionByName(odd_docs.select(*COLUMNS).where("doc_id = 2").limit(1))
    rows = [tuple(r) for r in docs.collect()]
    assert lines_of(docs) == plain_line_dedup(rows)


def test_line_dedup_is_native_and_keeps_columns(odd_docs, no_docs):
    found = line_dedup.deduplicated(odd_docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert found.columns == [*odd_docs.columns, "n_lines", "n_removed"] and found.count() == odd_docs.count()
    assert line_dedup.deduplicated(no_docs).count() == 0


def plain_shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    n = min(5, len(words))
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
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_of(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copies.near_copies(docs).collect()}


def variants(rng, base, n, edits, first):
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append((first + k, " ".join(words)))
    return out


@pytest.mark.parametrize("small_node", [2048, 3])
def test_near_copies_match_plain_version(spark, small, monkeypatch, small_node):
    """With nodes of three members at most compared in one task, the trees have to branch."""
    monkeypatch.setattr(near_copies, "SMALL", small_node)
    rng = random.Random(small_node)
    word = lambda: f"w{rng.randrange(3000)}"
    made = []
    for family in range(12):
        made += variants(rng, [word() for _ in range(rng.choice((6, 20, 60, 200)))], 12, rng.choice((1, 3, 8)), 10_000 + 100 * family)
    shared = [word() for _ in range(60)]  # a passage in many documents
    made += [(30_000 + k, " ".join([word() for _ in range(40)] + shared + [word() for _ in range(40)])) for k in range(80)]
    docs = small.select(*COLUMNS).unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    assert near_of(docs) == plain_components([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("between", [0.6, 0.66, 0.7, 0.73])
def test_near_copies_inside_a_template(spark, monkeypatch, between):
    """Documents of one template are not linked with each other; the pairs planted among them are found."""
    monkeypatch.setattr(near_copies, "SMALL", 30)
    n = 400  # shingles; a template share of t in each set gives the similarity t / (2 - t)
    shared, both = round(n * 2 * between / (1 + between)), round(n * 2 * 0.755 / 1.755)
    template = [f"t{k}" for k in range(shared + 4)]
    own = lambda name, k: [f"{name}x{j}" for j in range(k)]
    rows = [(k, " ".join(template + own(k, n - shared))) for k in range(2400)]
    for k in range(30):
        pair = template + own(f"p{k}", both - shared)
        rows += [(10_000 + 2 * k + side, " ".join(pair + own(f"q{k}s{side}", n - both))) for side in (0, 1)]
    found = near_of(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == {i: (n, i - i % 2 if i >= 10_000 else i) for i, _ in rows}


@pytest.mark.parametrize("few", [20_000, 0])
def test_near_copies_of_a_chain(spark, monkeypatch, few):
    """Neighbours are linked, ends are not: one component all the same, joined in one task or by star steps."""
    monkeypatch.setattr(near_copies, "FEW_LINKS", few)
    words = [f"w{k}" for k in range(200)]
    rows = [(100 - k, " ".join(words[4 * k : 4 * k + 60])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_of(docs) == plain_components(rows)


def test_near_copies_of_odd_and_empty_tables(odd_docs, no_docs):
    rows = near_copies.near_copies(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == [(6, 1, True)] and by_id[2] == [(6, 1, False)] * 2
    assert by_id[3] == [(0, 3, True)] and by_id[4] == [(0, 4, True)]
    assert by_id[11] == [(1, 10, False)] and by_id[7][0][1:] == (6, False)
    assert by_id[None][0][1:] == (None, True)
    assert near_copies.near_copies(no_docs).count() == 0


def test_pipeline_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * docs.count(), name
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, docs, "").columns


def test_pipeline_runs_through(spark):
    folder = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, folder).collect()
    sequences = collections.defaultdict(int)
    for r in packed:
        sequences[r["sequence_id"]] += r["length"]
    assert packed and max(sequences.values()) <= 2048
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    clean = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").join(docs.where(F.size(F.split("text", " ")) > 30), "doc_id")
    assert kept.join(clean.select("doc_id"), "doc_id").count() >= 0.95 * clean.count()


def test_near_dedup_stage_drops_copies_only(spark, odd_docs):
    """Rows without an id, and different texts of one id, are documents of their own."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base), (2, base + " end"), (None, "no id and some words of its own"), (None, "no id but other words than the first one has")]
    rows += [(None, base + " more"), (7, "one text of the repeated id seven"), (7, "and quite another text of this id"), (9, ""), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    found = collections.Counter(tuple(r)[:2] for r in left.collect())
    of_base = [t for _, t in found if t and t.startswith(base)]
    assert len(of_base) == 1
    assert found - collections.Counter({k: 1 for k in found if k[1] in of_base}) == collections.Counter([r for r in rows[2:4]] + rows[5:9])


def test_no_stage_loses_rows_for_their_ids(spark, small):
    docs = small.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("doc_id") % 50).cast("long"))
    kept, wanted = (corpus_pipeline.keep_good(spark, d, "").count() for d in (docs, small))
    assert kept == wanted
    assert corpus_pipeline.drop_repeated_lines(spark, docs, "").count() > 0
    texts = lambda df: collections.Counter(r["text"] for r in df.collect())
    assert len(texts(corpus_pipeline.drop_near_copies(spark, docs, ""))) == len(texts(corpus_pipeline.drop_near_copies(spark, small, "")))
    assert sum(texts(corpus_pipeline.mix_sources(spark, docs, "")).values()) > 0
