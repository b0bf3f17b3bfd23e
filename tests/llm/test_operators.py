"""The ten operators and the pipeline against plain Python on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.llm import graph_search, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules, substring_dedup, tokens, toxicity
from strandwise.llm import _text

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(rng, n, kinds=200):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def corpus(seed=1, kinds=400):
    """Copies, near copies, shared passages, odd spaces, nulls, a long text, a null id and a repeated row."""
    rng = random.Random(seed)
    base = [words(rng, n, kinds) for n in (0, 1, 2, 3, 12, 13, 14, 40, 60, 120, 200)]
    passage = words(rng, 60, kinds)
    texts = [*base, *base[5:], None, "", " \n\t ", "A bé c", "a bé  c\x0bd"]
    for t in base[7:]:
        w = t.split(" ")
        for k in (1, 2, 3, 9):
            v = w.copy()
            for _ in range(k):
                v[rng.randrange(len(v))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(v).upper() if k == 1 else "  ".join(v))
        texts.append(words(rng, 30, kinds) + "\n" + passage + " " + words(rng, 20, kinds))
    texts.append(" ".join([passage] * 40) + words(rng, 3000, kinds))
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (None, base[8]), (None, None), rows[3], rows[3]]


def frame(spark, rows, source=lambda i: None):
    full = [(i, t, "en", source(i), None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).withColumn("_sw_extra", F.lit(1)).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], DOCS)


# -- shared pieces -------------------------------------------------------------------------------------------------------


def test_words_match_the_pattern():
    import pyarrow as pa

    texts = [t for _, t in corpus()]
    got = {}
    for w in _text.slices(pa.array(texts, pa.string())):
        for i, a, e in w.each():
            got[i] = [bytes(w.buf[x:y]).decode() for x, y in zip(w.starts[a:e], w.ends[a:e], strict=True)]
    assert [got[i] for i in range(len(texts))] == [brute.WORD.findall(t or "") for t in texts]


# -- 1 toxicity ----------------------------------------------------------------------------------------------------------


def test_segments():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.choice([-2, -1, -0.5, 0.25, 1, 2, 3]) + rng.random() / 97 for _ in range(rng.randrange(0, 25))]
        got = toxicity.segments(np.array(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute.segments(s)]


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        w = words(rng, 60, 300).split(" ")
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(20)] = rng.choice(["vile", "scum,", "Scum"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(900, None), (901, ""), (None, "vile scum vile scum")]
    docs, lab = frame(spark, rows), spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab, learn=F.col("doc_id") < 300)
    got = {r.doc_id: r.t for r in toxicity.toxicity(docs, model, out="t").collect()}
    assert sum((got[i].score >= 0.5) == (i % 4 == 0) for i in range(300, 400)) >= 95
    assert got[900].score == got[901].score < 0.5 and got[None].score > 0.5 and len(got) == 403
    assert all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_without_labels(spark):
    model = toxicity.fit(frame(spark, corpus()), spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.toxicity(nothing(spark), model, out="t").collect()
    assert got == [] and model.probability(0.0) == pytest.approx(toxicity.PRIOR)


# -- 2 n-gram join -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("k", "percent", "chunk"), [(3, 90, 256), (5, 80, 256), (2, 50, 4)])
def test_near_duplicates(spark, monkeypatch, k, percent, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    rows = corpus()
    got = ngram_join.near_duplicates(frame(spark, rows), words=k, percent=percent).collect()
    want = brute.components(rows, k, percent)
    sizes = {i: len(brute.shingles(t, k)) for i, t in rows if i is not None}
    assert len(got) == len(rows)
    assert all(r.component is None if r.id is None else (r.component, r.n_shingles) == (want[r.id], sizes[r.id]) for r in got)


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    rng = random.Random(9)
    w = words(rng, 100, 5000).split(" ")
    rows = []
    for i in range(60):
        v = w.copy()
        for _ in range(rng.randrange(0, 4)):
            v[rng.randrange(100)] = f"y{rng.randrange(9999)}"
        rows.append((100 - i, " ".join(v)))
    got = {r.id: r.component for r in ngram_join.near_duplicates(frame(spark, rows), words=3, percent=90).collect()}
    assert got == brute.components(rows, 3, 90)


def test_deduplicated_and_empty(spark):
    rows = corpus()
    kept = ngram_join.deduplicated(frame(spark, rows))
    want = brute.components(rows, 5, 80)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(i for i in want if want[i] == i)
    assert kept.where("doc_id is null").count() == 2 and "_sw_extra" in kept.columns
    assert ngram_join.near_duplicates(nothing(spark)).count() == 0


# -- 3 mixing ------------------------------------------------------------------------------------------------------------


def targets(sizes, weights=(3, 1, 2)):
    """By rounds: share, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(1, 40))) for i in range(3000)] + [(None, None), (None, "a b"), (1, "q"), (1, "q")]
    source = lambda i: None if i is None else ("small" if i % 50 == 0 else "hot" if i % 3 else f"s{i % 4}")
    docs = frame(spark, rows, source)
    plan = mixing.mixing_plan(docs).collect()
    sizes = {}
    for r in plan:
        assert r.size == len(brute.WORD.findall(r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert taken["hot"] == pytest.approx(want["hot"], rel=0.1)
    assert sorted((r.doc_id or -1, r.taken) for r in plan) == sorted((r.doc_id or -1, r.taken) for r in mixing.mixing_plan(docs.repartition(5)).collect())
    mixed = mixing.mixing(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in plan)
    assert mixing.mixing(nothing(spark)).count() == 0


# -- 4 substring dedup ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_substring_dedup(spark, batches):
    rows = corpus()
    got = substring_dedup.substring_dedup(frame(spark, rows), batches=batches, texts=True).collect()
    want = sorted((-1 if i is None else i, len(brute.WORD.findall(t or "")), " ".join(k)) for (i, t), k in zip(rows, brute.removed(rows), strict=True))
    assert sorted((-1 if r.id is None else r.id, r.n_words, r.kept_text) for r in got) == want
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 and r.n_removed == r.n_words - len(r.kept_text.split()) for r in got)


def test_texts_under_one_id_lose_their_own_words(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (5, "x " + a), (5, b), (5, "x y " + b), (9, b)]
    got = substring_dedup.substring_dedup(frame(spark, rows), batches=3, texts=True).collect()
    want = [(i, " ".join(k)) for (i, _), k in zip(rows, brute.removed(rows), strict=True)]
    assert sorted((r.id, r.kept_text) for r in got) == sorted(want)


def test_runs_are_sorted_and_compacted(spark):
    rows = sorted((i, t) for i, t in corpus() if i is not None)
    index, marked = substring_dedup.FingerprintIndex(spark), set()
    for a in range(0, len(rows), 9):
        part = spark.createDataFrame(rows[a : a + 9], "id long, text string")
        before = {n: {r.p: r.run for r in index.run(n).collect()} for _, n in index.runs}
        marked |= {(r.id, r.pos + j) for r in index.add(part).collect() for j in range(r.n)}
        assert all({r.p: r.run for r in index.run(n).collect()} == before[n] for _, n in index.runs if n in before)  # immutable
        for _, n in index.runs:
            for r in index.run(n).collect():
                x = substring_dedup.unplanes(r.run, 8)
                assert (x[1:] > x[:-1]).all()
    assert len(index.runs) < 5 and max(level for level, _ in index.runs) >= 2
    texts = {i: brute.WORD.findall(t or "") for i, t in rows}
    held = sum(len(substring_dedup.unplanes(r.run, 8)) for _, n in index.runs for r in index.run(n).collect())
    seen, want = {}, set()
    for i in sorted(texts):
        for p in range(len(texts[i]) - 12):
            if seen.setdefault(tuple(texts[i][p : p + 13]), i) < i:
                want.add((i, p))
    index.compact()
    assert marked == want and held >= len(seen)
    index.drop()


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.substring_dedup(nothing(spark)).count() == 0


# -- 5 quality classifier ------------------------------------------------------------------------------------------------


def test_estimate_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.7])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = -1
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    m = quality_model.estimate(patterns, n.astype(float))
    assert abs(m.good - 0.8) < 0.05 and ((m.posterior(votes) > 0.5) == truth).mean() > 0.93
    assert (np.diff(m.chance[:, 1, 1] / (m.chance[:, 1, 0] + m.chance[:, 1, 1])) < 0).all()


def test_quality_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame([(None, None, None, None, None), (7000, "", None, None, None)], DOCS))
    docs = docs.unionByName(odd)
    _, scorer = quality_model.fit(docs)
    got = quality_model.quality_scores(docs, scorer, out="s")
    assert got.where("s is null or s < 0 or s > 1").count() == 0 and got.count() == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    hit = got.join(labels, "doc_id").agg(F.avg(((F.col("s") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert hit > 0.85
    assert quality_model.fit(nothing(spark))[0] is None


# -- 6 token counts and 10 packing ---------------------------------------------------------------------------------------


def test_chunks_equal_the_library():
    coder = tokens.coder(tokens.default_path())
    memo, ids = tokens.Counts(coder, frozenset(coder.whole_tokens())), tokens.Ids(coder)
    rng = random.Random(4)
    letters = " \n\tab'sé日\U0001f6421.,<|>endoftext 　\x1c\x85 ᠎​"
    texts = ["<|endoftext|> a b", "it's we'll 'S 12 345 ab12", "a  b", " a", "a ", ""] + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for t in texts:
        want = coder.library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids.ids(t), "<u4").tolist() == want and memo.count(t) == len(want)


def test_token_counts(spark):
    rows = corpus()
    library = tokens.coder(tokens.default_path()).library
    got = tokens.token_counts(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    assert tokens.token_counts(nothing(spark)).count() == 0


def test_differencing_is_near_equal():
    rng = random.Random(6)
    sizes = [rng.randrange(1, 257) for _ in range(300)]
    windows = packing.differencing(sizes, 37)
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert sorted(i for w in windows for i in w) == list(range(300)) and max(sums) - min(sums) < 40
    assert all(sum(sizes[i] for i in w) <= 1024 for w in packing.packed(sizes, 1024))
    assert packing.packed([], 10) == [] and len(packing.packed([10, 10, 10], 10)) == 3


def test_packing(spark):
    rows = corpus()
    library = tokens.coder(tokens.default_path()).library
    got = packing.packing(frame(spark, rows)).collect()
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    assert sum(r.length for r in got) == sum(len(x) for _, x in ids)
    once = {i: np.array(x, "<u4") for i, x in ids if sum(1 for j, _ in rows if j == i) == 1}
    for i, x in once.items():
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine[:-1]]))
        assert all(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(x) for r in mine)
    for s in {r.sequence_id for r in got}:
        mine = sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in mine] == list(np.cumsum([0] + [r.length for r in mine[:-1]])) and sum(r.length for r in mine) <= 1024
    assert packing.packing(nothing(spark)).count() == 0


# -- 7 quality rules -----------------------------------------------------------------------------------------------------


def test_statistics(spark):
    rows = [*corpus(), (77, "a b c a b c\n\nx\nx\n x\n#|$ & é"), (78, "a a a a a")]
    for r in quality_rules.statistics(frame(spark, rows)).collect():
        assert tuple(r.stats) == brute.statistics(r.text)


def test_covering_finds_a_threshold(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(600):
        x = {"a": rng.random(), "b": rng.random()}
        rows.append((x, int(not (x["a"] > 0.7 and x["b"] <= 0.5))))
    rules = quality_rules.covering(rows)
    assert rules and sum((not any(r.meets(x) for r in rules)) == bool(y) for x, y in rows) / len(rows) > 0.95
    df = spark.createDataFrame([(x["a"], x["b"]) for x, _ in rows[:50]], "a double, b double")
    got = [r.v for r in df.select(quality_rules.verdict(rules, {"a": F.col("a"), "b": F.col("b")}).alias("v")).collect()]
    assert got == [next((i for i, r in enumerate(rules, 1) if r.meets(x)), 0) for x, _ in rows[:50]]
    assert quality_rules.covering([]) == []


def test_quality_rules(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out, _ = quality_rules.quality_rules(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.base_failed and r.kept) for r in rows)
    assert quality_rules.quality_rules(nothing(spark), labels)[0].count() == 0


# -- 8 line dedup --------------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        host = None if i % 7 == 0 else "hot" if i % 2 else f"h{i % 3}"
        lines = [f"line {rng.randrange(40)}" for _ in range(4)] + ["", " footer\t", "footer"]
        rows.append((i, host, None if i == 5 else "" if i == 6 else "\n".join(lines)))
    rows += [(None, "hot", "footer\nx"), rows[9], rows[9]]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string").withColumn("n", F.lit(1)).repartition(3)
    got = line_dedup.line_dedup(docs, host="host", ratio=0.2, min_pages=3).collect()
    want = brute.line_dedup(rows, 0.2, 3)
    key = lambda t: (t[0] is None, t[0] or 0, t[1] is None, t[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(((i, t) for (i, _, _), t in zip(rows, want, strict=True)), key=key)
    assert line_dedup.line_dedup(docs.limit(0), host="host").count() == 0


# -- 9 graph search ------------------------------------------------------------------------------------------------------


def neighbours(v, i, k):
    s = v @ v[i]
    return [j for j in np.lexsort((np.arange(len(v)), -s)) if j != i][:k], s


def test_graph_recall_and_pruning():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 24))
    g = graph_search.Graph(x, degree=24, beam=48)
    hit = g.search(x[:50].astype(np.float32), 80)
    exact = np.argsort(-(x[:50] @ x.T), 1)[:, :10]
    assert np.mean([len(set(h[:80]) & set(e)) / 10 for h, e in zip(hit, exact, strict=True)]) > 0.9
    assert (g.edges[:, 0] >= 0).all() and g.edges.shape[1] == 25 and len(np.unique(g.edges)) == 1501  # -1, and an edge to each node


@pytest.mark.parametrize("spread", ["equal", "normal", "lognormal"])
def test_recall_of_the_query(spark, spread):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(8400, 64))
    if spread != "normal":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if spread == "lognormal":
        v *= np.exp(rng.normal(size=(len(v), 1)))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in graph_search.nearest(df, df.where("vec_id % 20 = 0")).collect():  # eight shards, the parameters of op9
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(got) == 420
    assert np.mean([len(got[i] & set(neighbours(v, i, 20)[0])) / 20 for i in got]) >= 0.93


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(700, 8)).astype(np.float32)
    v[100:160] = v[100]
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(v)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (920, [1.0]), (941, [2.0]), (None, [1.0] * 8), (960, []), rows[3], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("score", F.lit(1))
    for shards, few in ((1, 1024), (5, 50)):
        graph_search.FEW, kept = few, graph_search.FEW
        got = {}
        for r in graph_search.nearest(df, df.where("vec_id % 20 = 0"), k=5, shards=shards).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        graph_search.FEW = kept
        full, hits = v.astype(np.float64), 0
        assert got.pop(920) == [(1, 941, 2.0)]  # vectors of one component are searched by themselves
        assert sorted(got) == list(range(0, 700, 20))
        for i, found in got.items():
            found.sort()
            order, s = neighbours(full, i, 5)
            hits += len({x[1] for x in found} & set(order))
            assert [x[0] for x in found] == [1, 2, 3, 4, 5] and all(abs(x[2] - s[x[1]]) < 1e-9 for x in found)
        assert hits / (5 * len(got)) > 0.95
        assert [x[1] for x in got[120]] == neighbours(full, 120, 5)[0]  # 60 equal vectors: the least ids
    assert graph_search.nearest(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id < 3")
    assert graph_search.nearest(few, few, k=5).count() == 6


# -- pipeline ------------------------------------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        from strandwise.llm._runtime import stored

        seen.append(stored(stage(spark, seen[-1], SF), "t"))
        if len(seen) < 6:
            assert seen[-1].columns == docs.columns
    assert 0.8 * docs.count() < seen[1].count() <= docs.count() and seen[2].count() == seen[1].count()
    rows = [(r.doc_id, r.source, r.text) for r in seen[1].collect()]
    want = brute.line_dedup(rows, line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in seen[2].collect()) == sorted((i, t, len(t)) for (i, _, _), t in zip(rows, want, strict=True))
    two = [(r.doc_id, r.text) for r in seen[2].collect()]
    part = brute.components(two, 5, 80)
    assert sorted(r.doc_id for r in seen[3].collect()) == sorted(i for i in part if part[i] == i)
    taken = {r.doc_id: r.copies for r in mixing.mixing_plan(seen[3]).collect()}
    got = [r.doc_id for r in seen[4].collect()]
    assert all(got.count(i) == n for i, n in taken.items())
    library = tokens.coder(tokens.default_path()).library
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in seen[4].collect())
    assert sum(r.length for r in seen[5].collect()) == total
