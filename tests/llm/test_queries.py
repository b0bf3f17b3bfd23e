"""The registered queries over whole small tables against plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwise.llm import _runtime, _text, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules, queries, substring_dedup, tokens, toxicity

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]


def run(spark, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def buckets(text):
    return [b for w in _text.slices(pa.array([text or ""]), toxicity.SEP, _text.LOWER) for b in toxicity.buckets(w.hashes).tolist()]


def test_op1(spark, texts, labels):
    got = run(spark, "op1_toxicity")
    assert set(got) == set(texts) and all(r.held_out == held_out(i) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    # the model again, in plain Python
    train = {}
    for r in labels:
        if r["toxic"] is not None and not held_out(r["doc_id"]) and r["doc_id"] in texts:
            train[r["doc_id"]] = max(r["toxic"], train.get(r["doc_id"], 0))
    n = {0: {}, 1: {}}
    for i, y in train.items():
        for b in buckets(texts[i]):
            n[y][b] = n[y].get(b, 0) + 1
    every = set(n[0]) | set(n[1])
    prior = {b: toxicity.PRIOR_WEIGHT * (n[0].get(b, 0) + n[1].get(b, 0) + 0.01) for b in every}
    size = 1 << toxicity.BUCKET_BITS
    a0 = sum(prior.values()) + toxicity.PRIOR_WEIGHT * 0.01 * (size - len(every))
    total = {y: sum(n[y].values()) for y in n}
    score = {}
    for b in every:
        odds = {y: n[y].get(b, 0) + prior[b] for y in n}
        delta = sum(s * math.log(odds[y] / (total[y] + a0 - odds[y])) for y, s in ((1, 1), (0, -1)))
        sd = math.sqrt(1 / odds[0] + 1 / odds[1])
        score[b] = math.copysign(max(0.0, abs(delta) - toxicity.CONFIDENCE * sd), delta) - toxicity.DRIFT
    docs, labs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labs, learn=~queries.held_out())
    assert all(model.scores[b] == pytest.approx(s, abs=1e-4) for b, s in score.items())
    # lambda: the expected exp(lambda s) of a clean token is 1; K: as many chance passages as the lower nine tenths of clean texts have
    if any(s > 0 for b, s in score.items() if b in n[0]):
        assert sum(c / total[0] * math.exp(model.lam * score[b]) for b, c in n[0].items()) == pytest.approx(1, abs=1e-3)
    best = [(len(t), max((x[2] for x in toxicity.segments(np.array([score[b] for b in t]))), default=0.0)) for t in (buckets(texts[i]) for i, y in train.items() if not y) if t]
    cut = max(np.quantile([s for _, s in best], 0.9), 1e-9)
    low = [(m, s) for m, s in best if s <= cut + 1e-6]
    assert model.k == pytest.approx(min(1, max(1e-6, len(low) / sum(m * math.exp(-model.lam * s) for m, s in low))), rel=0.05)
    # evidence by the definition of maximal segments
    for i, t in texts.items():
        s = [score.get(b, -toxicity.DRIFT) for b in buckets(t)]
        if len(s) <= 60:
            e = [model.k * len(s) * math.exp(-model.lam * x[2]) for x in brute.segments(s)]
            x = sum(-math.log(max(v, 1e-300)) for v in e if v < toxicity.SIGNIFICANT)
            assert got[i].score == pytest.approx(1 / (1 + math.exp(-(model.base + model.slope * math.log1p(x)))), abs=2e-3)


def test_op2(spark, texts):
    got = run(spark, "op2_ngram_join")
    want = brute.components(sorted(texts.items()), 3, 90)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(brute.shingles(t, 3)), want[i]) for i, t in texts.items()}


def test_op4(spark, texts):
    got, rows = run(spark, "op4_substring_dedup"), sorted(texts.items())
    for (i, t), kept in zip(rows, brute.removed(rows), strict=True):
        n = len(brute.WORD.findall(t or ""))
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def test_op5(spark, texts, labels):
    got = run(spark, "op5_quality_model")
    assert set(got) == set(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    known = [(got[r["doc_id"]].predicted, r["quality"]) for r in labels if r["quality"] is not None]
    assert np.mean([p == y for p, y in known]) > 0.85


def test_op5_scorer_alone_follows_the_posterior():
    """A hashed scorer that is shown posteriors of planted texts gives unseen ones the same side."""
    rng = random.Random(3)
    good, poor = [f"good{i}" for i in range(300)], [f"###{i}" for i in range(300)]
    made = [(rng.choices(good if y else poor, k=60), y) for y in [1, 0] * 200]
    rows = []
    for w in _text.slices(pa.array([" ".join(x) for x, _ in made]), table=_text.LOWER):
        odd = quality_model.odd_bytes(w)
        rows += [quality_model.features(w, a, e, odd) for _, a, e in w.each()]
    scorer = quality_model.train([(f, v, 0.95 if y else 0.05) for (f, v), (_, y) in zip(rows[:300], made[:300], strict=True)], 0.5)
    assert all((scorer.score(f, v) >= 0.5) == bool(y) for (f, v), (_, y) in zip(rows[300:], made[300:], strict=True))


def test_op6(spark, texts):
    library = tokens.coder(tokens.default_path()).library
    got = run(spark, "op6_token_counts")
    for i, t in texts.items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512)


def test_op7(spark, texts, labels):
    got = run(spark, "op7_quality_rules")
    stats = {i: brute.statistics(t) for i, t in texts.items()}
    failed = {i: s[0] < 50 or 100 * s[4] > 50 * s[0] for i, s in stats.items()}
    over = lambda a, b: a / b if b else 0.0
    features = {
        i: {"n_words": float(n), "word_length": over(c, n), "symbol_share": over(s, c), "dup_lines": float(d), "dup_lines_per_word": over(d, n), "repeat_share": over(r, n)}
        for i, (n, c, s, d, r) in stats.items()
    }
    y = {}
    for r in labels:
        if r["quality"] is not None and r["doc_id"] in texts and not failed[r["doc_id"]]:
            y[r["doc_id"]] = max(r["quality"], y.get(r["doc_id"], 0))
    order = sorted(y, key=lambda i: zlib.crc32(str(i).encode()))
    rules = quality_rules.covering([(features[i], int(y[i] > 0)) for i in order])
    for i, r in got.items():
        number = 0 if failed[i] else next((k for k, rule in enumerate(rules, 1) if rule.meets(features[i])), 0)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.rule, r.kept) == (*stats[i], failed[i], number, not failed[i] and number == 0)


def test_op7_grows_the_best_condition():
    """The first condition has the greatest gain of all thresholds, found by trying each."""
    rng = random.Random(6)
    rows = [({"a": x, "b": rng.random()}, int(not (x > 0.62 and rng.random() < 0.9))) for x in (rng.random() for _ in range(120))]
    feature, op, cut = quality_rules._grow(rows, ["a", "b"])[0]
    p, n = sum(1 for _, y in rows if not y), sum(1 for _, y in rows if y)

    def gain(f, o, v):
        met = [y for x, y in rows if (x[f] > v) == (o == ">")]
        a = met.count(0)
        return a * (math.log2(a / len(met)) - math.log2(p / (p + n))) if a >= quality_rules.MIN_COVER else 0

    best = max(gain(f, o, v) for f in "ab" for o in (">", "<=") for v in quality_rules._cuts([x[f] for x, _ in rows]))
    assert feature == "a" and op == ">" and gain(feature, op, cut) == pytest.approx(best)


def test_op9(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    ids, v = np.array([i for i, _ in rows]), np.stack([x for _, x in rows])
    got = {}
    for r in queries.op9_graph_search(spark, SF).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = v @ v[ids.tolist().index(q)]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        assert sorted(found) == list(range(1, 21)) and all(abs(s[ids.tolist().index(j)] - x) < 1e-12 for j, x in found.values())
        assert [found[k] for k in sorted(found)] == sorted(found.values(), key=lambda x: (-x[1], x[0]))
        hits += len({ids[j] for j in order} & {j for j, _ in found.values()})
    assert hits >= 0.9 * 20 * len(got)


def test_op10(spark, texts):
    library = tokens.coder(tokens.default_path()).library
    by, seq = {}, {}
    for r in queries.op10_packing(spark, SF).collect():
        by.setdefault(r.doc_id, []).append(r)
        seq.setdefault(r.sequence_id, []).append(r)
    assert set(by) == set(texts)
    for i, rows in by.items():
        x, at = np.array(library.encode(texts[i] or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
            at += r.length
        assert at == len(x)
    for rows in seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0] + [r.length for r in rows[:-1]]).tolist() and sum(r.length for r in rows) <= 1024
    assert sum(r.length for rows in by.values() for r in rows) / (1024 * len(seq)) > 0.9


def test_pages(spark):
    rows = [
        (1, "HTTPS://A.org:8/x?y", "<p>one<br>two</p><script>bad()</script>"), (2, "no address", "<div>x</div>\n\n\n<!-- y --><style>z</style>w"), (3, None, None), (4, "https:///p", ""), (5, "ftp://b/", "<b>bold</b> text"),
    ]
    got = {r.page_id: (r.host, r.text) for r in line_dedup.page_lines(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[1] == ("a.org:8", "\none\ntwo\n") and got[2] == (None, "\nx\nw") and got[3] == (None, None) and got[4] == (None, "") and got[5] == ("b", "bold text")


CLASHES = ["size", "taken", "score", "n_tokens", "rule", "kept", "host", "rank", "id", "a", "n", "label", "chunk", "leader", "component", "stats", "_sw_host", "_sw_row", "_sw_line", "_sw_words", "_SW_stats", "_i"]


def test_columns_of_any_name(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(60)) + "\nfooter", "s") for i in range(12)]
    rows.append((50, rows[0][1], "s"))
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = plain.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    lab = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    own = {c: f"own {c}" for c in CLASHES}

    def passed(out, but=()):
        return all(r[c] == own[c] for r in out.collect() for c in CLASHES if c not in but)

    unique = _runtime.stored(ngram_join.deduplicated(docs), "unique")
    assert passed(unique) and unique.count() == 12 and unique.columns == docs.columns
    assert passed(toxicity.toxicity(docs, toxicity.fit(docs, lab), out="t")) and passed(mixing.mixing(docs))
    assert passed(mixing.mixing_plan(docs), ("size", "taken")) and passed(line_dedup.line_dedup(docs, host="source")) and passed(tokens.token_counts(docs), ("n_tokens",))
    assert passed(quality_rules.quality_rules(docs, lab)[0], ("rule", "kept")) and passed(quality_rules.statistics(docs, out="st"))
    cut = {r.id: r.n_words - r.n_removed for r in substring_dedup.substring_dedup(docs).collect()}
    assert cut == {i: len(k) for (i, _, _), k in zip(rows, brute.removed([r[:2] for r in rows]), strict=True)} and packing.packing(docs).count() >= 13


def test_different_texts_under_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b + " c"), (4, ""), (4, None), (None, a)]
    got = sorted((r.doc_id or -1, r.text or "") for r in ngram_join.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(1, a), (1, b), (4, ""), (4, ""), (-1, a)])


def test_templates_that_do_not_link(spark):
    """Texts of one template that share 85 hundredths, among them real near copies."""
    rng = random.Random(4)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w = base.copy()
        w[10:16] = [f"own{i}x{j}" for j in range(6)]
        w[100:106] = [f"own{i}y{j}" for j in range(6)]
        rows.append((3 * i, " ".join(w)))
        if i % 3 == 0:
            w[rng.randrange(120, 200)] = "z"
            rows.append((3 * i + 1, " ".join(w)))
    got = {r.id: r.component for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=90).collect()}
    assert got == brute.components(rows, 3, 90) and len(set(got.values())) == 90


def test_very_long_texts(spark):
    rng = random.Random(2)
    w = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    near = w.copy()
    near[500] = near[40_000] = "other"
    rows = [(1, " ".join(w)), (2, " ".join(near)), (3, "x " + " ".join(w[100:400]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.component for r in ngram_join.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    got = {r.id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {i: (len(t.split()), len(t.split()) - len(k)) for (i, t), k in zip(rows, brute.removed(rows), strict=True)}
    library = tokens.coder(tokens.default_path()).library
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(docs).collect()} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_pipeline_of_nothing(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
