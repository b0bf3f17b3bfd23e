"""The n-gram join's pairs against all pairs in plain Python."""

import random

from strandwise.llm import ngram_join


def test_all_links_of_a_group_are_found(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        w = list(base)
        w[rnd.randrange(60)] = f"x{rnd.random()}"
        texts.append(" ".join(w))
    texts += [texts[0], " ".join(f"z{i}" for i in range(40)), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent in (70, 80, 90):
        member, links = ngram_join.linked_pairs(docs, words=3, percent=percent)
        shingles = {i: {tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for i, t in enumerate(texts) if t}
        rep = {i: min(j for j in shingles if shingles[j] == s) for i, s in shingles.items()}
        assert dict(map(tuple, member.collect())) == rep
        reps = sorted(set(rep.values()))
        want = {(a, b, len(shingles[a] & shingles[b])) for a in reps for b in reps if a < b and 100 * len(shingles[a] & shingles[b]) >= percent * len(shingles[a] | shingles[b])}
        assert set(map(tuple, links.collect())) == want and (percent == 90 or len(want) > len(reps))


def test_short_lists_are_merged_faster_than_by_a_heap():
    import heapq
    import time

    import numpy as np

    from strandwise.llm import ngram_join

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(3000, 1500)) for _ in range(200)]
    index, wanted, t = ngram_join.Index(sets), np.ones(200, bool), 700
    began = time.process_time()
    found = [index.search(q, t, wanted) for q in range(10)]
    took = time.process_time() - began
    began = time.process_time()
    for s in sets[:10]:
        at = np.searchsorted(index.tokens, s)
        skip = min(t - 1, int(t / (ngram_join.MU * np.log2((index.at[at + 1] - index.at[at]).max()) + 1)))
        assert sum(1 for _ in heapq.merge(*(index.owners[a:b].tolist() for a, b in sorted(zip(index.at[at].tolist(), index.at[at + 1].tolist(), strict=True), key=lambda x: x[1] - x[0])[: len(at) - skip])))
    assert took < time.process_time() - began
    for q, got in enumerate(found):
        assert sorted(got) == [(d, n) for d, s in enumerate(sets) if (n := len(np.intersect1d(s, sets[q]))) >= t]


def test_near_copies_without_links_meet_faster_than_pair_by_pair():
    import time

    import numpy as np

    rng = np.random.default_rng(4)
    base, sets = np.unique(rng.integers(0, 1 << 63, 400, np.uint64)), []
    for i in range(192):
        gone = rng.choice(400, 1 if i in (10, 150) else 24, replace=False)
        sets.append(np.unique(np.concatenate((np.delete(base, gone), rng.integers(0, 1 << 63, len(gone), np.uint64)))))
    sizes, asks = [len(s) for s in sets], [i < 128 for i in range(192)]
    began = time.process_time()
    found = ngram_join.chunk_links(sets, sizes, 90, list(range(192)), asks)
    took = time.process_time() - began
    began = time.process_time()
    want = []
    for i in range(128):
        for j in range(128, 192):
            n = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * n >= 90 * (sizes[i] + sizes[j] - n):
                want.append((i, j))
    assert took < (time.process_time() - began) / 4
    assert (10, 150) in found and set(found) <= set(want)  # guests meet who lives there

    def groups(links):
        label = list(range(192))
        for _ in sets:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert groups(found) == groups(want)
