import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from spliceloom.llm import queries, toxicity
from spliceloom.llm.common import crc_mod

C = toxicity.Constants(3.0, 4.0, 0.5)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_recall_and_precision(spark, sf):
    """Held-out rows as good as the folds of the learnable ones promise, by three standard errors of both."""
    d = f"/root/testdata/{sf}"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = queries.op7_toxicity(spark, d).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r for r in rows}
    truth = [(r.toxic, got[r.doc_id]) for r in labels.collect() if r.toxic is not None]
    held = [(t, r.predicted) for t, r in truth if r.held_out]
    known = toxicity.sample(docs, labels, crc_mod("doc_id", 3) != 1, toxicity.SAMPLE_ROWS, "doc_id", "text", "toxic")
    chosen, loss, recall, wrong = toxicity.choose(known)
    n = known.groupBy("toxic").count().collect()
    size = {r.toxic: r["count"] for r in n}
    print(sf, chosen, recall, wrong, np.mean([p for t, p in held if t]), np.mean([p for t, p in held if not t]), sorted(loss.values())[:4])
    for label, share in ((1, recall), (0, wrong)):
        of = [p for t, p in held if t == label]
        share = min(max(share, 0.01), 0.99)
        margin = 3 * math.sqrt(share * (1 - share) * (1 / len(of) + 1 / size[label]))
        assert np.mean(of) >= share - margin if label else np.mean(of) <= share + margin
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_choice_is_the_least_loss_of_left_out_folds(spark):
    """Against a plain loop over folds and constants; labels of rows not learned from change nothing."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    grid = [toxicity.GRID[0], toxicity.GRID[-1]]
    known = toxicity.sample(docs, labels, crc_mod("doc_id", 3) != 1, 300, "doc_id", "text", "toxic")
    best, loss, recall, wrong = toxicity.choose(known, grid)
    for c in grid:
        total, hits = [], []
        for fold in range(toxicity.FOLDS):
            rest = known.where(F.col("fold") != fold)
            voters = toxicity.all_voters(toxicity.mine(rest)[0])
            f = toxicity.fired(rest, voters)
            q, bad, good, _ = toxicity.label_model(f.row, f.voter, len(f.toxic), len(voters), f.toxic, c)
            strong, w = toxicity.classifier(bad, good, f, q, c, toxicity.FOLD_STEPS)
            own = known.where(F.col("fold") == fold).withColumn("id", F.xxhash64("text"))
            scored = toxicity.score(own.select("id", "text"), (voters, strong, w), key="id").collect()
            truth = {r.id: r.toxic for r in own.collect()}
            total += [-math.log(min(max(r.score if truth[r.doc_id] else 1 - r.score, 1e-6), 1)) for r in scored]
            hits += [r.predicted for r in scored if truth[r.doc_id]]
        assert loss[c] == pytest.approx(np.mean(total), rel=1e-4)
        assert c != best or recall == pytest.approx(np.mean(hits))
    assert best == min(grid, key=loss.get) and 0 <= wrong <= 1
    one = known.withColumn("toxic", F.lit(0))
    assert toxicity.choose(one, grid)[0] == grid[0]


def made(n=4000, seed=0):
    """Firings of a good voter, a fair one, one of chance and a near copy of the first; labels with errors; the truth."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.2
    fires = np.stack([np.where(y, rng.random(n) < a, rng.random(n) < b) for a, b in ((0.7, 0.02), (0.5, 0.01), (0.1, 0.1))] + [np.zeros(n, bool)])
    fires[3] = fires[0] & (rng.random(n) < 0.95)
    return fires, np.where(rng.random(n) < 0.05, ~y, y).astype(float), y


def test_label_model_finds_good_and_bad_voters():
    fires, toxic, y = made()
    row, voter = np.nonzero(fires.T)
    q, bad, good, parent = toxicity.label_model(row, voter, len(y), 4, toxic, C)
    # silent voters abstain, so rates lean towards each other, but keep their order
    assert abs(bad[0] - 0.7) < 0.15 and abs(good[0] - 0.02) < 0.02 and abs(bad[2] - good[2]) < 0.05
    assert parent[3] == 0 and parent[0] == parent[2] == -1  # the copy depends on its model, the voter of chance on none
    assert np.mean((q > 0.5) == y) > np.mean(toxic == y)
    # the copy adds nothing: rows on which both fire are as sure without it
    alone, *_ = toxicity.label_model(*np.nonzero(fires[:3].T), len(y), 3, toxic, C)
    both = fires[0] & fires[3]
    assert np.abs(q[both] - alone[both]).mean() < 0.03


def brute_label_model(fires, toxic, parents, rounds=15):
    """The same expectation maximisation, one row and one voter at a time."""
    j, n = fires.shape
    q = [min(max(t, 0.05), 0.95) for t in toxic]
    prior = math.log((sum(toxic) + 0.5) / (n - sum(toxic) + 0.5))
    for parent, weight in parents:
        for _ in range(rounds):
            rate = {}
            for c in (1, 0):
                w = [x if c else 1 - x for x in q]
                for v in range(j):
                    p = parent[v]
                    for up in (0, 1) if p >= 0 else (0,):
                        of = [i for i in range(n) if p < 0 or fires[p][i] == up]
                        rate[c, v, up] = (sum(w[i] for i in of if fires[v][i]) + 0.1) / (sum(w[i] for i in of) + 1)
            hit = (sum(x * t for x, t in zip(q, toxic)) + 1) / (sum(q) + 2)
            miss = (sum((1 - x) * t for x, t in zip(q, toxic)) + 0.1) / (n - sum(q) + 1)
            new = []
            for i in range(n):
                z, silent = prior + (math.log(hit / miss) if toxic[i] else math.log((1 - hit) / (1 - miss))), 0.0
                for v in range(j):
                    up = int(parent[v] >= 0 and fires[parent[v]][i])
                    a, b = rate[1, v, up], rate[0, v, up]
                    if fires[v][i]:
                        z += weight[v] * math.log(a / b)
                    else:
                        silent += weight[v] * math.log((1 - a) / (1 - b))
                z += max(-C.silent, silent)
                new.append(min(max(1 / (1 + math.exp(-min(max(z, -30), 30))), 1e-4), 1 - 1e-4))
            settled = max(abs(a - b) for a, b in zip(q, new)) < 1e-4
            q = new
            if settled:
                break
    return q


def test_label_model_equals_brute_force(monkeypatch):
    fires, toxic, _ = made(300, 3)
    seen, tree = [], toxicity.voter_tree
    monkeypatch.setattr(toxicity, "voter_tree", lambda *a: seen.append(tree(*a)) or seen[-1])
    q, *_ = toxicity.label_model(*np.nonzero(fires.T), 300, 4, toxic, C)
    assert seen[0][0][3] == 0
    assert np.allclose(q, brute_label_model(fires, toxic, seen), atol=1e-6)


def test_tree_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n, j = 200, 5
        fires = rng.random((j, n)) < rng.uniform(0.05, 0.5, (j, 1))
        fires[2] = np.where(rng.random(n) < 0.9, fires[0], fires[2])
        fires[4] = np.where(rng.random(n) < 0.9, fires[0], fires[4])
        q = rng.random(n)
        got, weight = toxicity.voter_tree(*np.nonzero(fires.T), q, j, C.phi)
        order = sorted(range(j), key=lambda v: (-fires[v].sum(), v))
        for v in range(j):
            gain = {}
            for p in order[: order.index(v)]:
                gain[p] = 0.0
                for w in (q, 1 - q):
                    for a in (0, 1):
                        for b in (0, 1):
                            x = w[(fires[v] == a) & (fires[p] == b)].sum()
                            if x > 1e-6:
                                gain[p] += x * math.log(x * w.sum() / (w[fires[v] == a].sum() * w[fires[p] == b].sum()))
            best = max(gain, key=gain.get, default=None)
            assert got[v] == (best if best is not None and gain[best] > math.log(n) else -1)
        rate = [q[f].sum() / q.sum() for f in fires]
        for v in range(j):
            others = [u for u in range(j) if u != v and got[v] != u and got[u] != v]
            phi = [(q[fires[u] & fires[v]].sum() / q.sum() - rate[u] * rate[v]) / math.sqrt(rate[u] * (1 - rate[u]) * rate[v] * (1 - rate[v])) for u in others]
            assert weight[v] == pytest.approx(1 / (1 + sum(x for x in phi if x > C.phi)), abs=1e-4)


def test_classifier_reaches_the_optimum():
    """Weights against Newton's method on the whole matrix."""
    rng = np.random.default_rng(2)
    n, j = 500, 6
    fires = rng.random((n, j)) < 0.3
    q = 1 / (1 + np.exp(-(fires @ rng.normal(size=j) - 0.5 + rng.normal(size=n) * 0.3)))
    x, w = np.hstack([fires, np.ones((n, 1))]).astype(float), np.zeros(j + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) / n + 1e-6 * np.eye(j + 1), x.T @ (p - q) / n + 1e-6 * w)
    assert np.allclose(toxicity.train_linear(*np.nonzero(fires), q, j), w, atol=0.01)


def test_edge_cases(spark, make_docs):
    texts = [None, "", "you stupid worthless idiot", "a fine day", (None, "fine"), (2, "you stupid worthless idiot"), "word " * 50_000 + "moron scum trash"]
    docs = make_docs(texts, extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(2, 1, 1), (3, 1, 0), (3, 1, None), (99, 0, 1), (None, 1, 1), (2, 1, 0)], none.schema)
    for labels in (none, some):
        model = toxicity.fit(docs, labels)
        got = toxicity.score(docs, model).collect()
        assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
        assert {r.predicted for r in got if r.doc_id in (0, 1, 3)} == {0}
    assert max(r.predicted for r in toxicity.score(docs, toxicity.fit(docs, none)).collect() if r.doc_id == 2) == 1
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), some)).collect() == []
