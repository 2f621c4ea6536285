"""Search against brute force, classifiers by held-out accuracy, FM-index and components against plain versions."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from sparkfolio.llm import pu_quality, queries, toxicity, vptree
from sparkfolio.llm.fm_index import FMIndex
from sparkfolio.llm.graph import components

MID = "/root/testdata/sf0.01"


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_recall_of_the_registered_search(spark):
    rows = pq.read_table(f"{MID}/embeddings.parquet").to_pylist()
    good = [r for r in rows if r["embedding"] is not None and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])]
    ids, x = np.array([r["vec_id"] for r in good]), np.array([r["embedding"] for r in good], float)
    got = {}
    for r in queries.op2_vantage_points(spark, MID).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {int(ids[q]): brute(ids, x, q, 10) for q in np.flatnonzero(ids % 100 == 0)}
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())) and all(len(got[q]) == len(want[q]) for q in want)


@pytest.mark.parametrize("factor", [1.0, 1.5])
def test_tree_with_ties_and_copies(spark, factor):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (400, 4)).astype(float)
    x[x.sum(1) == 0] = 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(500, None, 0), (600, [0.0] * 4, 0), (700, [1.0, None, 2.0, 0.0], 0), (800, [float("nan")] * 4, 0), (900, [float("inf")] * 4, 0),
             (None, [1.0] * 4, 0), (1000, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    out = vptree.nearest(df, df.filter("vec_id % 100 = 0"), factor=factor).orderBy("query_id", "rank").collect()
    ids = np.arange(400)
    for q in range(0, 400, 100):
        got = [(r.vec_id, r.score) for r in out if r.query_id == q]
        if factor == 1:
            assert got == brute(ids, x, q, 10)
        assert len(got) == 10
    assert {r.query_id for r in out} == {0, 100, 200, 300}
    assert vptree.nearest(df.limit(0), df.limit(0)).collect() == []


def test_recall_with_many_centers(spark, monkeypatch):
    """Centers by the root of the rows, the bound on small cells lifted: recall on clustered and on spread vectors."""
    assert [vptree.n_centers(n) for n in (0, 500, 50_000, 10**6, 10**8)] == [1, 1, 50, 500, 5000]
    monkeypatch.setattr(vptree, "CELL_ROWS", 1)
    rng = np.random.default_rng(6)
    for x in (rng.normal(size=(4000, 16)), rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + 0.2 * rng.normal(size=(4000, 16))):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        ids, found = np.arange(len(x)), {}
        for r in vptree.nearest(df, df.filter("vec_id % 100 = 0")).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        hits = sum(len(found[q] & {a for a, _ in brute(ids, x, q, 10)}) for q in range(0, len(x), 100))
        assert hits >= 0.95 * 10 * (len(x) // 100)


def test_large_factor_prunes():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 8))
    tree = vptree.VPTree(x, np.arange(2000))
    exact, _ = tree.search(x[:20], 5, 1.0, np.full(20, np.inf))
    loose, _ = tree.search(x[:20], 5, 8.0, np.full(20, np.inf))
    assert np.allclose(exact, np.sort(vptree.distances(x[:20], x), 1)[:, :5]) and (loose >= exact - 1e-12).all()


def test_fm_index_finds_repeated_windows():
    rng = np.random.default_rng(3)
    for depth in (1, 2, 5, 9):
        parts = [rng.integers(1, 4, rng.integers(0, 40)) for _ in range(12)]
        text = np.concatenate([np.append(p, 0) for p in parts]).astype(np.int64)
        lengths = np.array([len(p) for p in parts])
        starts = np.cumsum(lengths + 1) - lengths - 1
        hit = FMIndex(text, depth).repeated(text, starts, lengths)
        windows = {(int(s + i)): tuple(p[i:i + depth]) for s, p in zip(starts, parts, strict=True) for i in range(len(p) - depth + 1)}
        values = list(windows.values())
        assert all(hit[i] == (values.count(w) > 1) for i, w in windows.items())


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 1), (10, 11), (11, 12), (12, 20), (7, 7), (None, 3)] + [(100 + i, 101 + i) for i in range(50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 20: 10, **{100 + i: 100 for i in range(51)}}


def test_toxicity_on_held_out_rows(spark):
    out = queries.op5_toxicity(spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in out)
    assert right >= 0.93 * len(out) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == 0 for r in out if not r.toxic)


def test_deobfuscation(spark):
    text = " ".join(["you are an idiot and a moron but the stupid clown is a loser"] * 50)
    model = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    for noisy, word in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("looooser", "looser"), ("iddddiot", "iddiot")):
        assert toxicity.restore(noisy, model) in (word, word.replace("oo", "o").replace("dd", "d")), noisy
    assert "idiot" in toxicity.restored("what an i d i o t he is", model) and "clown" in toxicity.restored("cl0wn!!", model)


def test_deobfuscation_of_whole_words(spark):
    text = " ".join(["he is a stupid idiot and you are a moron but the clown is a loser, a pédant in a cafe"] * 50)
    model = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    for noisy, word in (("he is a s t u p i d", "stupid"), ("he is s t u p i d", "stupid"), ("a s.t.u.p.i.d man", "stupid"), ("stuupid", "stupid"),
                        ("iddiot", "idiot"), ("!d!ot", "idiot"), ("(!d!ot!)", "idiot"), ("s  t  u  p  i  d", "stupid"), ("i\td\ti\to\tt", "idiot"),
                        ("m\no\nr\no\nn", "moron"), ("p é d a n t", "pédant"), ("p é d 4 n t", "pédant")):
        known = {}
        for _ in range(2):                                   # the words that are remembered are the same
            assert word in toxicity.restored(noisy, model, known), noisy
    assert "astupid" not in toxicity.restored("he is a s t u p i d", model)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "x" * 50000, 1), (3, "x" * 50000, 1), (None, "word", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels, queries._held_out(3, 1)).collect()
    assert len(out) == 5 and all(r.score == 0 and r.held_out is not None for r in out)
    assert toxicity.toxicity(docs.limit(0), labels, queries._held_out(3, 1)).collect() == []


def test_quality_on_held_out_rows(spark):
    out = queries.op6_pu_quality(spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in out) >= 0.93 * len(out) and all(0 <= r.score <= 1 for r in out)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "A!\n" * 20000, 1), (3, "A!\n" * 20000, 1), (None, "word", 1)], "doc_id long, text string, x int")
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    for lab in (labels, labels.limit(0)):
        out = pu_quality.quality(docs, lab, queries._held_out(5, 0)).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert pu_quality.quality(docs.limit(0), labels, queries._held_out(5, 0)).collect() == []


def test_class_prior_of_a_mixture():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(2, 1, 20000), rng.normal(-2, 1, 6000)
    assert pu_quality.class_prior(good, np.concatenate((rng.normal(2, 1, 14000), bad))) == pytest.approx(0.7, abs=0.05)


def test_sums_of_the_risk_and_its_slopes(spark):
    rng = np.random.default_rng(9)
    x, kind = rng.random((300, len(pu_quality.NAMES))) * 0.8, rng.random(300) < 0.3
    sums = pu_quality.Sums(spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, kind)], "x array<double>, kind int").repartition(4))
    s, w = pu_quality.steps(x), rng.normal(size=1 + len(pu_quality.NAMES) * len(pu_quality.KNOTS))
    assert sums.counts().tolist() == [(~kind).sum(), kind.sum()]
    for k in (0, 1):
        z, rows = s[kind == k] @ w, s[kind == k]
        q = 1 / (1 + np.exp(-z))
        loss, slope, bend = (part[k] for part in sums.slopes(w))
        assert np.allclose(loss, [np.log1p(np.exp(z)).sum(), np.log1p(np.exp(-z)).sum()])
        assert np.allclose(slope, [q @ rows, (1 - q) @ rows]) and np.allclose(bend, (rows.T * (q * (1 - q))) @ rows)
        assert np.allclose(sums.losses([w, 0 * w])[k], [loss[0], len(z) * np.log(2), loss[1], len(z) * np.log(2)])
        assert (sums.tails(w)[k] == pu_quality._bins(z)).all()


def test_newton_ends_where_the_risk_is_flat(spark):
    """The risk that is minimised, plainly: nothing near the result is lower."""
    rng = np.random.default_rng(10)
    x = np.vstack([rng.random((400, len(pu_quality.NAMES))) * 0.3, rng.random((200, len(pu_quality.NAMES)))])
    kind = np.append(np.ones(150, int), np.zeros(450, int))
    sums = pu_quality.Sums(spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, kind)], "x array<double>, kind int"))
    s, n = pu_quality.steps(x), sums.counts()
    for prior in (None, 0.3, 0.6):
        w = pu_quality._newton(sums, n, prior)

        def risk(v):
            p, u = s[kind == 1] @ v, s[kind == 0] @ v
            soft = lambda z: np.logaddexp(0, z).mean()
            base = soft(-p) + soft(u) if prior is None else prior * soft(-p) + max(0.0, soft(u) - prior * soft(p))
            return base + pu_quality.DECAY / 2 * (v @ v)
        best = risk(w)
        assert all(best <= risk(w + 0.05 * rng.normal(size=len(w))) + 2 / pu_quality.SHARP for _ in range(200))


def test_score_by_tokens_is_the_score_by_features(spark):
    """Against all features of the text, and the Viterbi path against every path of the lattice."""
    text = " ".join(["he is a stupid idiot and you are a moron but the clown is a loser, a pédant in a café, groß"] * 50)
    model = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    lists = model.tolist()
    lexicon = {"idiot": 0.9, "stup*": 0.8, "pédant": 0.7, "los*": 0.02, "clown": 0.3}
    texts = ["", "  ", "!!!", "nothing here", "1d!0t", "a loser", "loser", "i d i o t", "p é d 4 n t s", "Stuupidity", "c-l-o-w-n 123", "los", "x" * 100 + " idiot"]
    for known in ({}, None):
        for t in texts:
            want = max((lexicon.get(f, 0.1) for f in toxicity.features(t, lists)), default=0.1)
            assert toxicity.strongest(t, lists, lexicon, 0.1, {} if known is None else known) == want, t

    def cost(word):
        out, (a, b) = 0.0, (0, 0)
        for c in [toxicity._CODES.get(x, 27) for x in word] + [0] * bool(word):
            out -= lists[a][b][c]
            a, b = b, c
        return out
    for token in ("1d10t", "stuupid", "c.l.o.w.n", "lo$$er", "grröß", "m0r0n", "aabb"):
        paths = [("", 0.0)]
        for pieces in toxicity.lattice(token):
            paths = [(w + x, c + extra) for w, c in paths for x, extra in pieces]
        best = min(c + cost(w) for w, c in paths)
        got = toxicity.restore(token, lists)
        assert any(w.strip() == got and abs(c + cost(w) - best) < 1e-9 for w, c in paths), token


def test_trigrams_count_characters(spark):
    rows = spark.createDataFrame([("É é\ngroß",), (None,), ("日本x",)], "text string")
    counts = np.zeros(toxicity._N ** 3, np.int64)
    for r in rows.select("text").mapInArrow(toxicity._trigrams, "gram long, n long").collect():
        counts[r.gram] += r.n
    code = lambda c: toxicity._CODES.get(c, 0 if c.isascii() else 27)
    want = np.zeros_like(counts)
    for text in ("é é\ngroß", "日本x"):
        x = [0, *map(code, text)]
        for a, b, c in zip(x, x[1:], x[2:], strict=False):
            want[(a * toxicity._N + b) * toxicity._N + c] += 1
    inside = want > 0
    assert (counts[inside] >= want[inside]).all() and counts.sum() - want.sum() <= 4      # texts of a batch stand one after the other
