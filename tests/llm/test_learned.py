"""Models that are trained here: held-out accuracy, gradients and likelihoods."""

import itertools
import zlib

import numpy as np
import pytest
from rows import EDGE, by_id, edge, empty

from tickloom.llm import hmm, langid, toxicity, weaklabel
from tickloom.llm.queries import load, op2_language, op4_hmm, op6_weak_labels, op10_toxicity

SF = "/root/testdata/sf0.01"


def rest(doc_id, modulo):
    return zlib.crc32(str(doc_id).encode()) % modulo


def test_gradients_equal_differences():
    network = langid.Network(["a", "b", "c"], hidden=4)
    data, label = langid._matrix([b"abc ", b"xy ", b"hello w "]), np.array([0, 1, 2])
    _, grads = network.gradients(data, label)
    for p, g in zip(network.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), p.shape)
        kept, losses = p[at], []
        for e in (0.01, -0.01):
            p[at] = kept + e
            losses.append(network.gradients(data, label)[0])
        p[at] = kept
        assert abs((losses[0] - losses[1]) / 0.02 - g[at]) < 0.02 * abs(g[at]) + 1e-4


def test_a_word_alone_equals_a_word_among_others():
    network = langid.Network(["a", "b"])
    words = [b"one", b"twenty", "çé".encode(), b"x" * 60]
    together, sizes = langid.word_sums(network, words)
    alone = np.concatenate([langid.word_sums(network, [w])[0] for w in words])
    assert np.allclose(together, alone, atol=1e-4) and sizes.tolist() == [len(w) + 1 for w in words]


def test_language_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in op2_language(spark, SF).collect()}
    docs = load(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if rest(r["doc_id"], 5) == 0]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95


def test_language_edge_rows(spark):
    df = edge(spark).selectExpr("*", "'en' as lang")
    got = langid.predict(df, langid.train([(b"some text", "en"), (b"ein satz", "de")], steps=3))
    rows = by_id(got, "doc_id", "lang_pred", "score")
    assert len(rows) == len(EDGE) and all(0 <= s <= 1 for _, _, s in rows)
    assert {i for i, lang, _ in rows if lang == "und"} == {2, 3, 6}
    assert {r["lang_pred"] for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.fit(empty(spark).selectExpr("*", "'en' as lang")) is None
    kept = langid.keep_identified(df, langid.train([(b"some text", "en")], steps=3))
    assert kept.columns == df.columns and kept.count() == len(EDGE) - 3


def enumerate_paths(model, symbols):
    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(symbols)):
        p = model.start[path[0]]
        for t, s in enumerate(path):
            p *= (model.move[path[t - 1], s] if t else 1.0) * model.emit[symbols[t], s]
        total += p
    return total


def small_model(seed=1, states=3, symbols=4):
    rng = np.random.default_rng(seed)
    return hmm.Model(
        rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(symbols), states).T
    )


def test_forward_recursion_equals_all_paths():
    model, rng = small_model(), np.random.default_rng(2)
    rows = [rng.integers(0, 4, n).astype(np.int32) for n in (5, 1, 7, 5, 2)]
    got, _, _ = hmm.Sequences(rows).forward(model, keep=False)
    assert np.allclose(got, [np.log10(enumerate_paths(model, r)) for r in rows])


def test_expected_counts_add_up_and_training_helps():
    model, rng = small_model(3), np.random.default_rng(4)
    rows = [np.repeat(rng.integers(0, 4, 6), 3).astype(np.int32) for _ in range(40)]
    flat = np.bincount(np.concatenate(rows), minlength=4)
    before = hmm.Sequences(rows).forward(model, keep=False)[0].sum()
    start, move, emit = hmm.Sequences(rows).expected(model)
    assert np.isclose(start.sum(), 40) and np.isclose(move.sum(), 40 * 17)
    assert np.allclose(emit.sum(axis=1), flat)
    new = hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    assert hmm.Sequences(rows).forward(new, keep=False)[0].sum() > before


def plain_base(docs):
    tokens = {i: [w.decode() for w in (t or "").encode().translate(hmm.LOWER).split()] + [None] for i, t in enumerate(t for _, t in docs)}
    train = [w for i, (d, _) in enumerate(docs) if d is None or rest(d, 5) != 1 for w in tokens[i]]
    counts, n = {}, len(train)
    for w in train:
        counts[w] = counts.get(w, 0) + 1
    log = lambda w: np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (len(counts) + 1)))
    return [
        (d, len(tokens[i]), sum(w in counts for w in tokens[i]), n, sum(map(log, tokens[i]))) for i, (d, _) in enumerate(docs)
    ]


@pytest.mark.parametrize("head", [hmm.HEAD, 30])
def test_base_scores(spark, sf_dir, head):
    docs = load(spark, sf_dir, "documents")
    got = sorted(hmm.score(docs, states=3, rounds=1, head=head, top=20).collect(), key=lambda r: r["doc_id"])
    want = sorted(plain_base([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [w[:4] for w in want]
    assert np.allclose([r["base_score"] for r in got], [w[4] for w in want])


def test_head_size_does_not_change_scores(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    scores = [
        [r["score"] for r in sorted(hmm.score(docs, states=2, rounds=1, head=h, top=20).collect(), key=lambda r: r["doc_id"])]
        for h in (hmm.HEAD, 300)
    ]
    assert np.allclose(*scores)


def test_probabilities_of_all_words_sum_to_one(spark):
    texts = [(i, t) for i, t in enumerate(["a bb a", "bb ccc dbb", "a ebb", "a"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    table = hmm.materialize(hmm.count_words(docs), "t")
    counts = hmm.Counts(table, 4, top=1)
    by_class = {}
    for w, c in [("bb", 2), ("ccc", 1), ("dbb", 1), ("ebb", 1)]:
        k = hmm.word_class(w.encode())
        by_class[k] = by_class.get(k, 0) + (c + 0.5) / 10 ** counts.class_base[k]
    for k, total in by_class.items():
        assert np.isclose(total + 0.5 / 10 ** counts.class_base[k], 1)
    model = hmm.Model.first(counts.symbol_count, 3)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)


def test_model_beats_the_base_on_held_out_documents(spark):
    rows = [r for r in op4_hmm(spark, SF).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_language_model_edge_rows(spark):
    rows = by_id(hmm.score(edge(spark), states=2, rounds=1), "doc_id", "n_tokens", "score", "base_score")
    assert len(rows) == len(EDGE) and all(np.isfinite(r[2:]).all() for r in rows)
    assert {r[1] for r in rows if r[0] in (2, 3, 6)} == {1}
    assert hmm.score(empty(spark)).collect() == []


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    said = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    said[rng.random(said.shape) < 0.2] = weaklabel.ABSTAIN
    patterns, counts = np.unique(said, axis=0, return_counts=True)
    posterior, accuracy, prior = weaklabel.label_model(patterns, counts.astype(float))
    assert np.abs(accuracy - right[:, None]).max() < 0.05 and abs(prior - 0.7) < 0.03
    at = {tuple(p): x for p, x in zip(patterns.tolist(), posterior)}
    assert np.mean([(at[tuple(s)] > 0.5) == t for s, t in zip(said.tolist(), truth)]) > 0.9


def test_weak_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in load(spark, SF, "labels").collect()}
    rows = op6_weak_labels(spark, SF).collect()
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1]
    scores = lambda q: [r["score"] for r in rows if labels.get(r["doc_id"]) == q]
    assert np.mean(good) > 0.99 and np.mean(scores(1)) > np.mean(scores(0)) + 0.2
    got = by_id(weaklabel.classify(edge(spark)), "doc_id", "score")
    assert len(got) == len(EDGE) and all(0 <= s <= 1 for _, s in got)
    assert weaklabel.classify(empty(spark)).collect() == []


def test_weak_labels_reject_bad_rows(spark):
    labels = load(spark, SF, "labels").where("quality = 0")
    bad = [r["kept"] for r in op6_weak_labels(spark, SF).join(labels, "doc_id").collect()]
    assert len(bad) > 50 and 1 - np.mean(bad) > 0.45


def test_toxicity_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in load(spark, SF, "labels").collect()}
    rows = [r for r in op10_toxicity(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(rest(r["doc_id"], 4) == 2 for r in rows)
    clean = [r["predicted"] for r in rows if not labels[r["doc_id"]]]
    assert np.mean(clean) < 0.05
    mean = lambda y: np.mean([r["score"] for r in rows if labels[r["doc_id"]] == y])
    assert mean(1) > mean(0) + 0.2


def test_folding():
    assert toxicity.fold("Ｂаd W0RD$ sо​b 1d10t") == "bad words sob idiot"


def test_matches_and_exceptions():
    matcher = toxicity.Matcher({"bad": 2.0, "worse": 3.0}, ["not bad", "bad luck"])
    found = lambda t: [(t[a:b], w) for a, b, w in matcher.matches(t)]
    assert found("bad, badly unbad worse") == [("bad", 2.0), ("worse", 3.0)]
    assert found("not bad but bad and bad luck") == [("bad", 2.0)]
    assert toxicity.Matcher({}, []).matches("bad") == []


def test_toxicity_edge_rows(spark):
    docs = edge(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = by_id(toxicity.score(docs, toxicity.fit(docs, labels)), "doc_id", "score", "predicted")
    assert len(got) == len(EDGE) and all(0 <= s <= 1 for _, s, _ in got)
    nothing = toxicity.score(docs, toxicity.fit(docs, labels.limit(0)))
    assert {r["score"] for r in nothing.collect()} == {0.0}
    assert toxicity.score(empty(spark), toxicity.Scorer({}, [], None)).collect() == []
