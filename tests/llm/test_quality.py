import numpy as np

from siltline.llm import quality
from siltline.llm.quality import Attention, encode, quality_scores


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_scores(docs, labels).join(labels, "doc_id", "left").collect()
    held = [x for x in got if x["held_out"] and x["quality"] is not None]
    assert len(got) == docs.count() and len(held) > 50
    assert np.mean([x["predicted"] == x["quality"] for x in held]) > 0.95
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7) for x in got)


def test_gradients():
    r = np.random.default_rng(1)
    x, n, y = r.standard_normal((9, 6)), np.array([2, 1, 4, 2]), np.array([1.0, 0.0, 1.0, 0.0])
    m = Attention(6)
    loss = lambda: -np.mean(np.log(np.where(y > 0, (s := m.forward(x, n)[0]), 1 - s)))
    for k, g in m.gradients(x, n, y).items():
        at = tuple(int(r.integers(0, d)) for d in m.p[k].shape)
        old, step = m.p[k][at], 1e-6
        m.p[k][at] = old + step
        up = loss()
        m.p[k][at] = old - step
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 1e-6


def test_passages_are_encoded_alone_or_together():
    texts = ["", " ", "a b", "Wörter 12 !! " * 200, "x" * 5000, "\n\nq w e " * 100]
    data = [t.encode() for t in texts]
    both, n = encode(data)
    assert n.tolist() == [1, 1, 1, 5, 1, 3]
    at = np.cumsum(n) - n
    for k, d in enumerate(data):
        alone, m = encode([d])
        assert m[0] == n[k] and np.allclose(alone, both[at[k] : at[k] + n[k]])


def test_odd_rows(spark):
    rows = [(k, "good words here and there " * 9 if k % 2 else "### $$$ %%% " * 9, 1) for k in range(40)]
    docs = spark.createDataFrame([*rows, (None, "good words", 1), (50, None, 1), (51, "", 1), (3, "other text", 1), (52, "word " * 200_000, 1)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (51, None), (3, 0), (999, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 45
    score = {(x["doc_id"]): x["score"] for x in got}
    assert np.mean([score[k] for k in range(5, 40, 2)]) > np.mean([score[k] for k in range(0, 40, 2)]) and score[50] == score[51]
    assert {x["score"] for x in quality_scores(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0


def test_sample_is_bounded(spark):
    from siltline.llm.quality import sample

    docs = spark.createDataFrame([(k, f"text {k} " * 10) for k in range(400)] + [(7, "again")] * 50 + [(8, "long " * 500)] + [(None, "none")] * 9, "id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)] + [(None, 1), (3, None), (4, 7)], "id long, y int")
    assert sample(docs, labels, 100, 1 << 20, 1 << 20).count() <= 100 < sample(docs, labels, 1000, 1 << 20, 1 << 20).count()
    some = sample(docs, labels, 1000, 2_000, 1_000).collect()
    assert 0 < sum(len(x["text"]) for x in some) <= 2_000
    assert sample(docs, labels, 1000, 1 << 20, 1 << 20).where("text = 'again'").count() <= 1


def test_equals_a_naive_model():
    """One passage after another, in plain Python, from the definition of the network."""
    import math

    from siltline.llm.quality import BUCKETS, MEASURES, PASSAGE, Attention, encode

    texts = [b"", b"one two", b"Alpha beta! " * 200, "ééé 12 . . x\n".encode() * 30]
    x, n = encode(texts)
    assert n.tolist() == [1, 1, -(-400 // PASSAGE), -(-150 // PASSAGE)]
    # the share of each kind of byte and the repeated words of the only passage of a text
    passage = x[1, BUCKETS:]
    assert passage[0] == np.float32(math.log1p(2)) and passage[1] == passage[2] == 0 and passage[4] == 3 and passage[5] == 1
    model = Attention(BUCKETS + MEASURES, seed=4)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-2
    got = model.forward(x.astype(float), n)[0]
    p, at = {k: v.tolist() for k, v in model.p.items()}, 0
    dot = lambda v, m, b=None: [sum(a * r[j] for a, r in zip(v, m)) + (b[j] if b else 0) for j in range(len(m[0]))]  # noqa: B905,E731
    for k, own in enumerate(n.tolist()):
        hidden, weights = [], []
        for row in x[at : at + own]:
            z = [(float(a) - m) / s for a, m, s in zip(row, model.mean.tolist(), model.scale.tolist(), strict=True)]
            h = [math.tanh(v) for v in dot(z, p["w1"], p["b1"])]
            gate = [math.tanh(a) / (1 + math.exp(-b)) for a, b in zip(dot(h, p["v"]), dot(h, p["u"]), strict=True)]
            hidden.append(h)
            weights.append(math.exp(dot(gate, p["a"])[0]))
        pooled = [sum(w * h[j] for w, h in zip(weights, hidden, strict=True)) / sum(weights) for j in range(len(hidden[0]))]
        assert abs(got[k] - 1 / (1 + math.exp(-dot(pooled, p["c"], p["b"])[0]))) < 1e-6
        at += own
