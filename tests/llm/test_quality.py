import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from surveyloom.llm.quality import QualityRule, fit, quality, terms_of

RULE = QualityRule(bits=14)


def corpus(n=900):
    """Prose, and junk of three kinds; a third of the junk starts as prose."""
    rng = random.Random(3)
    plain = ["".join(rng.choice("abdeinorst") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.choice([20, 80, 300]))]
        kind = rng.choice([0, 0, 0, 1, 2, 3])
        own = [w + rng.choice(["", "", ",", "."]) for w in words]
        if kind == 1:
            junk = [w + rng.choice(["$$$", "###"]) for w in words]
        elif kind == 2:
            junk = [words[0]] * len(words)
        elif kind == 3:
            junk = [w.upper() + "!!" for w in words]
        if kind:
            own = own * (rng.random() < 0.3) + junk
        out.append((i, " ".join(own), int(kind == 0)))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    data = corpus()
    docs = spark.createDataFrame([(d, t, "en", 1, "x") for d, t, _ in data], "doc_id long, text string, lang string, quality int, score string")
    labels = spark.createDataFrame([(d, y) for d, _, y in data], "doc_id long, quality int")
    return data, docs, labels, quality(docs, labels, RULE).collect()


def test_held_out_rows_are_told_apart(scored):
    data, _, _, got = scored
    label = {d: y for d, _, y in data}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert len(held) > 150 and np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_and_row_order_change_nothing(spark, scored):
    data, docs, _, got = scored
    flipped = [(d, 1 - y if zlib.crc32(str(d).encode()) % 4 == 2 else y) for d, _, y in data]
    labels = spark.createDataFrame(flipped, "doc_id long, quality int").repartition(5)
    again = quality(docs.repartition(4), labels, RULE).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in got}


def test_updates_against_plain_sums():
    """A row at a time, every term on its own."""
    rule = QualityRule(bits=4, epochs=2)
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 16, 5)), None) for _ in range(40)]
    rows = [(t, rng.random(len(t))) for t, _ in rows]
    labels = rng.integers(0, 2, 40).astype(float)
    bias, weights = fit(labels, rows, rule)
    order, z, n = np.random.default_rng(rule.seed), [0.0] * 16, [0.0] * 16
    share = (labels.sum() + 1) / 42
    b, past = np.log(share / (1 - share)), 1.0

    def weight(i):
        if abs(z[i]) <= rule.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * rule.l1) / ((rule.beta + n[i] ** 0.5) / rule.alpha + rule.l2)

    for _ in range(2):
        for k in order.permutation(40):
            w = {i: weight(i) for i in rows[k][0]}
            miss = 1 / (1 + np.exp(-b - sum(w[i] * v for i, v in zip(*rows[k])))) - labels[k]
            for i, v in zip(*rows[k]):
                g = miss * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / rule.alpha * w[i]
                n[i] += g * g
            past += miss**2
            b -= 0.1 * miss / past**0.5
    assert bias == pytest.approx(b) and weights == pytest.approx([weight(i) for i in range(16)])


def test_terms_are_of_whole_texts_and_of_each_text_alone():
    texts = ["", None, "one two", "Δ one", "a " * 300_000 + "end!!!", "one two", "x" * 3_000_000]
    rule = QualityRule()
    alone = [next(terms_of(pa.array([t], pa.string()), rule)) for t in texts]
    got = list(terms_of(pa.array(texts), rule))
    together = [(t[a:b], v[a:b]) for t, v, f in got for a, b in zip(f[:-1], f[1:], strict=True)]
    assert len(together) == len(texts)
    for (t, v), (own, values, _) in zip(together, alone, strict=True):
        assert t.tolist() == own.tolist() and v == pytest.approx(values)
        assert len(v) == 0 or (v**2).sum() == pytest.approx(1)
    assert [len(t) for t, _ in together[:2]] == [0, 0] and len(together[2][0]) == 5
    # the end of a long text counts
    cut = next(terms_of(pa.array(["a " * 300_000]), rule))
    assert set(together[4][0]) - set(cut[0])


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (7, 5), (1, 0)], "doc_id long, quality int")
    got = quality(odd, labels, RULE).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert quality(empty, labels, RULE).collect() == []
    none = quality(odd, labels.limit(0), RULE).collect()
    assert len(none) == 7 and all(r.score == 0.5 and r.predicted == 0 for r in none)


def test_the_sample_is_bounded_in_rows_and_terms(spark, scored):
    data, docs, labels, _ = scored
    few = quality(docs, labels, QualityRule(bits=14, sample=50, terms=2_000))
    assert few.count() == len(data)
    # one id in very many rows teaches once
    again = docs.where("doc_id < 40").unionByName(docs.where("doc_id = 1").crossJoin(spark.range(500)).drop("id"))
    assert quality(again, labels, RULE).where("score is null").count() == 0
