import random
import zlib

import numpy as np
import pytest

from surveyloom.llm.toxicity import ToxicRule, fit, toxicity

RULE = ToxicRule(bits=14, decay=1.0)


def corpus(n=900):
    """Insults are toxic with a group's name only: no single word gives it away."""
    rng = random.Random(1)
    plain = ["".join(rng.choice("abdeinorst") for _ in range(5)) for _ in range(60)]
    out = []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        own = [rng.choice(plain) for _ in range(6)]
        own += ["fool"] * insult + ["folk"] * group
        rng.shuffle(own)
        out.append((i, " ".join(own), int(insult and group)))
    return out


def area(score, label):
    high, low = score[label == 1], score[label == 0]
    return (high[:, None] > low[None, :]).mean() + 0.5 * (high[:, None] == low[None, :]).mean()


@pytest.fixture(scope="module")
def scored(spark):
    data = corpus()
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t, _ in data], "doc_id long, text string, lang string, toxic int")
    labels = spark.createDataFrame([(d, y) for d, _, y in data], "doc_id long, toxic int")
    return data, docs, labels, toxicity(docs, labels, RULE).collect()


def test_pairs_are_learnt_and_held_out_rows_are_scored(scored):
    data, _, _, got = scored
    label = {d: y for d, _, y in data}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert area(np.array([r.score for r in held]), np.array([label[r.doc_id] for r in held])) > 0.97


def test_held_out_labels_and_row_order_change_nothing(spark, scored):
    data, docs, _, got = scored
    flipped = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, _, y in data]
    labels = spark.createDataFrame(flipped, "doc_id long, toxic int").repartition(5)
    again = toxicity(docs.repartition(4), labels, RULE).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({r.doc_id: r.score for r in got})


def test_a_pair_can_take_back_what_its_words_say():
    """Toxic with exactly one of two words: no sum of weights ranks that."""
    terms = [np.array(t, dtype=np.int64) for t in ([], [0], [1], [0, 1])] * 100
    label = np.array([0.0, 1.0, 1.0, 0.0] * 100)
    machine = fit(label, terms, ToxicRule(bits=2, decay=0.1))
    first = np.array([0, 0, 1, 2, 4])
    assert (machine.margins(np.array([0, 1, 0, 1]), first) > 0).tolist() == [False, True, True, False]


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (7, 5), (1, 0)], "doc_id long, toxic int")
    got = toxicity(odd, labels, RULE).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert toxicity(empty, labels, RULE).collect() == []
    none = toxicity(odd, labels.limit(0), RULE).collect()
    assert len(none) == 7 and all(abs(r.score - 0.05) < 0.01 and r.predicted == 0 for r in none if r.doc_id == 7)


def long_texts(n, seed, both):
    """Terms of texts of 40 to 500 words; words 0 and 1 are toxic together, or else alone."""
    rng = np.random.default_rng(seed)
    terms, label, size = [], [], []
    for _ in range(n):
        size.append(rng.choice([40, 120, 200, 500]))
        own = np.unique(2 + rng.zipf(1.3, size[-1]) % 3000)
        a, b = rng.random() < 0.4, rng.random() < 0.4
        terms.append(np.concatenate([[0] * a, [1] * b, own]).astype(np.int64))
        label.append(float(a and b if both else a != b))
    return terms, np.array(label), np.array(size)


def test_pairs_count_in_long_texts_at_the_registered_rule():
    terms, label, _ = long_texts(8000, 1, True)
    machine = fit(label, terms, ToxicRule())
    assert machine.vectors[0] @ machine.vectors[1] > 0
    first = np.array([0, 200, 400, 600, 800])
    rest = np.arange(4000, 4198)  # terms no row has
    margin = machine.margins(
        np.concatenate([*(np.concatenate([own, rest]) for own in ([0, 1], [0, 4198], [1, 4198], [4198, 4199]))]), first
    )
    # beyond the two weights; 0.01 if divided by the number of terms
    assert margin[0] - margin[1] - margin[2] + margin[3] > 0.3
    terms, label, _ = long_texts(8000, 1, False)
    machine = fit(label, terms, ToxicRule())
    terms, label, size = long_texts(2000, 2, False)
    margin = machine.margins(np.concatenate(terms), np.cumsum([0, *map(len, terms)]))
    for words, least in ((40, 0.72), (120, 0.67)):
        assert area(margin[size == words], label[size == words]) > least
