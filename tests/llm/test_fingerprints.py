import hashlib
from collections import Counter

from pyspark.sql import functions as F

from surveyloom.llm.fingerprints import combined, edited_fingerprints, with_fingerprint, with_likeness


def exact_lanes(text):
    lanes = [0] * 16
    for p in text.split("\n") if text else []:
        h = hashlib.sha512(p.encode()).hexdigest()
        lanes = [(v + int(h[8 * i : 8 * i + 8], 16)) % (1 << 32) for i, v in enumerate(lanes)]
    return "".join(f"{v:08x}" for v in lanes)


def test_edited_texts_and_exact_lanes(docs, rows):
    got = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    order = sorted((r[0], r[1] or "") for r in rows)
    for k, (d, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint[:128] == exact_lanes(text)
        assert r.edited_fingerprint[:128] == exact_lanes(edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    marks = Counter(t for _, t in order)
    assert len({got[d].fingerprint for d, _ in order}) == len({tuple(sorted(t.split("\n"))) if t else () for t in marks})
    long = [got[d] for d, t in order if t.count(".") > 12]
    assert sum(r.near_edited for r in long) / len(long) > 0.3 > sum(r.near_next for r in long) / len(long)


def test_odd_rows(odd, empty, spark):
    got = edited_fingerprints(odd).collect()
    assert len(got) == 7 and {r.doc_id for r in got} == {None, 1, 2, 7}
    assert edited_fingerprints(empty).collect() == []
    one = spark.createDataFrame([(4, "ab cd")], "doc_id long, text string")
    r = edited_fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()


def test_insertion_deletion_and_order(spark):
    data = [("a.\nb c.\nd.", "d.\na.\nb c.", "b c.", "a.\nd.", "a.\nd.\nd.")]
    df = spark.createDataFrame(data, "x string, y string, part string, rest string, more string")
    for c in df.columns:
        df = with_fingerprint(df, c, f"f_{c}")
    df = df.withColumn("added", combined("f_rest", "f_part")).withColumn("taken", combined("f_x", "f_part", "-"))
    df = with_likeness(df, "f_x", "f_y", "same")
    r = with_likeness(df, "f_x", "f_rest", "near").first()
    assert r.f_x == r.f_y == r.added and r.taken == r.f_rest != r.f_more
    assert r.same == 1.0 and 0.4 < r.near < 1.0


def test_plan_has_no_python_and_one_shuffle(docs):
    plan = edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_text_with_more_sentences_than_a_lane_counts(spark):
    df = spark.range(1).select(F.expr("repeat('a b. ', 1100000)").alias("t"))
    assert len(with_fingerprint(df, "t", "f").first().f) == 16 * 8 + 126 * 5


def test_repeated_and_smallest_ids_are_split_and_keep_their_order(spark):
    low = -(1 << 63)
    data = [(5, f"text {i}. of one id.\nline") for i in range(300)] + [(low, "least"), (None, "none"), (9, "last")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    key = F.xxhash64("text").alias("key")
    known = F.col("doc_id").isNotNull()
    order = [(r.doc_id, r.text) for r in df.orderBy(known, "doc_id", key, "text").collect()]
    want = []
    for k, (d, text) in enumerate(order):
        half, after = len(text) // 2, order[(k + 1) % len(order)][1]
        want.append((d, hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in edited_fingerprints(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_plan_does_not_grow_with_the_ranges(docs, monkeypatch):
    from surveyloom.llm import fingerprints

    def size():
        return len(edited_fingerprints(docs)._jdf.queryExecution().optimizedPlan().toString())

    few = size()
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 40)
    assert abs(size() - few) < 200
    assert edited_fingerprints(docs).count() == docs.count()
