import inspect

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from surveyloom.llm import queries
from surveyloom.llm.line_dedup import LineRule, drop_repeated_lines
from surveyloom.llm.mixing import mix_sources
from surveyloom.llm.near_dups import near_duplicates
from surveyloom.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_names_and_columns(stages, spark):
    assert list(stages) == ["toxicity", "line dedup", "near-duplicates", "mixing", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").schema.names
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_toxic_documents_go(stages, spark):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in toxicity(before, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in after.collect()} == want and after.count() < before.count()


def test_lines_are_out_of_the_texts(stages):
    before, after = stages["line dedup"]
    old = {r.doc_id: r for r in before.collect()}
    changed = 0
    for r in after.collect():
        lines = old[r.doc_id].text.split("\n")
        assert r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(lines)
        changed += r.text != old[r.doc_id].text
    assert changed
    # what the operator keeps of a text is kept; only texts of nothing else go
    kept = {r.doc_id: r.kept_text for r in drop_repeated_lines(before, LineRule(short=True)).collect()}
    new = {r.doc_id: r.text for r in after.collect()}
    for d, text in kept.items():
        assert new[d] == text if d in new else old[d].text != text and not text.strip()


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near-duplicates"]
    want = {r.doc_id for r in near_duplicates(before).where("kept").collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_copies_are_those_of_the_mix(stages):
    before, after = stages["mixing"]
    want = {r.doc_id: r.copies for r in mix_sources(before).where("copies > 0").collect()}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == want


def test_packing_takes_every_row(stages):
    before, after = stages["packing"]
    ends = after.where(F.col("start") + F.col("length") == F.col("doc_tokens"))
    assert ends.count() == before.count()


def test_run_is_all_stages(stages, spark):
    got = corpus_pipeline.run(spark, SF).count()
    assert got == stages["packing"][1].count()


def test_rows_that_repeat_and_rows_without_id(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 7]
    mixed = corpus_pipeline.mix(spark, docs, SF).collect()
    assert len(mixed) == mix_sources(docs).agg(F.sum("copies")).first()[0]
    lines = corpus_pipeline.dedup_lines(spark, docs, SF).collect()
    assert len(lines) == 6
    none = docs.limit(0)
    assert all(stage(spark, none, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_what_is_left_of_a_text_stays_unless_it_is_blank(spark):
    shared = "\n".join(f"{chr(97 + i) * 5} of a passage that many documents share" for i in range(20))
    texts = [shared, f"{shared}\nits own", f"\n{shared}\n \t", "menu\nfirst", "menu"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    kept = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()}
    assert kept == {0: (shared, len(shared)), 1: ("its own", 7), 3: ("menu\nfirst", 10)}


def test_registered():
    found = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert "ImportError" not in inspect.getsource(corpus_pipeline)
