"""The stages of the corpus pipeline, each against its operator or brute force."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnmart.llm import decontaminate, secrets, simhash, toxicity


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, as lists of rows."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("row_key", F.lit("clash"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = str(tmp_path_factory.mktemp("stage") / "out")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        seen[name] = docs, kept
        docs = kept
    return folder, seen


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay_until_packing(stages):
    _, seen = stages
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == before.columns, name


def test_toxic_documents_go(spark, stages):
    folder, seen = stages
    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.score(before, labels).where("toxic = 1").collect()}
    assert ids(after) == ids(before) - toxic
    marked = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(marked & ids(after)) < 0.3 * len(marked) and len(clean - ids(after)) < 0.02 * len(clean)


def test_one_of_each_component_stays(stages):
    _, seen = stages
    before, after = seen["simhash near-dedup"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values())) and len(groups) > after.count()


def test_contaminated_documents_go(spark, stages):
    folder, seen = stages
    before, after = seen["benchmark decontamination"]
    items = [decontaminate._WORDS(r.text.lower()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in before.collect() for i in items if " ".join(i) in " ".join(decontaminate._WORDS((r.text or "").lower()))}
    assert whole and not whole & ids(after) and ids(after) < ids(before)


def test_secrets_are_masked_and_all_else_stays(stages):
    _, seen = stages
    before, after = seen["secret scans"]
    old, new = ({r.doc_id: r for r in df.collect()} for df in (before, after))
    assert set(old) == set(new)
    changed = 0
    for i, row in new.items():
        assert row.n_chars == len(row.text)
        for rule in secrets.BASE:
            for m in re.finditer(rule.pattern, row.text, (re.I | re.A) if rule.any_case else re.A):
                assert len(m.group(rule.value)) < rule.shortest
        if row.text != old[i].text:
            changed += 1
            assert "[secret]" in row.text
    assert changed


def test_packed_pieces_hold_every_document(stages):
    _, seen = stages
    before, after = seen["packing"]
    pieces = {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == ids(before)
    for rows in pieces.values():
        assert sum(r.length for r in rows) == rows[0].doc_tokens


def test_stages_keep_odd_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(None, "token=abcdefgh", "en", "s", 14, "x"), (1, None, "en", "s", 3, "x"), (2, "", None, None, None, "x"), (2, "", None, None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string")
    out = {name: f(spark, docs, folder) for name, f in corpus_pipeline.STAGES}
    assert out["toxicity"].count() == out["benchmark decontamination"].count() == 4
    assert sorted(r.text or "" for r in out["simhash near-dedup"].collect()) == ["", "token=abcdefgh"]
    masked = {(r.doc_id, r.text, r.n_chars, r.spans) for r in out["secret scans"].collect()}
    assert masked == {(None, "[secret]", 8, "x"), (1, None, 3, "x"), (2, "", 0, "x")}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
