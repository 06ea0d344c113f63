"""The pipeline, stage by stage, against brute force on the smallest tables."""

import corpus_pipeline
from compare import connect
from refinery.llm.quality_rules import judge
from refinery.llm.sql import RULES
from refinery.llm.stored import stored, table
from test_near_duplicates import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "packing"]
    documents = table(spark, SF_DIR, "documents")
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == documents.columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    everything = {r.doc_id: r for r in documents.collect()}
    assert all(any(c.isalpha() for c in r.text) for r in kept["language_id"].values())
    assert len(kept["language_id"]) >= 0.95 * len(everything)

    con = connect(SF_DIR)
    good = dict(con.sql(f"SELECT doc_id, kept FROM ({RULES}) x").fetchall())
    assert set(kept["quality_rules"]) == {k for k in kept["language_id"] if good[k]}

    groups = brute([(k, r.text) for k, r in kept["quality_rules"].items()])
    assert set(kept["near_dedup"]) == {k for k, (_, least) in groups.items() if k == least}
    assert all(r == everything[k] for k, r in kept["near_dedup"].items())

    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(kept["near_dedup"])
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048


def test_an_empty_corpus(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_rules_on_documents_equal_the_stage(spark):
    docs = table(spark, SF_DIR, "documents")
    found = judge(docs, table(spark, SF_DIR, "labels")).where("kept").select("doc_id")
    assert {r.doc_id for r in found.collect()} == {
        r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF_DIR).select("doc_id").collect()
    }


def test_dedup_keeps_one_row_of_each_group_whatever_its_id(spark):
    words = [" ".join(f"{name}{i}" for i in range(40)) for name in ("a", "b", "c", "d")]
    rows = [
        (5, words[0]), (5, words[0]), (5, words[0]),  # repeated rows
        (None, words[1]),  # no id, a text of its own
        (None, words[2]), (None, words[2] + " more"),  # near-duplicates without ids
        (9, words[3]), (None, words[3]), (7, words[3] + " more"),  # the least id stays, null after it
        (8, None), (8, None), (None, None), (None, ""), (4, " "), (3, " "),  # texts without words link with nothing
        (6, words[0].replace("a", "x")), (6, words[0].replace("a", "y")),  # one id, two texts
    ]
    docs = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()]
    without_id = [t for i, t in kept if i is None]
    assert sorted((i, t or "") for i, t in kept if i is not None) == sorted(
        [(5, words[0]), (7, words[3] + " more"), (8, ""), (4, " "), (3, " "), rows[-2], rows[-1]]
    )
    assert len(without_id) == 4 and words[1] in without_id and None in without_id and "" in without_id
    assert sum(t in (words[2], words[2] + " more") for t in without_id) == 1
