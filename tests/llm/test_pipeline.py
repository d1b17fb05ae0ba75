import pytest
from compare import duck, duck_rows, spark_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tweetflow.llm import queries as Q
from tweetflow.llm import quality_net, secret_scan
from tweetflow.llm.frames import fold, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert spark_rows(Q.queries()[name](spark, SF)) == duck_rows(duck(SF), Q.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_query_has_a_row_per_document(spark, name):
    ids = [r.doc_id for r in Q.queries()[name](spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect())


def test_run_equals_stages_by_brute_force(spark):
    """Every decision again, on the driver, from the operators' plain definitions."""
    from test_decontaminate import brute
    from test_prob_minhash import classes_by_brute_force

    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    net = quality_net.train(docs, labels.filter(fold(labels["doc_id"]) != 1))
    rows = sorted(quality_net.judge(docs, net).filter("quality.predicted = 1").collect())
    label = classes_by_brute_force([r.text for r in rows])
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    dirty = brute([r.text for r in rows], items)
    rows = [r for r, found in zip(rows, dirty, strict=True) if not found[3]]
    left = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id bigint, text string")
    model = secret_scan.fit_on_corpus(left)
    library = Tokenizer.from_file(Q.tokenizer_path())
    want = {}
    for r in rows:
        spans = secret_scan.find_secrets(r.text, model)
        text = secret_scan.redact(r.text, spans) if spans else r.text
        want[r.doc_id] = library.encode(text, add_special_tokens=False).ids
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in out} == want and len(out) == len(want)


def test_stages_keep_the_columns_and_odd_rows(spark, documents, odd_texts):
    docs = documents([*odd_texts, "password: hunter2hunter2"], extra=True)
    docs = docs.unionAll(docs.filter("doc_id = 4"))
    docs = docs.unionAll(docs.filter("doc_id = 3").withColumn("doc_id", F.lit(None).cast("bigint")))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality", "near_duplicates", "decontamination", "secrets"):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stages[name](spark, docs.limit(0), SF).count() == 0, name
    left = stages["near_duplicates"](spark, docs, SF).collect()
    # 0, 1: empty; 4, 5, 12 and the repeated row: the same words; 3 and the row without an id.
    assert sorted(r.doc_id for r in left) == [0, 2, 3, 4, 6, 7, 8, 10, 11, 13]
    changed = {r.doc_id: r for r in stages["secrets"](spark, docs, SF).collect()}
    assert changed[13].text == "[assign]" and changed[13].n_chars == 8
    tokens = stages["tokens"](spark, docs, SF)
    assert tokens.count() == docs.count()
    assert stages["tokens"](spark, docs.limit(0), SF).count() == 0
