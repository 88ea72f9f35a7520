import pytest

import corpus_pipeline
from sparkmart.llm.queries import QUERIES, SQL
from tests_llm_helpers import corpus, folder, no_docs, tables  # noqa: F401

SF = "/root/testdata/sf0.001"


def texts_after(k, texts, items):
    """Texts that stage ``k`` keeps of a list of texts, by plain versions; rows count, not ids."""
    from test_duplicates import components_of
    from test_text_rules import base_counts, overlaps_by_hand

    rows = list(enumerate(texts))
    if k == 0:  # too few labels for more than the base rule
        counts = [base_counts(t or "") for t in texts]
        return [t for t, (n, _, _, _, repeated) in zip(texts, counts) if not (n < 10 or 100 * repeated > 20 * n)]
    if k == 1:
        _, component = components_of(rows)
        return [t for i, t in rows if component[i] == i]
    if k == 2:
        leaks = {i for i, _ in overlaps_by_hand(rows, items)}
        return [t for i, t in rows if i not in leaks]
    return texts


def test_stages_on_odd_tables(spark, tables, corpus, folder):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == names and after.schema == docs.schema
            want = texts_after(k, [r.text for r in docs.collect()], items)
            got = [r.text for r in after.collect()]
            assert len(got) == len(want) if k == 3 else sorted(got, key=str) == sorted(want, key=str), k
        else:
            left = {r.doc_id for r in docs.collect()}
            assert {r.doc_id for r in after.collect()} == left
        docs = after


def test_stages_on_empty_tables(spark, tables, no_docs):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, no_docs, tables)
        assert out.collect() == []
        assert k == 4 or out.columns == no_docs.columns


def test_each_stage_takes_effect(spark):
    """Against plain versions of the decisions, on the smallest tables."""
    import re

    from test_duplicates import components_of
    from test_text_rules import base_counts, overlaps_by_hand, spans_by_hand

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    failed = set()
    for i, text in rows:
        n, _, _, _, repeated = base_counts(text)
        if n < 10 or 100 * repeated > 20 * n:
            failed.add(i)
    assert ids(stage["quality rules"](spark, docs, SF)) == {i for i, _ in rows} - failed  # too few labels for more
    _, component = components_of(rows)
    assert ids(stage["near duplicates"](spark, docs, SF)) == {i for i, c in component.items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, _ in overlaps_by_hand(rows, items)}
    assert leaks and ids(stage["benchmark decontamination"](spark, docs, SF)) == {i for i, _ in rows} - leaks
    masked = {r.doc_id: r for r in stage["secret scan"](spark, docs, SF).collect()}
    for i, text in rows:
        spans = spans_by_hand(text)
        assert ("[SECRET]" in (masked[i].text or "")) or not spans
        if not spans and "[SECRET]" not in (masked[i].text or ""):
            assert masked[i].text == text
        for s, _, e in spans:
            assert text[s:e] not in masked[i].text
        assert not re.search("AKIA[A-Z0-9]{16}", masked[i].text or "")


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns)
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    from compare import differences, duck

    assert differences(name, QUERIES[name](spark, SF), duck(SF), SQL[name]) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_quality_rules_judge_rows_not_ids(spark, tables):
    """Repeated rows, NULL ids, and one id with two texts, of which one is junk."""
    from tests_llm_helpers import invented

    good = [invented(k, 40) for k in range(800, 803)]
    rows = [(None, "junk"), (None, good[0]), (5, "short one"), (5, good[1]), (6, good[2]), (6, good[2]), (7, None), (None, good[0])]
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in rows], "doc_id long, text string, lang string, n_words string").repartition(3)
    left = dict(corpus_pipeline.STAGES)["quality rules"](spark, docs, tables)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([r for r in rows if r[1] in good], key=str)


def test_decontamination_judges_rows_not_ids(spark, tables):
    from tests_llm_helpers import invented

    item = invented(7, 30)  # an item of the benchmark
    clean = [invented(k, 40) for k in range(810, 814)]
    leak = clean[0] + " " + item
    rows = [(None, leak), (None, clean[1]), (None, clean[2]), (4, leak), (4, clean[3]), (4, clean[3]), (5, leak), (5, leak), (6, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _leak string").repartition(3)
    left = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, tables)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([r for r in rows if r[1] != leak], key=str)


def test_near_duplicates_are_counted_by_rows(spark):
    """Repeated rows, NULL ids, and one id with two texts."""
    from tests_llm_helpers import invented

    a, b, c, d = (invented(k, 60) for k in range(700, 704))
    near = a + " tail"
    rows = [(9, a), (3, a), (3, a), (None, near), (None, b), (None, b), (5, c), (5, d), (8, d), (2, None), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = dict(corpus_pipeline.STAGES)["near duplicates"](spark, docs, SF)
    assert left.columns == docs.columns
    want = [(3, a), (None, b), (5, c), (5, d), (2, None), (2, None)]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)
