"""The pipeline against plain versions of its stages, run on each stage's own
input; and the registration of the queries."""
import re

import corpus_pipeline as C
from quarry.llm import catalog, packing, secrets
from quarry.llm import quality_crf as Q
from quarry.llm import toxicity as T
from quarry.llm.common import stored, table
from tests.conftest import SF001
from tests.llm.fixtures import SCHEMA
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check


def test_stages_on_their_own_input(spark):
    docs = table(spark, SF001, "documents")
    labels = table(spark, SF001, "labels")
    columns, steps = docs.columns, [docs]
    for name, stage in C.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF001), "step"))
        if name != C.STAGES[-1][0]:
            assert steps[-1].columns == columns
    rows = [sorted(s.collect(), key=lambda r: r.doc_id) for s in steps]

    toxic = T.op2_toxicity(steps[0], labels).where("predicted = 0").select("doc_id").collect()
    assert [r.doc_id for r in rows[1]] == sorted(r.doc_id for r in toxic)
    good = Q.op8_quality_crf(steps[1], labels).where("predicted = 1").select("doc_id").collect()
    assert [r.doc_id for r in rows[2]] == sorted(r.doc_id for r in good)

    parts = brute([(r.doc_id, r.text) for r in rows[2]])
    assert sorted({c if n else d for d, n, c in parts}) == sorted(str(r.doc_id) for r in rows[3])

    rules = [re.compile(r.pattern, re.A) for r in secrets.RULES]
    for before, after in zip(rows[3], rows[4], strict=True):
        held = [m.span() for rule, p in zip(secrets.RULES, rules, strict=True)
                for m in p.finditer(before.text) if len(m.group(rule.group)) >= rule.least]
        text, end = "", 0
        for s, e in sorted(held):
            if s >= end:
                text += before.text[end:s] + secrets.MARK
            end = max(end, e)
        assert after.text == text + before.text[end:]
        assert after.n_chars == (len(after.text) if held else before.n_chars)

    check(rows[5], [(r.doc_id, r.text) for r in rows[4]])


def test_run_and_registration(spark):
    packed = C.run(spark, SF001)
    assert packed.columns == packing.op3_packing(table(spark, SF001, "documents")).columns
    assert packed.count() > 50
    assert [re.match(r"op\d+", q).group() for q in catalog.queries()] == [f"op{k}" for k in range(1, 14)]
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_empty_tables_pass_through(spark):
    docs = spark.createDataFrame([], SCHEMA + ", lang string, n_chars long")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0
