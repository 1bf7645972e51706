"""The stages one by one, and the whole, against plain versions."""

from collections import Counter

import corpus_pipeline
import llm_helpers as plain_python
from compare import connect, differences
from llm_helpers import awkward_rows, documents, plain
import pytest

from shelfcast.llm.catalog import LLM_ORACLE, LLM_QUERIES
from shelfcast.llm.rows import table
from shelfcast.session import materialize
from test_lines_and_leaks import _cut, _leaks


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), LLM_QUERIES[name], LLM_ORACLE[name], sf_dir) == ""


def test_all_queries_are_named():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
    assert [f.__module__ for _, f in corpus_pipeline.STAGES] == ["corpus_pipeline"] * 5


def test_stages_equal_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        columns = docs.columns
        docs = materialize(stage(spark, docs, sf_dir))
        after = docs.collect()
        if name != "mix":
            assert docs.columns == columns
        if name == "language":
            assert plain(after) == plain(r for r in before if any(c.isalpha() for c in r[1] or ""))
        if name == "line_spread":
            rows = [(i, t, lang, s) for i, t, lang, s, _ in before]
            family = [c for _, _, c in plain_python.near_duplicates(rows)]
            cut = {i: new for i, new, _, _ in _cut(rows, 8, family)}
            assert plain(after) == plain((i, cut[i], lang, s, len(cut[i]) if cut[i] != t else n) for i, t, lang, s, n in before)
        if name == "near_duplicates":
            groups = {i: component for i, _, component in plain_python.near_duplicates(before)}
            assert len(after) < len(before) and plain(after) == plain(r for r in before if groups[r[0]] == r[0])
        if name == "decontamination":
            dirty = {d for d, *_ in _leaks(before, items)}
            assert dirty and plain(after) == plain(r for r in before if r[0] not in dirty)
        if name == "mix":
            assert plain((r.doc_id, r.size) for r in after) == plain((r[0], len(r[1].split())) for r in before)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert plain(whole.collect()) == plain(after)


def test_stages_on_awkward_and_empty_rows(spark, sf_dir):
    docs = documents(spark, awkward_rows())
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0
        after = materialize(stage(spark, docs, sf_dir))
        if name != "mix":
            assert after.columns == docs.columns
            assert not Counter(r.doc_id for r in after.collect()) - Counter(r.doc_id for r in docs.collect())
            docs = after
    assert docs.count() > 20
