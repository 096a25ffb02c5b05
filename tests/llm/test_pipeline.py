"""The whole flow, each stage held against plain Python on its own input."""

import os

import pytest

from touchline.session import materialize

FOLDER = "/root/testdata/sf0.001"
pipeline = pytest.importorskip("corpus_pipeline")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, FOLDER), "stage")
        found.append((name, docs, out))
        docs = out
    return found


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    assert [name for name, _, _ in stages] == [
        "toxicity", "line dedup", "simhash near-dedup", "mixing sources to target weights", "packing",
    ]
    assert all(out.columns == docs.columns for _, docs, out in stages[:-1])


def test_toxicity_keeps_documents_as_they_are(stages):
    _, docs, out = stages[0]
    assert set(pairs(out)) <= set(pairs(docs)) and out.count() > 0.7 * docs.count()


def test_lines(stages):
    from test_lines import expected

    _, docs, out = stages[1]
    wanted, _ = expected(pairs(docs))
    assert dict(pairs(out)) == wanted


def test_one_document_of_each_group(stages):
    from test_simhash import fingerprint, groups

    _, docs, out = stages[2]
    rows = pairs(docs)
    reach, least = groups([fingerprint(t) for _, t in rows]), {}
    for i, t in rows:
        group = reach[fingerprint(t)]
        least[group] = min(i, least.get(group, i))
    assert sorted(i for i, _ in pairs(out)) == sorted(least.values()) and set(pairs(out)) <= set(rows)


def test_mix(stages):
    from collections import Counter

    from test_mixing import expected, size

    _, docs, out = stages[3]
    rows, taken = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()], Counter()
    _, targets = expected(rows)
    texts = {i: " ".join((t or "").split()) for i, t, _ in rows}
    for r in out.collect():
        assert " ".join(r.text.split()) in texts[r.doc_id] and r.n_chars == len(r.text)
        taken[r.source] += size(r.text)
    assert all(abs(taken[s] - t) <= 0.02 * t + 64 for s, t in targets.items())


def test_packing(stages):
    from test_packing import check

    _, docs, out = stages[4]
    check(pairs(docs), out.collect())
