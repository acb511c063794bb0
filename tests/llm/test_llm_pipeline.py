"""The pipeline's stages one by one, each judged on its own input."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from llm_helpers import awkward, near_duplicate_components
from test_llm_documents import _check_packing, _kept_lines, _targets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into every stage, and what the last one returns."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs))
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    return dict(out), docs


def test_toxicity_stage_keeps_clean_documents(spark, steps):
    before, after = ({r.doc_id for r in steps[0][n].collect()} for n in ("toxicity", "line_dedup"))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    assert after <= before and sum(i in after for i in clean) >= 0.97 * len(clean)


def test_line_dedup_stage(steps):
    before, after = ({r.doc_id: r.text for r in steps[0][n].collect()} for n in ("line_dedup", "minhash_near_dedup"))
    assert after == _kept_lines(list(before.items()))
    assert all(r.n_chars == len(r.text) for r in steps[0]["minhash_near_dedup"].collect())


def test_near_dedup_stage_leaves_one_of_each_group(steps):
    before, after = ({r.doc_id: r.text for r in steps[0][n].collect()} for n in ("minhash_near_dedup", "source_mixing"))
    _, parts = near_duplicate_components(list(before.items()), 5, 80)
    assert set(after) == {i for i, part in parts.items() if i == part}
    assert all(after[i] == before[i] for i in after)


def test_mixing_stage_meets_its_targets(steps):
    before, after = (steps[0][n].collect() for n in ("source_mixing", "best_fit_packing"))

    def words(rows):
        out = Counter()
        for r in rows:
            out[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        return out

    size, taken = words(before), words(after)
    assert all(abs(taken[s] - want) <= 1 for s, want in _targets(size).items())
    own = {r.doc_id: len((r.text or "").split()) for r in before}
    assert all(len(r.text.split()) <= 3 * own[r.doc_id] for r in after) and len({r.doc_id for r in after}) == len(after)


def test_packing_stage(steps):
    _check_packing(steps[1].collect(), {r.doc_id: r.text for r in steps[0]["best_fit_packing"].collect()})


def test_stages_keep_the_columns(steps):
    assert len({tuple(sorted(df.dtypes)) for df in steps[0].values()}) == 1


def test_run_applies_all_stages(spark, steps):
    assert corpus_pipeline.run(spark, FOLDER).count() == steps[1].count()


def test_stages_on_awkward_and_empty_rows(spark):
    for docs in (awkward(spark), awkward(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()
