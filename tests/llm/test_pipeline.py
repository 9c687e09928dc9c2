"""The pipeline against a plain version of its stages, on documents with planted copies and secrets."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from llm_fixtures import components, fingerprint, frame, lower_az

from sparkweft.llm import secrets
from sparkweft.llm.quality_rules import quality_rules


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(r.choices(words, k=n))
    texts = [prose(r.randint(60, 250)) for _ in range(60)]
    texts += [texts[3], texts[3].upper(), texts[4], texts[5] + " extra", "too short", None, "", "# $ % | " * 60 + prose(10), texts[6] + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']
    return [(k, t, "en", "s1") for k, t in enumerate(texts)]


def test_stages(spark, rows, tmp_path):
    docs = frame(spark, rows)
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, "")
        assert made.columns == docs.columns, name
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        steps.append({r.doc_id: r.text for r in docs.collect()})
    alive = {i: t for i, t, *_ in rows if i in kept}
    assert steps[0] == alive
    last = {}
    for i, t in alive.items():
        last[lower_az(t or "")] = max(i, last.get(lower_az(t or ""), -1))
    alive = {i: t for i, t in alive.items() if last[lower_az(t or "")] == i}
    assert steps[1] == alive
    roots = components([(i, fingerprint(t)) for i, t in alive.items()])
    alive = {i: t for i, t in alive.items() if roots[fingerprint(t)] == i}
    assert steps[2] == alive
    masked = {i: secrets.redacted(t, secrets.scanner().findings([t])[0][1]) for i, t in alive.items()}
    assert steps[3] == masked and masked != alive
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} == set(masked)


def test_identical_rows_and_rows_without_ids(spark):
    """Each dedup stage leaves one row of identical ones, and one of copies whose ids are null or the same."""
    r = random.Random(4)
    prose = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    one, two, three = prose(80), prose(80), prose(80)
    rows = [(7, one, "en", "s"), (7, one, "de", "t"), (7, one.upper(), "en", "s"), (None, two, "en", "s"), (None, two, "en", "s"), (None, two.replace(" ", "  "), "en", "s"), (9, three, "en", "s"), (9, three + " end", "en", "s"), (9, three + " end", "en", "s")]
    docs = frame(spark, rows).repartition(3)
    exact = corpus_pipeline.drop_copies(spark, docs, "")
    assert exact.columns == docs.columns
    assert sorted(" ".join(lower_az(x.text).split()) for x in exact.collect()) == sorted([one, two, two, three, three + " end"])
    near = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert near.columns == docs.columns
    roots = {t: fingerprint(t) for t in (one, two, three, three + " end")}
    kept = near.collect()
    assert len(kept) == len(set(components([(0, f) for f in roots.values()]).items())) == len({fingerprint(x.text) for x in kept}) or len(kept) == 3


def test_run(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 50
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
