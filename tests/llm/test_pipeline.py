"""The pipeline against plain Python, stage by stage and as a whole."""

from __future__ import annotations

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from slicecheck.llm import source_mix, toxic_terms
from tests.llm.fixtures import bag, empty, groups, nasty
from tests.llm.test_tokens import TIKTOKEN

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
LOWER = {c: c + 32 for c in range(65, 91)}


def test_stages_in_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "without_toxic", "exact_copies", "near_copies", "mixed_sources", "token_ids",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_rows_of_a_whole_run(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxic_terms.score(table, toxic_terms.learn(table, labels)).collect()}
    docs = [r for r in table.collect() if scores[r.doc_id] < 0.5]
    last = {}
    for row in sorted(docs, key=lambda r: r.doc_id):
        last[(row.text or "").translate(LOWER)] = row
    docs = sorted(last.values(), key=lambda r: r.doc_id)
    docs = [docs[min(g)] for g in groups([r.text for r in docs])]
    # The mix: whole documents as often as their first word is inside the target.
    mix = source_mix.Mix(spark.createDataFrame(docs, table.schema))
    sources = {r.number: r for r in mix.sources.collect()}
    expected = Counter()
    text = {r.doc_id: r.text for r in docs}
    for row in mix.placed.collect():
        source = sources[row.number]
        for time in range(3):
            if row["size"] and time * source.source_size + row.begin < source.words:
                ids = TIKTOKEN.encode_ordinary(text[row.id])
                expected[(row.id, len(ids), tuple(ids), True)] += 1
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    assert bag((r.doc_id, r.n_tokens, tuple(r.ids), r.round_trip) for r in found.collect()) == expected


def test_stages_keep_columns_and_take_awkward_rows(spark):
    for rows in (nasty(spark), empty(spark)):
        columns = rows.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF_DIR)
            assert rows.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).where("NOT round_trip").isEmpty()


def test_the_rest_works_without_this_folder(tmp_path):
    for name in ("checks", "slicecheck"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(q[:2] == 'op' for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
