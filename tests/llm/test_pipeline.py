"""The pipeline's stages on odd tables, and the registered queries against SQL."""

import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import assert_same, connect

import corpus_pipeline
from slugline.llm.queries import ORACLES, QUERIES

REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_check(spark, small, name):
    assert_same(QUERIES[name](spark, small), connect(small), ORACLES[name])


def test_stages_keep_the_columns_and_clean_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        if name in ("language", "repeated_lines"):
            assert out.count() >= docs.count() - 2
    pieces = corpus_pipeline.run(spark, small)
    assert pieces.count() > 0 and pieces.where("length > 2048").count() == 0


def test_stages_on_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_the_rest_works_without_this_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('slugline.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'scan_events' in e.queries() and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)
