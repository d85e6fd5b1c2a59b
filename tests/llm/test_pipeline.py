"""The corpus pipeline: each stage on its own input, the whole run, and the repository without it."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from test_encoding import PATH, places_hold
from test_lines import plain
from test_shingles import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tierflow.llm import language, line_dedup, registry
from tierflow.llm.common import components

FOLDER = "/root/testdata/sf0.001"
REPO = Path(corpus_pipeline.__file__).resolve().parent


@pytest.fixture(scope="module")
def inputs(spark):
    """Each stage's input and the last one's result, written and read again."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.stored(stage(spark, docs[-1], FOLDER), "test-stage"))
    return docs


def test_stages_keep_the_columns_of_documents(inputs):
    assert [len(corpus_pipeline.STAGES), len(inputs)] == [4, 5]
    assert all(d.schema.names == inputs[0].schema.names for d in inputs[1:-1])


def test_language_stage_drops_only_what_has_no_language(spark, inputs):
    labels = {r.doc_id: r for r in language.label_languages(inputs[0], language.fit(inputs[0])).collect()}
    kept = {r.doc_id for r in inputs[1].collect()}
    assert kept == {i for i, r in labels.items() if r.lang_pred != "und" and r.score >= language.LEAST_SCORE}


def test_line_stage_equals_the_plain_version(inputs):
    before = [(r.doc_id, r.text) for r in inputs[1].collect()]
    expected = plain(before, line_dedup.MIN_WORDS)
    after = inputs[2].collect()
    assert {r.doc_id: r.text for r in after} == expected
    assert all(r.n_chars == len(r.text) for r in after)


def test_join_stage_keeps_one_of_each_group(inputs):
    groups = brute([(r.doc_id, r.text) for r in inputs[2].collect()])
    assert {r.doc_id for r in inputs[3].collect()} == {c for _, c in groups.values()}


def test_last_stage_packs_every_kept_document(inputs):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    rows = inputs[4].collect()
    places_hold(rows, 2048)
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1
                       for r in inputs[3].collect()}


def test_run_gives_the_last_stage(spark, inputs):
    rows = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows.select(key).collect())) == sorted(map(tuple, inputs[4].select(key).collect()))


def test_edge_rows_go_through_all_stages(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, id string"
    rows = [(1, None, "en", "s", 0, 1, "a"), (2, "", "en", None, 0, 1, "a"), (3, "words of one text here", "en", "s", 3, 1, "a"),
            (3, "words of one text here", "en", "s", 3, 1, "a"), (None, "words without an id", "en", "s", None, None, None),
            (5, "same words " * 400, "en", "s", 1, 1, "a"), (6, "same words " * 400, None, "s", 1, 1, "a")]
    docs = frame(schema, *rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test-edge")
        assert docs.schema.names == frame(schema).schema.names
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["3", "3", "5", "6", "None"]
    empty = frame(schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, FOLDER), "test-edge")
    assert empty.collect() == []


def test_components_match_plain_search(frame):
    rng = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)]
    root = list(range(800))
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = [low if x == high else x for x in root]
    found = {r.node: r.component for r in components(frame("a long, b long", *edges, (None, 1), (5, 5))).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root[x] for x in linked}
    assert components(frame("a long, b long")).collect() == []


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)


def test_the_rest_works_without_this_subpackage(tmp_path):
    skip = {REPO / "tierflow" / "llm", REPO / "tests", REPO / ".git", REPO / "corpus_pipeline.py"}
    shutil.copytree(REPO, tmp_path / "repo", ignore=lambda d, names: [
        n for n in names if Path(d) / n in skip or n == "__pycache__"])
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()) > 0)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, text=True,
                         capture_output=True, check=True, timeout=120).stdout.split()
    assert int(out[0]) > 20 and out[1:] == ["False", "True"]
