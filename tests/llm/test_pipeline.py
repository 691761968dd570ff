"""The pipeline stage by stage, the registered queries against SQL, and the package without this subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F
from test_documents import base_counts, lines_kept, near_groups
from tokenizers import Tokenizer

import corpus_pipeline
from jobtide.llm import quality, queries
from jobtide.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL.keys() - {"pipeline"}))
def test_query_matches_sql(spark, con, name):
    difference = oracle.compare(spark, con, SF_DIR, queries.QUERIES[name], queries.SQL[name])
    assert difference is None, difference


def test_every_operator_and_the_pipeline_are_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
        assert name == "encode" or docs.columns == COLUMNS
    given = rows(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    good = rows(kept["quality"])
    assert set(good) <= {r for r in given if not base_counts(r[1])[5]} and len(good) > 0.7 * len(given)
    lines = rows(kept["line_dedup"])
    assert sorted(lines) == sorted((i, t) for i, t, _, _ in lines_kept(good))
    groups = near_groups(lines, 5, 80)
    assert sorted(rows(kept["near_dup"])) == sorted((i, t) for i, t in lines if groups[i][1] == i)
    assert sorted(rows(kept["mix"])) == sorted(rows(kept["near_dup"]))
    assert kept["mix"].where("n_chars <> length(text)").isEmpty()
    library = Tokenizer.from_file(queries.public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(rows(kept["mix"]))
    for r in kept["encode"].collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids) and r["n_tokens"] == len(ids)
    assert kept["encode"].count() == len(texts)
    places = kept["encode"].select("part", "row").distinct()
    assert places.count() == len(texts) and places.where("part is null or row is null").isEmpty()


def test_the_pipeline_of_odd_rows(spark, tmp_path):
    folder = str(tmp_path / "sf")
    words = " ".join(f"word{n}" for n in range(70))
    data = [(1, words, None, None, None), (1, words, "en", "a", 3), (None, words + " x", "en", "a", 1), (2, None, "en", "a", 0), (3, "", None, "b", 0), (4, words + " end", "en", "b", 2)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    frame.withColumns({"slot": F.lit("s"), "kept": F.lit(1), "row": F.lit(5)}).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = sorted(map(repr, ((r["doc_id"], r["n_tokens"] > 0) for r in corpus_pipeline.run(spark, folder).collect())))
    assert got == sorted(map(repr, [(1, True), (1, True), (None, True)]))


def test_quality_stores_each_text_once(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(quality, "stored", lambda df, name, *by: asked.append((name, df.schema)) or stored(df, name, *by))
    docs = spark.createDataFrame([(n, " ".join(f"word{n}-{i}" for i in range(60)), "en", "a", 3) for n in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.good_documents(spark, docs, str(tmp_path))
    assert kept.columns == COLUMNS and sorted(rows(kept)) == sorted(rows(docs))
    schema = dict(asked)["scored"].simpleString()
    assert schema.count("text:string") == 1


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(n[:2] == 'op' for n in q); assert set(q) == set(e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
