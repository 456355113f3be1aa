"""The pipeline's stages, each on what the stage before kept."""

import importlib.util
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF01
from edges import rows, word_salad
from tablewright.llm import line_dedup, mixing, simhash
from tablewright.session import scratch_path

TOP = Path(__file__).resolve().parents[2]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    names, seen = docs.columns, [docs]
    for name, stage in P.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, seen[-1], SF01).write.parquet(path)
        seen.append(spark.read.parquet(path))
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "mixing", "sentencepiece"]
    assert all(d.columns == names for d in seen[:5])
    toxic, lines, near, mixed, coded = seen[1:]
    clean = spark.read.parquet(f"{SF01}/labels.parquet").where("toxic = 0")
    assert clean.join(toxic, "doc_id", "left_anti").count() <= 0.02 * clean.count()
    assert lines.count() == toxic.count()
    assert lines.where(F.length("text") != F.col("n_chars")).count() == 0
    want = {(r.doc_id, r.text) for r in line_dedup.line_dedup(toxic, min_pages=P.MIN_PAGES, equal_once=True).collect()}
    assert {(r.doc_id, r.text) for r in lines.collect()} == want
    groups = simhash.simhash_groups(lines).collect()
    assert {r.doc_id for r in near.collect()} == {r.component for r in groups}
    copies = {r.doc_id: r.copies for r in mixing.mix_counts(near).collect()}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
    assert coded.count() == mixed.count() and coded.where("not round_trip").count() == 0


def test_every_text_has_a_survivor(spark, tmp_path):
    """Exact copies on most pages of a source: after the stages that drop
    documents, one of each group is left with its whole text."""
    groups = {g: "\n".join(f"{g} line {i} " + word_salad(100 * g + i, 12) for i in range(5)) for g in range(8)}
    data = [(1000 * g + i, t, "en", f"s{g % 2}", len(t)) for g, t in groups.items() for i in range(40 if g < 2 else 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in P.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert {(r.doc_id, r.text) for r in docs.collect()} == {(1000 * g, t) for g, t in groups.items()}


def test_stages_on_edges(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for data in (rows(), []):
        docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in data], schema)
        for _, stage in P.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert (docs.count() > 0) == bool(data)


def test_run(spark):
    assert P.run(spark, SF01.replace("sf0.01", "sf0.001")).count() > 0


def test_registered(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in q if k.startswith("op")}
    assert "pipeline" in q


def test_rest_imports_without_the_text_operators(tmp_path):
    """A copy of the repository without them still registers the others."""
    import shutil
    for p in TOP.iterdir():
        if p.name in ("tablewright", "__spark_entry__.py"):
            (shutil.copytree if p.is_dir() else shutil.copy)(p, tmp_path / p.name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if p.is_dir() else {}))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; q = E.queries(); print(len(q), any(k.startswith('op') for k in q))"],
                         cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    n, text = out.stdout.split()
    assert int(n) >= 60 and text == "False"
    assert importlib.util.find_spec("tablewright.llm")
