"""The pipeline on a planted corpus, and the registration of the text operators."""

import random
import subprocess
import sys

import corpus_pipeline
from tests.llm.conftest import prose
from townsquare.llm.queries import QUERIES


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(31)
    clean = [(k, prose(rng, 120, 4000), "en", f"s{k % 3}") for k in range(60)]
    item = prose(rng, 30, 4000)
    rows = [*clean, (100, "too short", "en", "s0"), (101, None, "en", "s0"), (102, clean[5][1], "en", "s1")]
    near = clean[6][1].split()
    near[50] = "changed"
    rows += [(103, " ".join(near), "en", "s2"), (104, f"{prose(rng, 60, 4000)}. {item} {prose(rng, 60, 4000)}", "en", "s0")]
    rows.append((105, f"{prose(rng, 100, 4000)} mail me@here.org {prose(rng, 20, 4000)}", "en", "s1"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert set(range(60)) <= ids
        assert k > 3 or ids == set(range(60)) | [{102, 103, 104, 105}, {104, 105}, {105}, {105}][k]
    assert "mix_epochs" in docs.columns and docs.where("text like '%me@here.org%'").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_all_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]


def test_the_entry_works_without_the_text_operators(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('townsquare.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'op1_language_id' not in e.queries() and 'pearson' in e.queries()\n"
        "assert not set(e.oracle_sql()) - set(e.queries())\n"
    )
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
