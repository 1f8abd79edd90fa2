"""The registered queries and the pipeline on the given tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tablezones.llm import decontam, jaccard_join, line_dedup, quality_gam
from tablezones.llm.queries import ORACLES, QUERIES
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    ok, n, detail = compare(spark, duck(SF), key, QUERIES[key], ORACLES[key], SF)
    assert ok and n > 0, detail


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_held_out_quality_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_gam"](spark, sf).where("held_out").toPandas().set_index("doc_id")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    both = [(got.score[i], q) for i, q in labels.items() if i in got.index]
    good, bad = [s for s, q in both if q == 1], [s for s, q in both if q == 0]
    assert bad and sum((a > b) + (a == b) / 2 for a in good for b in bad) / len(good) / len(bad) >= 0.95


def test_stages_take_effect(spark):
    """Each stage on what its predecessor kept, against the operator's own verdicts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    good = stage["quality"](spark, docs, SF).cache()
    verdicts = quality_gam.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert good.columns == columns and ids(good) == ids(verdicts.where("predicted = 1")) and good.count() < docs.count()
    lines = stage["lines"](spark, good, SF).cache()
    assert lines.columns == columns and ids(lines) == ids(good) and lines.where("n_chars <> length(text)").isEmpty()
    assert sorted(r.text for r in lines.collect()) == sorted(r.text for r in line_dedup.drop_boilerplate(good).collect())
    single = stage["near_duplicates"](spark, lines, SF).cache()
    assert single.columns == columns and ids(single) == ids(jaccard_join.similar_components(lines).where("doc_id = component_id"))
    clean = stage["decontamination"](spark, single, SF).cache()
    flagged = ids(decontam.contaminated(single, spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert clean.columns == columns and ids(clean) == sorted(set(ids(single)) - set(flagged))
    packed = stage["packing"](spark, clean, SF)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(clean)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()


def test_rare_repeats_go_and_copies_stay(spark):
    """A line on 1 % of a source's pages goes from them; pages that are copies of one another keep their text."""
    own = lambda i: "\n".join(f"line {k} of page {i} and of no other" for k in range(4))
    rows = {i: f"{own(i)}\nshare this page" if i < 10 else own(i) for i in range(1000)}
    rows |= {1000 + i: own("x") for i in range(12)} | {2000 + i: f"{own('y')}\nedit {i}" for i in range(12)}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["lines"](spark, docs, SF).collect()}
    assert got == {i: own(i) if i < 10 else t for i, t in rows.items()}


def test_entry_works_without_the_subpackage(tmp_path):
    """As when the folder and the pipeline file are deleted."""
    script = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tablezones.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') for k in e.queries()))\n"
    )
    repo = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", script], env=dict(os.environ, PYTHONPATH=repo), capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.split() == ["35", "35", "False"], done.stderr[-2000:]
