"""A long text that is all benchmark, under a small heap: its hits must not each carry the whole text."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

RUN = """
import sys

from shelfcast.llm import decontaminate
from shelfcast.session import build_session

conf = {"spark.driver.memory": "600m", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": sys.argv[1]}
spark = build_session("long-leaks", "local[1]", **conf)
passage = [f"w{k}" for k in range(2_000)]
docs = [(k, " ".join(passage * 4)) for k in range(2)]
items = [(7, " ".join(passage)), (8, " ".join(["other"] + [f"v{k}" for k in range(6_000)]))]
found = decontaminate.contaminated(
    spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
)
print("found", sorted(tuple(r) for r in found.collect()))
"""


def test_hits_of_a_long_text_hold_a_few_words_each(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", RUN, tmp_path.as_uri()], cwd=ROOT, capture_output=True, text=True, timeout=600, check=False
    )
    assert run.returncode == 0, run.stderr[-2_000:]
    assert "found [(0, 7, 0, 7999, 12), (1, 7, 0, 7999, 12)]" in run.stdout


STAGE = """
import sys
from pathlib import Path

import corpus_pipeline
from shelfcast.session import build_session

folder = sys.argv[1]
conf = {"spark.driver.memory": "600m", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": Path(folder).as_uri()}
spark = build_session("long-leaks-stage", "local[1]", **conf)
passage = " ".join(f"w{k}" for k in range(2_000))
spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
docs = spark.createDataFrame([(0, " ".join([passage] * 4)), (1, "clean text of few words")], "doc_id long, text string")
kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, folder)
print("kept", sorted(tuple(r) for r in kept.collect()))
"""


def test_stage_of_the_pipeline_drops_a_long_text_under_a_small_heap(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", STAGE, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=600, check=False
    )
    assert run.returncode == 0, run.stderr[-2_000:]
    assert "kept [(1, 'clean text of few words')]" in run.stdout
