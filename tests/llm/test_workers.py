"""Workers that do not have the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.llm.conftest import FOLDER

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())

def imported(batches):
    import importlib.util, pandas
    for _ in batches:
        yield pandas.DataFrame({{"found": [importlib.util.find_spec("scorebook") is not None]}})

assert not spark.range(1).mapInPandas(imported, "found boolean").first()[0]
from scorebook.llm.queries import QUERIES
print(QUERIES[{query!r}](spark, {folder!r}).count())
"""


@pytest.mark.parametrize(
    "query", ["op2_secret_scan", "op7_quality_classifier", "op8_token_counts", "op9_language_id", "op10_decontamination", "op11_toxicity", "op12_spelling_variants", "op13_token_alignment"]
)
def test_workers_need_no_copy_of_the_package(tmp_path, query):
    repo = str(Path(__file__).resolve().parents[2])
    script = SCRIPT.format(repo=repo, query=query, folder=str(FOLDER))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split()[-1].isdigit()
