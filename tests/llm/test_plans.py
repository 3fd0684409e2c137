import re
from pathlib import Path

import ledgerloom.llm
from conftest import SMALL
from ledgerloom.llm.queries import QUERIES

ROOT = Path(ledgerloom.llm.__file__).parent


def test_source():
    text = "\n".join(p.read_text() for p in ROOT.glob("*.py"))
    assert not re.search(r"localCheckpoint|toPandas|crossJoin|\.rdd\b|F\.broadcast", text)
    # Broadcasts are of model tables, whose size has a bound.
    assert text.count("sparkContext.broadcast(") == text.count("sparkContext.broadcast(ngram.tables(") == 2


def test_native_operators_run_no_python(spark):
    for name in ("op2_pseudonyms", "op5_decontamination", "op9_url_filter"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan), name
    for name in ("op2", "op5", "op9"):
        file = {"op2": "pseudonyms", "op5": "decontamination", "op9": "url_filter"}[name]
        assert not re.search(r"udf|mapIn|applyIn|pandas|numpy", (ROOT / f"{file}.py").read_text(), re.IGNORECASE)


def test_only_text_reaches_the_scan(spark):
    plan = QUERIES["op1_token_counts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["doc_id:bigint,text:string"]
