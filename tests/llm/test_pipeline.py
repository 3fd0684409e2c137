import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from compare import difference, oracle
from conftest import SMALL, got
from sentencepiece import SentencePieceProcessor

from ledgerloom.llm import decontamination, near_duplicates, pseudonyms, quality
from ledgerloom.llm.queries import ORACLE_SQL, PII_KEY, QUERIES


def test_names():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "sentencepiece"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), oracle(SMALL), ORACLE_SQL[name]) is None


def test_stages_take_effect(spark):
    docs, labels, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels", "benchmark"))
    good = quality.keep_good(docs, labels).checkpoint()
    ones = near_duplicates.keep_one(good).checkpoint()
    clean = decontamination.clean(ones, items).checkpoint()
    safe = pseudonyms.pseudonymize(clean, PII_KEY)
    assert docs.count() > good.count() > ones.count() > clean.count() > 0
    assert docs.columns == good.columns == ones.columns == clean.columns == safe.columns
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for r in safe.collect():
        ids = library.encode(r.text)
        wanted.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert got(corpus_pipeline.run(spark, SMALL)) == sorted(wanted, key=repr)
