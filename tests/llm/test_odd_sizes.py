"""Very long texts and empty tables for the operators whose own tests have none."""

import hashlib

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerloom.llm import decontamination, fill_in_middle, pieces, pseudonyms, ranked_search, repetition, sharding, token_counts

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{k % 977} and {k * 7919 % 10007}." for k in range(130_000))


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([(1, LONG), (2, "short text here"), (3, "x" * 300_000), (4, None)], "doc_id long, text string").repartition(4)


def test_token_counts_of_long_texts(long):
    library = Tokenizer.from_file(WORDS)
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(long, WORDS).collect()}
    assert found[1] == (len(LONG), len(library.encode(LONG, add_special_tokens=False).ids)) and found[4] == (0, 0)


def test_pieces_of_long_texts(long):
    library = SentencePieceProcessor(model_file=PIECES)
    found = {r.doc_id: r for r in pieces.encode_digests(long.filter("doc_id <> 3"), PIECES).collect()}
    ids = library.encode(LONG)
    assert found[1].n_tokens == len(ids) and found[1].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_other_operators_on_long_texts(long, make):
    assert {r.doc_id: r.n_words for r in repetition.repetition(long).collect()} == {1: 390_000, 2: 3, 3: 1, 4: 0}
    assert {r.doc_id: r["size"] for r in sharding.shard(long, 8).collect()} == {1: len(LONG) + 1, 2: 16, 3: 300_001, 4: 1}
    assert {r.doc_id: r.n for r in fill_in_middle.digests(long).collect()} == {1: 1, 2: 1, 3: 1, 4: 0}
    assert pseudonyms.pseudonymize(long, "k").filter("text is not null").count() == 3
    items = make("item_id long, text string", (7, LONG[500:5_000]), (8, "text here"))
    found = {(r.item_id, r.doc_id) for r in ranked_search.search(long, items, 2).collect()}
    assert found == {(7, 1), (8, 2)}
    assert {r.doc_id for r in decontamination.contaminated(long, items).collect()} >= {1}
