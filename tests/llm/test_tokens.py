import random

import public_tokenizers
import pytest
from conftest import got
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerloom.llm import pieces, token_counts

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = "aAbBzZ 'sStT\t\n\x0b\x1c\x1f\x85\xa0 éÉÀßΣσςİıǅ①½٣漢字🙂👩‍é­​▁<|>#*$09_-.,　﻿\x00"
TEXTS = ["", " ", "▁", "▁▁ a", "  a  b ", "a\n\n b", "<|endoftext|>a <|startoftext|>", "<|ENDOFTEXT|>", "I'm they'RE 'LL", "\nx", "x \n",
         "<s> </s> <unk> <0x41>", "ΑΣ ΑΣ.", "e\u0301 é", "ab" * 20_000]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return TEXTS + ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_counts_are_those_of_the_library():
    rules, library = token_counts.Vocabulary(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts(3000, 1):
        assert rules.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_merging_counts_merges_only():
    pairs = {1 << 20 | 2: (1, 4), 2 << 20 | 3: (0, 5), 1 << 20 | 5: (2, 6)}
    assert token_counts.merges([1, 2, 3], pairs) == 2  # the better pair first, then what it makes possible
    assert token_counts.merges([1, 2], pairs) == 1 and token_counts.merges([3, 1], pairs) == 0


def test_ids_and_decoded_texts_are_those_of_the_library():
    own, library = pieces.Pieces(PIECES), SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts(3000, 2)
    for text, (ids, decoded) in zip(texts, own.encode(texts)):
        wanted = library.encode(text)
        assert ids == ",".join(map(str, wanted)), repr(text)
        assert decoded == library.decode(wanted), repr(text)


def test_segments_together_are_as_each_by_itself():
    own, rng = pieces.Pieces(PIECES), random.Random(4)
    segments = ["".join(rng.choice(rng.choice(["abcdefghinorst", ODD])) for _ in range(rng.randint(1, 60))) for _ in range(3000)] + ["", "\n", "\na"]
    assert own.encode_segments(segments) == [own.encode_segment(s) for s in segments]
    # Equal scores: the leftmost pair first.
    pairs = {1 << 20 | 2: (0, 7), 2 << 20 | 3: (0, 6), 3 << 20 | 1: (1, 8)}
    table = pieces.PairTable(pairs)
    for symbols in ([1, 2, 3], [2, 3, 1, 2], [2, 3, 3, 1], [3, 3]):
        (_, ids), = pieces.agendas(pieces.np.array([symbols]), table)
        assert ids[0].tolist() == pieces.agenda(symbols, pairs)


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 100)
    own, library = pieces.Pieces(PIECES), SentencePieceProcessor(model_file=PIECES)
    long = "x" * 500 + "yé" * 300
    for k in range(50):
        text = f"some words {k} {k * 7919} again {long}"
        assert own.encode([text])[0][0] == ",".join(map(str, library.encode(text)))
        assert sum(map(len, own.known)) < 200 and long not in own.known


def test_a_difference_from_the_library_is_not_passed_over():
    own = pieces.Pieces(PIECES)
    own.pairs.clear()
    own.table = pieces.PairTable({})
    with pytest.raises(ValueError, match="differs"):
        own.encode(["hello"])


@pytest.fixture
def rows(make):
    return make("doc_id long, text string, n_tokens string, id int, ids int",
                (1, "Hello hello world", "x", 1, 1), (1, "Hello hello world", "x", 1, 1), (2, None, "x", 1, 1), (3, "", "x", 1, 1), (None, "a", "x", 1, 1))


def test_token_count_rows(rows):
    assert got(token_counts.token_counts(rows, WORDS, limit=2)) == sorted([
        (1, 17, 3, True), (1, 17, 3, True), (2, 0, 0, False), (3, 0, 0, False), (None, 1, 1, False)], key=repr)
    assert got(token_counts.token_counts(rows.limit(0), WORDS)) == []


def test_encoded_rows(rows):
    found = {r.doc_id: (r.ids, r.decoded) for r in pieces.encode(rows, PIECES).collect()}
    assert found[2] == found[3] == ([], "") and found[1][1] == "Hello hello world"
    digests = {r.doc_id: r for r in pieces.encode_digests(rows, PIECES).collect()}
    assert digests[1].n_tokens == len(found[1][0])
    assert digests[1].ids_sha256 == pieces.hexdigest(",".join(map(str, found[1][0])))
    assert pieces.encode(rows, PIECES).count() == 5 and got(pieces.encode_digests(rows.limit(0), PIECES)) == []
