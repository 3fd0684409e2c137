import random
import re
from collections import Counter

from ledgerloom.llm import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    seen, dup, chars = set(), 0, 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        if own:
            if line in seen:
                dup, chars = dup + 1, chars + sum(map(len, own))
            seen.add(line)
    out |= {"n_dup_lines": dup, "dup_line_chars": chars}
    for n in repetition.MOST_IN_NGRAMS:
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        often = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(n)}
        out[f"chars_in_{n}"] = sum(len(words[i]) for i in inside)
        if n == 5:
            out["n_repeat_words"] = len(inside)
    out["base_failed"] = out["n_words"] < 10 or 100 * out["n_repeat_words"] > 20 * out["n_words"]
    return out


def texts():
    rng = random.Random(9)
    made = [None, "", " \n\t", "x", "a b\n" * 30, "é " * 50, "\n\na b c d e f g h i j\n\r\n \na b c d e f g h i j", "x" * 100_000, "a\u2003b\x1cc " * 6]
    for _ in range(150):
        vocabulary = rng.choice([["the", "é", "a#"], [f"w{i}" for i in range(60)]])
        made.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(1, 120))))
    return made


def test_measures(make, monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.text.CHUNK", 1 << 12)
    made = texts()
    rows = make("doc_id long, text string, kept string, id int", *[(i, t, "k", 0) for i, t in enumerate(made)], (None, made[4], "k", 0))
    found = repetition.repetition(rows).collect()
    assert len(found) == len(made) + 1
    for r in found:
        text = made[4] if r.doc_id is None else made[r.doc_id]
        wanted = by_hand(text)
        assert {c: r[c] for c in wanted} == wanted, repr(text)
        assert not (r.kept and r.base_failed)
    assert repetition.repetition(rows.limit(0)).collect() == []


def test_verdict(make):
    rng = random.Random(2)
    clean = " ".join(f"w{rng.randrange(5000)}" for _ in range(300))
    line = "the same long line comes again and again here\n"
    rows = make("doc_id long, text string", (1, clean), (2, clean + "\n" + line * 20), (3, line * 3), (4, "too short"))
    assert {r.doc_id: r.kept for r in repetition.repetition(rows).collect()} == {1: True, 2: False, 3: False, 4: False}
