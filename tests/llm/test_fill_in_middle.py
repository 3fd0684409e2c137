import hashlib
import re
from collections import Counter

from ledgerloom.llm import fill_in_middle
from ledgerloom.llm.fill_in_middle import Plan


def by_hand(id, text):
    """The contract, line by line."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if id is None else id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 100:
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return n, "psm", len(prefix), len(middle), "<P>" + prefix + "<S>" + suffix + "<M>" + middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "a\r\nb\r\n\r\nc", "é\nß\U0001f600x\n" * 40, "<P", "<P\n>x", "a<P>b\nc", "<S>\n", "x\n<M>",
    "<<\nS>\n<", "S>\nM>\nP>", "<M\n<S\n<P\n", "\x00\n\x0b \n", "line of text\n" * 30_000, "\n" * 50_000, "x" * 300_000,
] + [f"line {k} of\n" * (k % 9) + "end" * (k % 2) for k in range(60)]


def test_rows_as_by_hand(make, monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.text.CHUNK", 1 << 14)
    rows = [(i * 13, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[8]), (5, TEXTS[8]), (None, "a\nb\nc\n"), (None, None)]
    docs = make("doc_id long, text string, n int, form string, output string", *[(*r, 0, "x", "y") for r in rows])
    wanted = Counter()
    for i, text in rows:
        n, form, prefix, middle, out = by_hand(i, text)
        wanted[i, n, form, prefix, middle, sha(out), sha(text or "")] += 1
    assert Counter(tuple(r) for r in fill_in_middle.digests(docs).collect()) == wanted
    whole = fill_in_middle.fill_in_middle(docs).collect()
    assert {r.form for r in whole} == {"plain", "psm", "spm"}
    assert Counter((r.doc_id, r.output) for r in whole) == Counter((i, by_hand(i, t)[4]) for i, t in rows)
    assert fill_in_middle.digests(docs.limit(0)).collect() == []


def test_rates_and_units(make):
    docs = make("doc_id long, text string", *[(i, "a b c d e f") for i in range(400)])
    found = fill_in_middle.fill_in_middle(docs, Plan(seed="s", rate=50, spm_rate=0, unit=r"\s*\S+")).collect()
    forms = Counter(r.form for r in found)
    assert set(forms) == {"plain", "psm"} and 150 < forms["plain"] < 250
    assert {r.n for r in found} == {6}
