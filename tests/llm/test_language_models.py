import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import got
from pyspark.sql import functions as F

from ledgerloom.llm import ngram, quality, text, toxicity

SF = "/root/testdata/sf0.01"
TEXTS = ["the cat sat on the mat", "the dog sat", "a cat and a dog", None, "", "thé   cát\nsat"] * 3


def events(texts):
    for text in texts:
        for word in (text or "").lower().split():
            yield from word.encode() and _events(word.encode() + b" ")


def _events(word):
    padded = b" " * (ngram.ORDER - 1) + word
    return [padded[i:i + ngram.ORDER] for i in range(len(word))]


def model_by_hand(texts):
    """Interpolated modified Kneser-Ney, straight from its definition."""
    top = Counter(events(texts))
    counts = {ngram.ORDER: top}
    for size in range(ngram.ORDER - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in {g[-size - 1:] for g in top})
    tables = {}
    for size, found in counts.items():
        n = Counter(min(c, 5) for c in found.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        d = [None] + [min(max(k - (k + 1) * y * n[k + 1] / n[k] if y is not None and n[k] else k / 2, 0.05), float(k)) for k in (1, 2, 3)]
        total, back = defaultdict(float), defaultdict(float)
        for g, c in found.items():
            total[g[:-1]] += c
            back[g[:-1]] += d[min(c, 3)]
        tables[size] = found, total, back, d

    def p(gram, size):
        if size == 0:
            return 1 / 256
        found, total, back, d = tables[size]
        gram = gram[-size:]
        if gram[:-1] not in total:
            return p(gram, size - 1)
        c = found.get(gram, 0)
        own = max(c - d[min(c, 3)], 0) / total[gram[:-1]] if c else 0.0
        return own + back[gram[:-1]] / total[gram[:-1]] * p(gram, size - 1)

    return p


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame([(0, t) for t in TEXTS], "class int, text string")
    counts = ngram.count_grams(rows, lower=True, mark_repeats=False).checkpoint()
    assert {(r["gram"], r.n) for r in counts.collect()} == {(int.from_bytes(g, "big"), n) for g, n in Counter(events(TEXTS)).items()}
    return ngram.tables(ngram.kneser_ney(counts))


def test_probabilities(model):
    p = model_by_hand(TEXTS)
    seen = [*events(TEXTS), *events(["unseen word cats", "zzz"])]
    grams = np.array([int.from_bytes(g, "big") for g in seen], np.uint64)
    found = ngram.probabilities(model, 0, grams, range(1, ngram.ORDER + 1))
    assert np.allclose(found, [p(g, ngram.ORDER) for g in seen], rtol=1e-4)
    context = b" the"
    whole = ngram.probabilities(model, 0, np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64), range(1, 6))
    assert math.isclose(whole.sum(), 1.0, rel_tol=1e-4)


def test_words_and_repeats():
    words = ngram.words_of(pa.array(["a a a b", None, "b\n b"]), lower=False, mark_repeats=True)
    assert words.rows == 3 and list(words.row) == [0, 0, 0, 0, 2, 2]
    spelled = ["".join(chr(b) for b in words.letters[0][h:h + s]) for h, s in zip(words.heads, words.sizes)]
    assert [spelled[w] for w in words.which] == ["a ", "\x01 ", "\x01 ", "b ", "b ", "\x01 "]


def test_a_model_that_is_too_large_is_refused(spark, monkeypatch):
    rows = spark.createDataFrame([(0, f"word{i} other{i * 7}") for i in range(300)], "class int, text string")
    entries = ngram.kneser_ney(ngram.count_grams(rows, True, False).checkpoint())
    monkeypatch.setattr(ngram, "MOST_ENTRIES", 1000)
    with pytest.raises(ValueError, match="entries"):
        ngram.tables(entries)


def test_the_production_tables_hold_everything(tables):
    """All trusted text of a table: every n-gram has its entry, and the bytes after any context sum to one."""
    docs, labels = tables
    trusted = docs.join(labels.filter("quality = 1"), "doc_id").select(F.lit(0).alias("class"), "text")
    counts = ngram.count_grams(trusted, lower=False, mark_repeats=True).checkpoint()
    model = ngram.tables(ngram.kneser_ney(counts))
    grams = np.sort(np.array([r.gram for r in counts.select("gram").collect()], np.int64).view(np.uint64))
    for size in range(1, ngram.ORDER + 1):
        wanted = np.unique(grams & np.uint64((1 << 8 * size) - 1))
        assert np.array_equal(model[0, False, size][0], wanted)
        assert np.array_equal(model[0, True, size][0], np.unique(wanted >> np.uint64(8)))
    contexts = np.random.default_rng(1).choice(np.unique(grams >> np.uint64(8)), 300)
    events = (contexts[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)[None, :]).ravel()
    sums = ngram.probabilities(model, 0, events, range(1, ngram.ORDER + 1)).reshape(-1, 256).sum(axis=1)
    assert np.abs(sums - 1).max() < 1e-4


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_separates(tables):
    docs, labels = tables
    found = quality.classify(docs, labels)
    assert found.count() == docs.count()
    kept = {r.quality: r.share for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.35
    stayed = quality.keep_good(docs, labels)
    assert stayed.columns == docs.columns and got(stayed.select("doc_id")) == got(found.filter("kept").select("doc_id"))


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    # Held-out labels turned around change nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.part_of(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    found = toxicity.scores(docs, turned)
    assert found.count() == docs.count() and found.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    held = found.filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted = toxic").count() / held.count() > 0.9
    assert held.filter("toxic = 0 AND predicted = 1").count() <= 3


def test_odd_rows(make, tables):
    docs, labels = tables
    odd = make("doc_id long, text string, lang string, bits int, score int", (None, "the of and", None, 0, 0), (1, None, "en", 0, 0), (2, "", "xx", 0, 0), (2, "", "xx", 0, 0))
    some = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang")).withColumn("bits", F.lit(1)).withColumn("score", F.lit(1))
    marks = labels.unionByName(make("doc_id long, quality int, toxic int", (None, 1, 1), (5, None, None)))
    judged = quality.classify(some, marks)
    assert judged.count() == some.count() and judged.filter("perplexity IS NULL AND kept").count() == 0
    assert judged.filter("doc_id = 2 AND n_bytes = 0 AND perplexity IS NULL").count() == 2
    scored = toxicity.scores(some, marks)
    assert scored.count() == some.count() and scored.filter("score IS NULL OR predicted IS NULL OR held_out IS NULL").count() == 0


def test_without_labels_or_rows(tables):
    docs, labels = tables
    none = labels.limit(0)
    assert quality.classify(docs, none).filter("kept").count() > 0.9 * docs.count()
    assert toxicity.scores(docs, none).filter("predicted = 1").count() == 0
    assert quality.classify(docs.limit(0), labels).collect() == [] and toxicity.scores(docs.limit(0), labels).collect() == []


def runs_by_hand(text, order):
    history, before, out = b" " * order, None, []
    for word in (text or "").split():
        here = history
        for byte in (b"\x01" if word == before else word.encode()) + b" ":
            here += bytes([byte])
            out.append(here[-order:])
        history, before = history if word == before else here, word
    return out


def test_runs_go_on_over_blanks():
    texts = ["the cat  sat\nsat sat on", None, "", " ", "é", "the the cat"]
    for order in (2, 6, 8):
        runs = ngram.runs_of(pa.array(texts), lower=False, mark_repeats=True, order=order)
        assert runs.rows == len(texts)
        assert sorted((r, int(g).to_bytes(order, "big")) for r, g in zip(runs.row, runs.grams)) == sorted(
            (r, g) for r, text in enumerate(texts) for g in runs_by_hand(text, order))


def test_repeats_stay_unlikely(tables):
    """One word of a trusted text again and again is hardly ever kept, whatever repeats came before."""
    docs, labels = tables
    again = docs.join(labels.filter("quality = 1"), "doc_id").limit(20).select(
        (F.col("doc_id") + 10_000_000).alias("doc_id"), "lang", F.expr("repeat(concat(split(trim(text), ' ')[0], ' '), 80)").alias("text"))
    found = quality.classify(docs.select("doc_id", "lang", "text").unionByName(again), labels).filter("doc_id >= 10000000")
    assert found.count() == 20 and found.filter("kept").count() <= 2


def test_quality_by_hand(spark, make, monkeypatch):
    """Perplexity of every text against the definition, over blanks."""
    texts = [t for t in TEXTS if t] + ["mat the on sat cat the", "zzz the"]
    docs = make("doc_id int, lang string, text string", *[(k, "en", t) for k, t in enumerate(texts)])
    labels = make("doc_id int, quality int", *[(k, 1) for k in range(len(texts) - 2)])
    model = ngram.ORDER
    trained = {r.doc_id for r in docs.filter(~quality.held_out(F.col("doc_id"))).collect()} - {len(texts) - 2, len(texts) - 1}
    monkeypatch.setattr(f"{__name__}.events", lambda some: (g for t in some for g in runs_by_hand(t, quality.ORDER)))
    monkeypatch.setattr(ngram, "ORDER", quality.ORDER)
    p = model_by_hand([texts[k] for k in sorted(trained)])
    monkeypatch.setattr(ngram, "ORDER", model)
    for row in quality.classify(docs, labels).collect():
        grams = runs_by_hand(texts[row.doc_id], quality.ORDER)
        bits = sum(-math.log2(p(g, quality.ORDER)) for g in grams) / len(grams)
        assert math.isclose(row.perplexity, 2 ** bits, rel_tol=1e-3) and row.n_bytes == len(grams)


def test_a_full_batch_takes_little_memory(tables, monkeypatch):
    """What a task runs over a batch of the largest size holds the events of a small piece of it at a time."""
    docs, labels = tables
    runs, kind = [], type(docs)
    given = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, *rest: runs.append((run, self.columns)) or given(self, run, *rest))
    quality.classify(docs, labels)
    quality.keep_good(docs.select("doc_id", "lang", "text"), labels)
    texts = [r.text for r in docs.select("text").filter("text IS NOT NULL").limit(1000).collect()]
    texts = (texts * (1 + (8 << 20) // sum(len(t.encode()) for t in texts)))[:20_000]
    columns = {"text": pa.array(texts), "lang": pa.array(["en"] * len(texts)), "class": pa.array(np.zeros(len(texts), np.int32))}
    numbers = pa.array(range(len(texts)))
    assert len(runs) == 6  # each counts, scores and judges
    for run, names in runs:
        batch = pa.RecordBatch.from_arrays([columns.get(name, numbers) for name in names], names=names)
        tracemalloc.start()
        rows = sum(part.num_rows for part in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / 2**20
        tracemalloc.stop()
        assert rows > 0 and peak < 120, f"{peak:.0f} MB"


def test_sums_of_counts():
    random = np.random.default_rng(3)
    for size in (0, 1, 5000):
        grams, counts = random.integers(0, 700, size).astype(np.uint64), random.integers(1, 2**54, size)
        found, sums = ngram._summed(grams, counts)
        wanted = Counter()
        for gram, n in zip(grams.tolist(), counts.tolist()):
            wanted[gram] += n
        assert list(zip(found.tolist(), sums.tolist())) == sorted(wanted.items())


def test_the_order_of_words_counts(make):
    """Words of trusted texts in another order surprise more."""
    said = "alder birch cedar dogwood elder fir ginkgo hazel iris juniper".split()
    docs = [(k, "en", " ".join(said)) for k in range(60)] + [(k, "en", " ".join(said[::-1])) for k in (60, 61)]
    found = {r.doc_id: r.perplexity for r in quality.classify(
        make("doc_id int, lang string, text string", *docs), make("doc_id int, quality int", *[(k, 1) for k in range(60)])).collect()}
    assert min(found[60], found[61]) > 1.5 * max(found[k] for k in range(60))


def test_other_texts_are_dropped_before_the_join(spark, make, monkeypatch):
    docs = spark.range(4000).select("id", F.lit("en").alias("lang"), F.format_string("text %d", "id").alias("text"))
    docs = docs.unionByName(docs.filter("id = 35")).unionByName(make("id long, lang string, text string", (None, "en", "no id")))
    marks = make("id long, quality int", *[(i, 1) for i in range(0, 4000, 5)], (10, 0), (1, 0), (None, 1), (9999, 1))
    met, likely = [], quality.likely
    monkeypatch.setattr(quality, "likely", lambda rows, ids: met.append(likely(rows, ids)) or met[-1])
    trained, count = [], ngram.count_grams
    monkeypatch.setattr(ngram, "count_grams", lambda rows, **kind: trained.append(rows) or count(rows, **kind))
    quality.fit(docs, marks)
    wanted = docs.filter(~quality.held_out(F.col("id")) & (F.col("id") % 5 == 0) & (F.col("id") != 10))
    assert got(trained[0].select("text")) == got(wanted.select("text"))
    assert wanted.count() <= met[0].count() < 1.1 * wanted.count()


@pytest.mark.parametrize("kind", ["int", "string", "decimal(9,2)", "date", "double", "boolean"])
def test_likely_rows_lose_none(spark, kind, monkeypatch):
    monkeypatch.setattr(text, "MOST_WORDS", 3)  # too few: rows pass, none is lost
    value = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    rows = spark.range(300).select(value.alias("id"))
    ids = rows.sample(0.2, 1).unionByName(rows.limit(1))
    for some in (ids, ids.limit(0), ids.select(F.col("id").cast("string").alias("id"))):
        assert text.likely(rows, some).join(some, "id", "left_semi").count() == rows.join(some, "id", "left_semi").count()
