import datetime
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pseudonyms


def replaced(make, *texts):
    rows = make("doc_id int, text string, n string", *[(i, t, "x") for i, t in enumerate(texts)])
    found = pseudonyms.pseudonymize(rows, "key", count="n").orderBy("doc_id").collect()
    return [(r.text, r.n) for r in found]


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


CARD, IBAN = "4111 1111 1111 1111", "DE89370400440532013000"


def test_values_keep_their_format_and_stay_valid(make):
    (text, n), = replaced(make, f"card {CARD}, mail Ann.B-7@Mail.example.com, tel +1 (988) 555-2485; ip 42.144.35.254 on 2024-02-29 iban {IBAN} ssn 123-45-6789.")
    assert n == 7
    card, mail, tel, ip, day, iban, ssn = re.fullmatch(
        r"card ([\d ]+), mail (\S+), tel (.+); ip (\S+) on (\S+) iban (\w+) ssn (\S+)\.", text).groups()
    assert luhn(card.replace(" ", "")) and re.fullmatch(r"4\d{3}( \d{4}){3}", card) and card != CARD
    assert re.fullmatch(r"[a-z]{3}\.[a-z]-\d@Mail\.example\.com", mail)
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", tel) and tel != "+1 (988) 555-2485"
    assert all(int(x) < 256 for x in ip.split(".")) and ip != "42.144.35.254"
    assert 1800 <= datetime.date.fromisoformat(day).year < 2200
    moved = iban[4:] + iban[:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 and iban[:2] == "DE" and iban[4:].isdigit() and iban != IBAN
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn) and ssn[:3] not in ("000", "666") and ssn[0] != "9"


def test_what_is_not_valid_stays(make):
    texts = ["4111111111111112 is no card", "999.1.2.3", "2023-02-29", "1.2.3.4.5", "DE00370400440532013000", "000-12-3456", "+1 (188) 555-2485",
             "version 2.0, CC BY-NC 4.0.", "a@b", "x1234-56-7890", "", "@", "12"]
    assert replaced(make, *texts) == [(t, 0) for t in texts]


def test_equal_values_stay_linked_in_every_writing(make):
    found = replaced(make, "4111111111111111", f"x {CARD} y", "4111-1111-1111-1111", "(212) 555-0123", "+1 212-555-0123", "2024-03-05", "05.03.2024", "A.b@c.org", "a.b@c.org")
    digits = [re.sub(r"\D", "", t)[-16:] for t, _ in found]
    assert digits[0] == digits[1] == digits[2] and digits[3] == digits[4][-10:]
    assert datetime.datetime.strptime(found[6][0], "%d.%m.%Y").date().isoformat() == found[5][0]
    assert found[7][0] == found[8][0]
    assert all(n == 1 for _, n in found)


def test_the_network_is_a_permutation(spark):
    pairs = spark.range(27 * 11).select(F.col("id") % 27, F.floor(F.col("id") / 27)).toDF("a", "b")
    moved = pairs.select(pseudonyms.feistel(F.col("a"), F.col("b"), F.lit(27).cast("long"), F.lit(11).cast("long"), "k", F.lit("t")).alias("m"))
    found = {(r.m.a, r.m.b) for r in moved.collect()}
    assert found == {(a, b) for a in range(27) for b in range(11)}
    cards = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert cards.select(pseudonyms._permuted(F.col("d"), 10, "k", F.lit("t"))).distinct().count() == 1000


def test_rows_and_columns_stay(make):
    rows = make("doc_id long, text string, old string", (None, None, "a"), (1, "1.2.3.4", "b"), (1, "1.2.3.4", "b"))
    found = pseudonyms.pseudonymize(rows, "key")
    assert found.columns == rows.columns and found.count() == 3 and found.filter("text is null").count() == 1
    assert pseudonyms.pseudonymize(rows.limit(0), "key").collect() == []
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        pseudonyms.pseudonymize(rows, "")


def test_very_long_text(make):
    (text, n), = replaced(make, "a" * 200_000 + " 8.8.4.4 " + "1" * 50_000)
    assert n == 1 and len(text) > 250_000
