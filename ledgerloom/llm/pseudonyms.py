"""Pseudonyms for personal numbers, dates and addresses, of the same format.

A value that passes the checks of its kind (check digits, ranges, calendar) is replaced by
another that passes them too: its free part is a number in a range a * b, and a keyed
Feistel network permutes that range. Equal values get equal pseudonyms in all documents, however
they are written, and different values different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import once

ROUNDS = 8
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"
# 400 years of the calendar, 27 * 5411 days.
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 27, 5411

# Personal values as they stand in a text. Word characters, or digits joined by a point or hyphen, must not go on.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\w-]|\.[0-9])",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w(+])(?:\+1[ .-]?|1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What every text with such a value has.
HINT = r"@|[0-9]{2}|[0-9]\.[0-9]"

_POWERS = {base: [base**n for n in range(11)] for base in (10, 26)}


def feistel(a: Column, b: Column, mod_a: Column, mod_b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the pairs (a, b) below (mod_a, mod_b), as a struct of both."""
    def turn(state: Column, i: Column) -> Column:
        first = i % 2 == 1
        half = F.when(first, state["b"]).otherwise(state["a"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string")), 256)
        drawn = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(first, (state["a"] + drawn % mod_a) % mod_a).otherwise(state["a"]).alias("a"),
            F.when(first, state["b"]).otherwise((state["b"] + drawn % mod_b) % mod_b).alias("b"))

    begin = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, turn)


def _power(base: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p).cast("long") for p in _POWERS[base]]), n + 1)


def _permuted(run: Column, base: int, key: str, tweak: Column) -> Column:
    """A run of up to 20 digits, or lower-case letters (base 26), permuted among those of its length."""
    plain = F.translate(run, LETTERS, DIGITS) if base == 26 else run
    half = F.floor(F.length(run) / 2).cast("int")
    rest = F.length(run) - half

    def number(text: Column) -> Column:
        return F.coalesce(F.conv(F.when(text != "", text), base, 10).cast("long"), F.lit(0).cast("long"))

    def written(value: Column, size: Column) -> Column:
        text = F.lower(F.conv(value.cast("string"), 10, base))
        return F.when(size == 0, "").otherwise(F.lpad(text, size, "0"))

    moved = feistel(number(F.substring(plain, F.lit(1), half)), number(F.substring(plain, half + 1, rest)),
                    _power(base, half), _power(base, rest), key,
                    F.concat_ws("|", tweak, F.length(run).cast("string")))
    out = F.transform(F.array(moved), lambda m: F.concat(written(m["a"], half), written(m["b"], rest)))[0]
    return F.translate(out, DIGITS, LETTERS) if base == 26 else out


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(text: Column, digits: Column) -> Column:
    """The text with its last digits replaced by the given ones, in order."""
    skipped = F.length(_only_digits(text)) - F.length(digits)

    def one(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        place = F.length(_only_digits(F.substring(text, F.lit(1), i))) - skipped
        return F.when(c.rlike("[0-9]") & (place > 0), F.substring(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return (total + d - F.when(d > 9, 9).otherwise(0)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it on."""
    return F.transform(F.array(value), use)[0]


def _card(token: Column, key: str) -> Column:
    def renewed(digits: Column) -> Column:
        first, free = F.substring(digits, 1, 1), F.substring(digits, F.lit(2), F.length(digits) - 2)
        body = F.concat(first, _permuted(free, 10, key, F.concat(F.lit("card"), first)))
        return _let(body, lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))

    digits = _only_digits(token)
    return F.when(_luhn(digits) == 0, _refilled(token, renewed(digits)))


def _phone(token: Column, key: str) -> Column:
    digits = F.substring(_only_digits(token), -10, 10)
    area, exchange, line = (F.substring(digits, i, n).cast("long") for i, n in ((1, 3), (4, 3), (7, 4)))
    half = F.lit(80_000).cast("long")
    moved = feistel((area - 200) * 100 + F.floor((exchange - 200) / 8), (exchange - 200) % 8 * 10_000 + line,
                    half, half, key, F.lit("phone"))

    def written(m: Column) -> Column:
        area, exchange = F.floor(m["a"] / 100) + 200, m["a"] % 100 * 8 + F.floor(m["b"] / 10_000) + 200
        return F.concat(area.cast("string"), exchange.cast("string"), F.lpad((m["b"] % 10_000).cast("string"), 4, "0"))

    return F.when((area >= 200) & (exchange >= 200), _refilled(token, _let(moved, written)))


def _ssn(token: Column, key: str) -> Column:
    area, group, serial = (F.substring(token, i, n).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    moved = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9_999 + serial - 1,
                    F.lit(898).cast("long"), F.lit(99 * 9_999).cast("long"), key, F.lit("ssn"))

    def written(m: Column) -> Column:
        area = m["a"] + F.when(m["a"] >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"),
                           F.lpad((F.floor(m["b"] / 9_999) + 1).cast("string"), 2, "0"),
                           F.lpad((m["b"] % 9_999 + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(moved, written))


def _ip(token: Column, key: str) -> Column:
    parts = F.transform(F.split(token, r"\."), lambda p: p.cast("long"))
    half = F.lit(65_536).cast("long")
    moved = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], half, half, key, F.lit("ip"))
    return F.when(F.forall(parts, lambda p: p < 256), _let(moved, lambda m: F.concat_ws(
        ".", F.floor(m["a"] / 256).cast("string"), (m["a"] % 256).cast("string"),
        F.floor(m["b"] / 256).cast("string"), (m["b"] % 256).cast("string"))))


def _date_of(token: Column, key: str, form: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    index = F.datediff(F.to_date(F.try_to_timestamp(token, F.lit(form))), first).cast("long")
    moved = feistel(F.floor(index / DAYS_B), index % DAYS_B, F.lit(DAYS_A).cast("long"), F.lit(DAYS_B).cast("long"),
                    key, F.lit("date"))
    fresh = _let(moved, lambda m: F.date_format(F.date_add(first, (m["a"] * DAYS_B + m["b"]).cast("int")), form))
    return F.when((index >= 0) & (index < DAYS_A * DAYS_B), fresh)


def _date(token: Column, key: str) -> Column:
    forms = {r"^[0-9]{4}-": "yyyy-MM-dd", r"^[0-9]{4}/": "yyyy/MM/dd", r"^[0-9]{2}\.": "dd.MM.yyyy", r"^[0-9]{2}/": "MM/dd/yyyy"}
    return F.coalesce(*[F.when(token.rlike(p), _date_of(token, key, form)) for p, form in forms.items()])


def _remainder_97(text: Column) -> Column:
    """Of the number that capital letters (10 to 35) and digits spell."""
    def add(total: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return ((total * F.when(value > 9, 100).otherwise(10) + value) % 97).cast("int")

    return F.aggregate(F.split(text, "(?<=.)(?=.)"), F.lit(0), add)


def _runs(text: Column, letters: str, key: str, tweak: Column) -> Column:
    """Runs of letters (of a case) and of digits, each permuted among those of its length."""
    runs = F.regexp_extract_all(text, F.lit(f"([{letters}]{{1,20}}|[0-9]{{1,18}}|[^{letters}0-9])"), F.lit(1))

    def one(run: Column, i: Column) -> Column:
        own = F.concat_ws("|", tweak, i.cast("string"))
        low = _permuted(F.lower(run), 26, key, own)
        return F.when(run.rlike("^[0-9]"), _permuted(run, 10, key, own)).when(
            run.rlike(f"^[{letters}]"), F.upper(low) if letters == "A-Z" else low).otherwise(run)

    return F.array_join(F.transform(runs, one), "")


def _iban(token: Column, key: str) -> Column:
    country, free = F.substring(token, 1, 2), F.substring(token, F.lit(5), F.length(token) - 4)
    valid = _remainder_97(F.concat(free, F.substring(token, 1, 4))) == 1
    fresh = _runs(free, "A-Z", key, F.concat(F.lit("iban"), country))
    return F.when(valid, _let(fresh, lambda f: F.concat(country, F.lpad(
        (98 - _remainder_97(F.concat(f, country, F.lit("00")))).cast("string"), 2, "0"), f)))


def _email(token: Column, key: str) -> Column:
    name, domain = F.lower(F.substring_index(token, "@", 1)), F.substring_index(token, "@", -1)
    return F.concat(_runs(name, "a-z", key, F.concat(F.lit("email"), F.lower(domain))), F.lit("@"), domain)


KINDS = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(token: Column, key: str) -> Column:
    """What a value becomes; null if it is not a valid value of a kind."""
    tries = [F.when(token.rlike(f"^(?:{PATTERNS[kind]})$"), make(token, key)) for kind, make in KINDS.items()]
    return F.coalesce(*tries)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every valid email address, IBAN, date, IP address, social security, telephone and
    card number in the text replaced by its pseudonym under ``key``.

    Numbers that fail the checks of their kind stay as they are. All rows and columns stay, repeated
    rows and null ids included; a null text stays null. ``count`` names a further column with the
    number of values replaced (0 for a null text), which takes the place of one of that name.
    """
    if not key:
        raise ValueError("a key is needed")
    content = F.col(f"`{text}`")
    tokens = F.transform(F.regexp_extract_all(content, F.lit(f"({ANY})"), F.lit(1)),
                         lambda t: F.struct(t.alias("old"), pseudonym(t, key).alias("new")))
    # The pieces between the values; both lists come from the same matches.
    gaps = F.split(content, ANY, -1)
    found = docs.withColumn("pseudonyms/tokens", once(F.when(content.rlike(HINT) & content.rlike(ANY), tokens)))
    marked = F.col("`pseudonyms/tokens`")
    joined = F.array_join(F.zip_with(gaps, marked, lambda gap, t: F.concat(
        gap, F.coalesce(t["new"], t["old"], F.lit("")))), "")
    out = {text: F.when(marked.isNull(), content).otherwise(joined)}
    if count:
        out[count] = F.coalesce(F.size(F.filter(marked, lambda t: t["new"].isNotNull())), F.lit(0)).cast("long")
    return found.withColumns(out).drop("pseudonyms/tokens")
