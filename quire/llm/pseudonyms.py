"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only.

A value is found by pattern, validated (checksum, calendar, ranges), brought to a canonical string of digits and
letters, and permuted by a keyed Feistel network within its format: characters at even places and those at odd
places take turns to be shifted, within their own class, by a keyed hash of the others. That is a permutation of all
strings of the format, so equal values get equal pseudonyms in every document, and different ones differ. Separators,
lengths and check digits stay as the format wants them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Patterns by kind, in the order in which they are tried. None of them needs look-ahead over a long stretch.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?<![a-z0-9_])(?:password|passwd|secret|token|api_key)\x20?[=:]\x20?\"?[A-Za-z0-9+/_-]{8,}+)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "iso_date": r"(?<![0-9A-Za-z/.-])[0-9]{4}(?<isep>[-/.])(?:0[1-9]|1[0-2])\k<isep>(?:0[1-9]|[12][0-9]|3[01])(?![0-9A-Za-z]|[/.-][0-9])",
    "date": r"(?<![0-9A-Za-z/.-])[0-9]{1,2}(?<dsep>[-/.])[0-9]{1,2}\k<dsep>[0-9]{4}(?![0-9A-Za-z]|[/.-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[1-9][0-9]{12,18}|[1-9][0-9]{3}(?<csep>[\x20-])[0-9]{4}\k<csep>[0-9]{4}\k<csep>[0-9]{4}|3[47][0-9]{2}(?<xsep>[\x20-])[0-9]{6}\k<xsep>[0-9]{5})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[1-9][0-9]{0,2}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())
#: What every pattern holds at least; texts without it aren't searched further.
HINT = r"[0-9@]|AKIA|(?i:password|passwd|secret|token|api_key)"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _prf(key: str, tag: str, *parts: Column) -> Column:
    """A keyed pseudo-random number below 2**52."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), *parts), 256), 1, 13), 16, 10).cast("long")


def feistel(state: Column, key: str, tag: str, undo: bool = False) -> Column:
    """Permute an array of struct<x, m, base>, each x in 0..m-1: ROUNDS rounds, in each of which every second place is
    shifted modulo its m by a keyed hash of the places between. ``undo`` runs the rounds backwards."""
    sign = -1 if undo else 1
    rounds = F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if undo else range(ROUNDS))])

    def turn(s: Column, r: Column) -> Column:
        others = F.array_join(F.transform(F.filter(s, lambda y, j: j % 2 != r % 2), lambda y: y["x"].cast("string")), ",")
        sizes = F.array_join(F.transform(s, lambda y: y["m"].cast("string")), ",")
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), r.cast("string"), sizes, others), 256)
        return _let(seed, lambda h: F.transform(s, lambda y, j: F.struct(
            F.when(j % 2 == r % 2, F.pmod(y["x"] + sign * F.conv(F.substring(F.sha2(F.concat_ws("|", h, j.cast("string")), 256), 1, 13), 16, 10).cast("long"), y["m"])).otherwise(y["x"]).alias("x"),
            y["m"].alias("m"), y["base"].alias("base"))))

    return F.aggregate(rounds, state, turn)


def _cell(x: Column, m: Column | int, base: Column | int) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(x.cast("long").alias("x"), as_col(m).cast("long").alias("m"), as_col(base).cast("long").alias("base"))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _text_state(s: Column, hexadecimal: Column | None = None) -> Column:
    """A cell for each character: digits shift among digits, letters within their case."""
    letters = F.lit(26) if hexadecimal is None else F.when(hexadecimal, 6).otherwise(26)
    return F.transform(_chars(s), lambda c: F.when(c.rlike("[0-9]"), _cell(F.ascii(c) - 48, 10, 48)).when(c.rlike("[a-z]"), _cell(F.ascii(c) - 97, letters, 97)).when(c.rlike("[A-Z]"), _cell(F.ascii(c) - 65, letters, 65)).otherwise(_cell(F.lit(0), 1, F.ascii(c))))


def _text(state: Column) -> Column:
    return F.array_join(F.transform(state, lambda y: F.chr(y["x"] + y["base"])), "")


def _refill(shape: Column, new: Column, what: str) -> Column:
    """``shape`` with its characters of class ``what`` replaced, in order, by those of ``new``."""
    return F.array_join(F.transform(_chars(shape), lambda c, i: F.when(c.rlike(what), F.substr(new, F.length(F.regexp_replace(F.substr(shape, F.lit(1), i + 1), f"(?!{what}).", "")), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    n = F.length(digits)
    values = F.transform(_chars(digits), lambda c, i: F.when((n - 1 - i) % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _mod97(iban: Column) -> Column:
    """Remainder of an IBAN's number: letters count 10 to 35, the first four characters come last."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    return F.aggregate(_chars(turned), F.lit(0).cast("long"), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _permute_text(s: Column, key: str, tag: str, undo: bool, hexadecimal: Column | None = None) -> Column:
    return _text(feistel(_text_state(s, hexadecimal), key, tag, undo))


def _card(m: Column, key: str, undo: bool) -> Column:
    """First digit kept, check digit made anew; a number that fails the check stays."""
    def swap(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), _permute_text(F.substr(d, F.lit(2), F.length(d) - 2), key, "card", undo))
        new = _let(body, lambda b: F.concat(b, F.pmod(-_luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(_luhn(d) % 10 == 0, _let(new, lambda n: _refill(m, n, "[0-9]"))).otherwise(m)

    return _let(F.regexp_replace(m, "[^0-9]", ""), swap)


def _iban(m: Column, key: str, undo: bool) -> Column:
    """Country kept, check digits made anew."""
    def swap(s: Column) -> Column:
        body = _permute_text(F.substr(s, F.lit(5)), key, "iban", undo)
        country = F.substr(s, F.lit(1), F.lit(2))
        new = _let(body, lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))
        return F.when((_mod97(s) == 1) & F.length(s).between(15, 34), _let(new, lambda n: _refill(m, n, "[A-Z0-9]"))).otherwise(m)

    return _let(F.regexp_replace(m, " ", ""), swap)


def _ip(m: Column, key: str, undo: bool) -> Column:
    """Four cells; first numbers 1 to 223 change among themselves, the rest keep the first."""
    def state(o: Column) -> Column:
        first = F.get(o, 0)
        return F.concat(F.array(F.when(first.between(1, 223), _cell(first - 1, 223, 1)).otherwise(_cell(F.lit(0), 1, first))), F.transform(F.slice(o, 2, 3), lambda x: _cell(x, 256, 0)))

    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    return F.array_join(F.transform(feistel(_let(octets, state), key, "ip", undo), lambda y: (y["x"] + y["base"]).cast("string")), ".")


def _ssn(m: Column, key: str, undo: bool) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999: three cells."""
    area = F.substr(m, F.lit(1), F.lit(3)).cast("int")
    state = F.array(_cell(F.when(area > 666, area - 2).otherwise(area - 1), 898, 1), _cell(F.substr(m, F.lit(5), F.lit(2)).cast("int") - 1, 99, 1), _cell(F.substr(m, F.lit(8), F.lit(4)).cast("int") - 1, 9999, 1))
    pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
    return _let(feistel(state, key, "ssn", undo), lambda s: F.concat_ws("-", pad(F.when(F.get(s, 0)["x"] >= 665, F.get(s, 0)["x"] + 2).otherwise(F.get(s, 0)["x"] + 1), 3), pad(F.get(s, 1)["x"] + 1, 2), pad(F.get(s, 2)["x"] + 1, 4)))


def _day(d: Column, key: str, undo: bool) -> Column:
    """A date permuted within its century: 36,524 days are 92 x 397, and the 36,525 of one that starts with a leap year 75 x 487."""
    def swap(start: Column) -> Column:
        days = F.datediff(F.add_months(start, 1200), start)
        wide = F.when(days == 36525, 487).otherwise(397)
        at = F.datediff(d, start)
        state = F.array(_cell(F.floor(at / wide), F.when(days == 36525, 75).otherwise(92), 0), _cell(at % wide, wide, 0))
        return _let(feistel(state, key, "date", undo), lambda s: F.date_add(start, (F.get(s, 0)["x"] * wide + F.get(s, 1)["x"]).cast("int")))

    return _let(F.make_date((F.floor(F.year(d) / 100) * 100).cast("int"), F.lit(1), F.lit(1)), swap)


def _late_day(d: Column, key: str, undo: bool) -> Column:
    """A date from the 13th on, permuted among those of its century: its 1200 months have 12 early days each, so 22,124 are
    4 x 5531, and the 22,125 of a century that starts with a leap year 125 x 177."""
    def swap(start: Column) -> Column:
        long = F.datediff(F.add_months(start, 1200), start) == 36525
        before = lambda m: F.datediff(F.add_months(start, m.cast("int")), start) - 12 * m
        month = (F.year(d) - F.year(start)) * 12 + F.month(d) - 1
        at = before(month) + F.dayofmonth(d) - 13
        wide = F.when(long, 177).otherwise(5531)
        state = F.array(_cell(F.floor(at / wide), F.when(long, 125).otherwise(4), 0), _cell(at % wide, wide, 0))

        def back(n: Column) -> Column:
            guess = F.floor(n / 18.4375).cast("int")
            months = F.filter(F.sequence(F.greatest(guess - 3, F.lit(0)), F.least(guess + 3, F.lit(1199))), lambda m: before(m) <= n)
            return _let(F.array_max(months), lambda m: F.date_add(F.add_months(start, m), (n - before(m) + 12).cast("int")))

        return _let(feistel(state, key, "late", undo), lambda s: _let((F.get(s, 0)["x"] * wide + F.get(s, 1)["x"]).cast("int"), back))

    return _let(F.make_date((F.floor(F.year(d) / 100) * 100).cast("int"), F.lit(1), F.lit(1)), swap)


def _iso_date(m: Column, key: str, undo: bool) -> Column:
    sep = F.substr(m, F.lit(5), F.lit(1))
    d = F.try_to_date(F.regexp_replace(m, "[/.]", "-"), "yyyy-MM-dd")
    return F.when(d.isNull() | (F.year(d) < 100), m).otherwise(F.regexp_replace(F.date_format(_day(d, key, undo), "yyyy-MM-dd"), F.lit("-"), sep))


def _date(m: Column, key: str, undo: bool) -> Column:
    """Day, month, year; month first where the second number can't be a month, and those change among themselves, so that
    no two dates share a pseudonym. Padding as found."""
    def swap(p: Column) -> Column:
        a, b, y = (F.get(p, i).cast("int") for i in range(3))
        month_first = b > 12
        text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(F.when(month_first, a).otherwise(b).cast("string"), 2, "0"), F.lpad(F.when(month_first, b).otherwise(a).cast("string"), 2, "0"))
        sep = F.regexp_extract(m, "[-/.]", 0)
        short = m.rlike(r"(?:^|[-/.])[1-9][-/.]")
        show = lambda v: F.when(short, v.cast("string")).otherwise(F.lpad(v.cast("string"), 2, "0"))
        year = lambda n: F.lpad(F.year(n).cast("string"), 4, "0")

        def out(d: Column) -> Column:
            american = _let(_late_day(d, key, undo), lambda n: F.concat_ws("", show(F.month(n)), sep, show(F.dayofmonth(n)), sep, year(n)))
            other = _let(_day(d, key, undo), lambda n: F.concat_ws("", show(F.dayofmonth(n)), sep, show(F.month(n)), sep, year(n)))
            return F.when(month_first, american).otherwise(other)

        return _let(F.try_to_date(text, "yyyy-MM-dd"), lambda d: F.when(d.isNull() | (F.year(d) < 100), m).otherwise(out(d)))

    return _let(F.split(m, "[-/.]"), swap)


def _phone(m: Column, key: str, undo: bool) -> Column:
    """7 to 15 digits. A leading +1, or none before ten digits, is the same number; other country codes stay. Digits that
    can't start a number (0 and 1) stay among themselves there."""
    def swap(d: Column) -> Column:
        plus = m.startswith("+")
        code = F.when(plus & d.startswith("1") & (F.length(d) == 11), 1).when(plus, F.least(F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})(?=[^0-9])", 1)), F.length(d) - 4)).otherwise(0)
        number = F.substr(d, code + 1, F.length(d))
        lead = F.when(F.length(number) == 10, F.array(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(0)))
        state = F.transform(_chars(number), lambda c, i: F.when(F.array_contains(lead, i), F.when(c.cast("int") >= 2, _cell(c.cast("int") - 2, 8, 2)).otherwise(_cell(c.cast("int"), 2, 0))).otherwise(_cell(c.cast("int"), 10, 0)))
        new = F.concat(F.substr(d, F.lit(1), code), F.array_join(F.transform(feistel(state, key, "phone", undo), lambda y: (y["x"] + y["base"]).cast("string")), ""))
        return F.when(F.length(d).between(7, 15), _let(new, lambda n: _refill(m, n, "[0-9]"))).otherwise(m)

    return _let(F.regexp_replace(m, "[^0-9]", ""), swap)


def _email(m: Column, key: str, undo: bool) -> Column:
    at = F.instr(m, "@")
    return F.concat(_permute_text(F.substr(m, F.lit(1), at - 1), key, "email", undo), F.substr(m, at))


def _key(m: Column, key: str, undo: bool) -> Column:
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), _permute_text(F.substr(m, F.lit(5)), key, "key", undo))


def _secret(m: Column, key: str, undo: bool) -> Column:
    head = F.regexp_extract(m, r"^[A-Za-z_]+\x20?[=:]\x20?\"?", 0)
    value = F.substr(m, F.length(head) + 1)
    return F.concat(head, _permute_text(value, key, "secret", undo, value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")))


#: In the order of PATTERNS; a match is the first kind whose whole pattern it has.
KINDS = {"email": _email, "key": _key, "secret": _secret, "iban": _iban, "ip": _ip, "iso_date": _iso_date, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}
#: The shape of a match by which its kind is known again.
SHAPES = {
    "email": "@", "key": "^AKIA[A-Z0-9]{16}$", "secret": r"^(?i:password|passwd|secret|token|api_key)", "iban": "^[A-Z]{2}[0-9]{2}", "ip": r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$",
    "iso_date": r"^[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}$", "date": r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4}$", "ssn": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "card": r"^[1-9](?:[\x20-]?[0-9]){12,18}$",
}


def replace_all(text: Column, key: str, undo: bool = False) -> Column:
    """``text`` with every validated value replaced; the stretches between them stay as they are."""
    def one(m: Column) -> Column:
        out = F.when(m.rlike(SHAPES["email"]) & ~m.rlike(SHAPES["secret"]), _email(m, key, undo))
        for kind, shape in list(SHAPES.items())[1:]:
            out = out.when(m.rlike(shape), KINDS[kind](m, key, undo))
        return out.otherwise(_phone(m, key, undo))

    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), one)
    between = F.split(text, ANY, -1)
    return F.when(text.rlike(HINT) & text.rlike(ANY), F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all columns stay, whatever their names.

    E-mail addresses (the part before the @), access keys and assigned secrets, IBANs (mod 97), IPv4 addresses, dates
    that exist (permuted within their century), US social security numbers, payment cards (Luhn) and telephone numbers.
    Values that fail their check stay. Equal values get equal pseudonyms under one ``key`` wherever they stand and
    however they are separated, and different ones different pseudonyms; ``undo`` with the same key restores them, but for zeros
    before the day or month of an unpadded date whose pseudonym has two digits in both. Null and empty texts stay; a column n_chars isn't touched, as lengths don't change but where a
    number's are part of its format (IPv4, unpadded dates). An empty table gives an empty one. There is no shuffle.
    """
    return docs.withColumn(text, replace_all(F.col(f"`{text}`"), key, undo))
