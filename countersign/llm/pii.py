r"""Private data replaced by format-preserving pseudonyms, with Spark expressions only.

A value is found by its pattern, checked by the rules of its kind, written as symbols of given
ranges, and permuted by a keyed Feistel network: both halves take turns in shifting each other's
symbols, each within its range. The result has the same format and passes the same checks, equal
values get equal pseudonyms in all documents, and within a kind different values stay different.

| kind | checked | permuted |
|---|---|---|
| secret | quoted hex after token, key, secret or password | hex digits |
| email | address form | letters and digits before the ``@`` (letters beyond a-z become some letter) |
| iban | length of its country, remainder of 97 | account part; check digits follow |
| card | Luhn | all digits but the last, which follows |
| ip | octets up to 255 | four octets |
| ssn | areas, groups and serials in use | three numbers within their ranges |
| date | calendar, 1900 to 2099 | day within these 200 years (with slashes: day first where that is a date) |
| phone | 8 to 15 digits | digits after the country code |

Numbers that fail their check stay as they are.

Results in special cases: a NULL text stays NULL, with nothing found; the empty text stays empty;
an empty table gives no row; repeated rows are treated alike; all other columns are kept, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
EPOCH, DAY_RANGES = "1900-01-01", (17, 4297)  # 73,049 days: 1900-01-01 to 2099-12-31

#: Characters of an IBAN by country, all of the registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Each length for its countries, in groups of four with or without a space; other countries as far as it goes."""
    def account(n: int) -> str:
        full, rest = divmod(n - 4, 4)
        return r"(?: ?[A-Z0-9]{4}){%d}%s" % (full, r" ?[A-Z0-9]{%d}" % rest if rest else "")

    named = "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}{account(n)}" for n, codes in IBAN_LENGTHS.items())
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"\b(?:{named}|{other})\b"


# In this order: the first one that fits at a place is taken there.
PATTERNS = {
    "secret": r"(?i:\b(?:token|key|secret|password)\s?[=:]\s?\"[0-9a-f]{16,128}\")",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": _iban_pattern(),
    "card": r"(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4} (?:[0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{6} [0-9]{4,5})"
            r"|[0-9]{4}-(?:[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{6}-[0-9]{4,5}))(?!\w)",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "date": r"(?<![\w/.-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
            r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?:(?=T[0-9]{2})|(?!\w))",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}"
             r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?!\w)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def feistel(symbols: Column, ranges: Column, key: Column) -> Column:
    """Keyed permutation of an array of numbers, the i-th of them below the i-th range."""
    half = F.floor(F.size(symbols) / 2).cast("int")
    rest = F.size(symbols) - half

    def shifted(own: Column, limits: Column, other: Column, turn: Column) -> Column:
        seen = F.array_join(other.cast("array<string>"), ",")

        def one(symbol: Column, i: Column) -> Column:
            drawn = F.substr(F.sha2(F.concat_ws("|", key, turn, i, seen), 256), F.lit(1), F.lit(12))
            shift = F.conv(drawn, 16, 10).cast("bigint")
            return F.pmod(symbol + shift, F.get(limits, i))

        return F.transform(own, one)

    def turn(state: Column, n: Column) -> Column:
        left, right = state["left"], state["right"]
        return F.struct(
            F.when(n % 2 == 0, left).otherwise(shifted(left, state["lower"], right, n)).alias("left"),
            F.when(n % 2 == 1, right).otherwise(shifted(right, state["upper"], left, n)).alias("right"),
            state["lower"].alias("lower"), state["upper"].alias("upper"),
        )

    start = F.struct(
        F.slice(symbols, 1, half).alias("left"), F.slice(symbols, half + 1, rest).alias("right"),
        F.slice(ranges, 1, half).alias("lower"), F.slice(ranges, half + 1, rest).alias("upper"),
    )
    return F.aggregate(
        F.lit(list(range(ROUNDS))), start, turn, lambda s: F.concat(s["left"], s["right"])
    )


_MOVING = r"[\p{L}\p{N}]"


def _characters(text: Column) -> Column:
    return F.split(text, "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column, double_last: bool) -> Column:
    """Sum of the digits, every second one doubled, counted from the last."""
    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == (0 if double_last else 1), twice).otherwise(d)

    values = F.transform(_characters(F.reverse(digits)), weighed)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _remainder_97(text: Column) -> Column:
    def step(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.when(value > 9, rest * 100 + value).otherwise(rest * 10 + value) % 97

    return F.aggregate(_characters(text), F.lit(0), step)


def _numbers(text: Column, separator: str) -> Column:
    return F.split(text, separator).cast("array<bigint>")


def _reshaped(shape: Column, text: Column, dropped: str) -> Column:
    """The text's characters in the places of the shape's, which keeps those that match ``dropped``."""
    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(shape, F.lit(1), i), dropped, ""))
        return F.when(c.rlike(dropped), c).otherwise(F.substr(text, before + 1, F.lit(1)))

    return F.array_join(F.transform(_characters(shape), one), "")


def _unspaced(m: Column) -> Column:
    return F.regexp_replace(m, " ", "")


def _country_code(m: Column) -> Column:
    return F.regexp_extract(m, r"^\+[0-9]{1,3}[ .-]|^\+[0-9]{1,2}|^", 0)


#: Pattern and form; parts of one digit make all of a date's parts unpadded.
DATE_FORMS = tuple((f"^{pattern}$", form) for pattern, form in (
    ("[0-9]{4}-[0-9]{2}-[0-9]{2}", "yyyy-MM-dd"), ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "yyyy-M-d"),
    ("[0-9]{4}/[0-9]{2}/[0-9]{2}", "yyyy/MM/dd"), ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "yyyy/M/d"),
    (r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}", "dd.MM.yyyy"), (r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}", "d.M.yyyy"),
    ("[0-9]{2}/[0-9]{2}/[0-9]{4}", "dd/MM/yyyy"), ("[0-9]{2}/[0-9]{2}/[0-9]{4}", "MM/dd/yyyy"),
    ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "d/M/yyyy"), ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "M/d/yyyy"),
))


def _read_as(m: Column, pattern: str, form: str) -> Column:
    day = F.when(m.rlike(pattern), F.try_to_date(m, form))
    return F.when(F.year(day).between(1900, 2099), day)


def _day(m: Column) -> Column:
    return F.coalesce(*[_read_as(m, *form) for form in DATE_FORMS])


def _by_kind(kind: Column, cases: dict[str, Column], other: Column | None = None) -> Column:
    out = None
    for name, value in cases.items():
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out if other is None else out.otherwise(other)


def _kind(m: Column) -> Column:
    """The first kind whose pattern and check the match passes, else NULL."""
    plain, digits, ssn = _unspaced(m), _digits(m), _numbers(m, "-")
    checks = {
        "iban": _remainder_97(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))) == 1,
        "card": (_luhn(digits, False) % 10 == 0) & digits.rlike("[1-9]"),
        "ip": F.forall(_numbers(m, r"\."), lambda o: o < 256),
        "ssn": (ssn[0] > 0) & (ssn[0] < 900) & (ssn[0] != 666) & (ssn[1] > 0) & (ssn[2] > 0),
        "date": _day(m).isNotNull(),
        "phone": F.length(digits).between(8, 15),
    }
    found = None
    for name, pattern in PATTERNS.items():
        # The check is read only where the pattern fits.
        passed = F.when(m.rlike(f"^(?:{pattern})$"), checks.get(name, F.lit(True)))
        found = F.when(passed, name) if found is None else found.when(passed, name)
    return found


def _part(kind: Column, m: Column) -> Column:
    """What is permuted, of the kinds that are permuted by character."""
    digits = _digits(m)
    return _by_kind(kind, {
        "secret": F.lower(F.regexp_extract(m, '"(.*)"', 1)),
        "email": F.substring_index(m, "@", 1),
        "iban": F.substr(_unspaced(m), F.lit(5)),
        "card": F.left(digits, F.length(digits) - 1),
        "phone": F.substr(m, F.length(_country_code(m)) + 1),
    })


def _base(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)


def _symbols(kind: Column, m: Column, part: Column) -> Column:
    """``struct<symbols, ranges>`` of a match."""
    moving = F.filter(_characters(part), lambda c: c.rlike(_MOVING))
    own = F.transform(
        moving,
        lambda c: F.when(c.rlike("[0-9A-Za-z]"), F.ascii(c) - _base(c)).otherwise(F.ascii(c) % 26).cast("bigint"),
    )
    limits = F.transform(moving, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26).cast("bigint"))
    hexes = F.transform(_characters(part), lambda c: F.conv(c, 16, 10).cast("bigint"))
    ssn = _numbers(m, "-")
    area = F.when(ssn[0] > 666, ssn[0] - 2).otherwise(ssn[0] - 1)
    number = F.datediff(_day(m), F.lit(EPOCH).cast("date")).cast("bigint")
    longs = lambda *values: F.array(*[F.lit(v).cast("bigint") for v in values])
    symbols = _by_kind(kind, {
        "secret": hexes, "ip": _numbers(m, r"\."), "ssn": F.array(area, ssn[1] - 1, ssn[2] - 1),
        "date": F.array(F.floor(number / DAY_RANGES[1]), F.pmod(number, F.lit(DAY_RANGES[1]))),
    }, own)
    ranges = _by_kind(kind, {
        "secret": F.transform(hexes, lambda _: F.lit(16).cast("bigint")), "ip": longs(256, 256, 256, 256),
        "ssn": longs(898, 99, 9999), "date": longs(*DAY_RANGES),
    }, limits)
    return F.struct(symbols.alias("symbols"), ranges.alias("ranges"))


def _changed_part(kind: Column, part: Column, permuted: Column) -> Column:
    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(part, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        symbol = F.get(permuted, before)
        value = F.when(kind == "secret", F.lower(F.hex(symbol))).otherwise(F.char(symbol + _base(c)))
        return F.when(c.rlike(_MOVING), value).otherwise(c)

    return F.array_join(F.transform(_characters(part), one), "")


def _whole(kind: Column, m: Column, changed: Column, p: Column) -> Column:
    """The match in its format again, with the changed part or numbers; check digits follow."""
    quoted, plain = F.regexp_extract(m, '"(.*)"', 1), _unspaced(m)
    secret = F.when(quoted == F.upper(quoted), F.upper(changed)).otherwise(changed)
    country = F.left(plain, F.lit(2))
    iban_check = F.lpad((98 - _remainder_97(F.concat(changed, country, F.lit("00")))).cast("string"), 2, "0")
    card_check = ((10 - _luhn(changed, True) % 10) % 10).cast("string")
    padded = lambda value, n: F.lpad(value.cast("string"), n, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), (p[0] * DAY_RANGES[1] + p[1]).cast("int"))
    dates = [
        F.when(_read_as(m, pattern, form).isNotNull(), F.date_format(day, form)) for pattern, form in DATE_FORMS
    ]
    area = F.when(p[0] > 664, p[0] + 2).otherwise(p[0] + 1)
    return _by_kind(kind, {
        "secret": F.concat(F.regexp_extract(m, '^[^"]*', 0), F.lit('"'), secret, F.lit('"')),
        "email": F.concat(changed, F.substr(m, F.length(F.substring_index(m, "@", 1)) + 1)),
        "iban": _reshaped(m, F.concat(country, iban_check, changed), " "),
        "card": _reshaped(m, F.concat(changed, card_check), "[^0-9]"),
        "ip": F.array_join(p.cast("array<string>"), "."),
        "ssn": F.concat_ws("-", padded(area, 3), padded(p[1] + 1, 2), padded(p[2] + 1, 4)),
        "date": F.coalesce(*dates),
        "phone": F.concat(_country_code(m), changed),
    }, m)


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", kinds_column: str = "private_kinds") -> DataFrame:
    """``docs`` with private values in the text replaced; ``kinds_column`` is added and lists their kinds in order.

    The key is a secret of the caller: whoever has it can undo the permutations.
    """
    if kinds_column.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {kinds_column} already; name another one")
    text = docs[f"`{text_column}`"].cast("string")
    searched = F.when(text.rlike("[0-9@]"), text)  # all kinds have a digit or the sign
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text.alias("whole"),
        F.split(searched, ANY, -1).alias("gaps"), F.regexp_extract_all(searched, F.lit(ANY), F.lit(0)).alias("found"),
    )
    # One step a select: each works on the array that the one before has made.
    rows = rows.withColumn(
        "found", F.transform("found", lambda m: F.struct(m.alias("m"), _kind(m).alias("kind")))
    ).withColumn(
        "found", F.transform("found", lambda t: F.struct(t["m"].alias("m"), t["kind"].alias("kind"), _part(t["kind"], t["m"]).alias("part")))
    ).withColumn(
        "found", F.transform("found", lambda t: F.struct(
            t["m"].alias("m"), t["kind"].alias("kind"), t["part"].alias("part"),
            F.when(t["kind"].isNotNull(), _symbols(t["kind"], t["m"], t["part"])).alias("numbers"),
        ))
    ).withColumn(
        "found", F.transform("found", lambda t: F.struct(
            t["m"].alias("m"), t["kind"].alias("kind"), t["part"].alias("part"),
            F.when(t["kind"].isNotNull(), feistel(
                t["numbers"]["symbols"], t["numbers"]["ranges"], F.concat_ws("|", F.lit(key), t["kind"])
            )).alias("permuted"),
        ))
    ).withColumn(
        "found", F.transform("found", lambda t: F.struct(
            t["m"].alias("m"), t["kind"].alias("kind"), t["permuted"].alias("permuted"),
            _changed_part(t["kind"], t["part"], t["permuted"]).alias("changed"),
        ))
    ).withColumn(
        "found", F.transform("found", lambda t: F.struct(
            t["kind"].alias("kind"), _whole(t["kind"], t["m"], t["changed"], t["permuted"]).alias("text"),
        ))
    )
    pieces = F.zip_with("gaps", "found", lambda g, t: F.concat(g, F.coalesce(t["text"], F.lit(""))))
    kinds = F.filter(F.transform("found", lambda t: t["kind"]), lambda k: k.isNotNull())
    new_text = F.coalesce(F.array_join(pieces, ""), F.col("whole"))
    kept = [(new_text if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return rows.select(*kept, F.coalesce(kinds, F.array().cast("array<string>")).alias(kinds_column))
