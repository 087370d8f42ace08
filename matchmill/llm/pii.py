"""Pseudonyms for personal data by Feistel networks that keep each value's format.

Numbers and dates that pass their format's check are permuted, under a key, within that format: a
card number becomes another that passes the Luhn check, an address another address, a date another
date. A permutation gives equal values equal pseudonyms in all documents and different values
different ones, without any table of what has been seen.

All of it is Spark SQL over one row: a pattern finds the values, an array of them is mapped step by
step, and the text is put together again from the pieces between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rounds of each network.
ROUNDS = 8

# The formats, in the order in which a place in a text is tried. No quantifier that
# runs over like characters gives back what it took, so a long run of them costs one pass.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
WORDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{32}|[0-9A-F]{32}|[0-9a-f]{64}|[0-9A-F]{64})(?![0-9A-Za-z])",
}
NUMBERS = {
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    r"|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z(+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|-[0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}+(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]|-[0-9])",
}
KINDS = (*WORDS, *NUMBERS)
_ANY = "|".join([*WORDS.values(), f"(?=[0-9+(])(?:{'|'.join(NUMBERS.values())})"])

#: The Gregorian calendar repeats after 189 * 773 days; dates stay within the 400 years from 1800.
_YEARS_400 = (189, 773)
_FIRST_DAY = "DATE'1800-01-01'"


def _text(value: str) -> str:
    """A SQL literal of any string."""
    return f"CAST(X'{value.encode().hex()}' AS STRING)"


def _noise(key: str, *parts: str) -> str:
    """A number below 2**60 that depends on the key and the parts."""
    joined = ", ".join([_text(key), *[f"'\x1f', CAST({p} AS STRING)" for p in parts]])
    return f"CAST(conv(substr(sha2(concat({joined}), 256), 1, 15), 16, 10) AS BIGINT)"


def _network(start: str, left: str, right: str) -> str:
    """Rounds over a struct (left, right), each half in turn changed by the other; ``left`` and ``right`` are SQL over acc and step."""
    return f"""aggregate(sequence(0, {ROUNDS - 1}), {start}, (acc, step) -> IF(step % 2 = 0,
        named_struct('left', {left}, 'right', acc.right), named_struct('left', acc.left, 'right', {right})))"""


def _luhn(digits: str) -> str:
    """The Luhn sum modulo 10; a number is valid at 0."""
    digit = f"CAST(substr({digits}, -i, 1) AS INT)"
    return f"aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum + IF(i % 2 = 1, {digit}, {digit} * 2 - IF({digit} > 4, 9, 0))) % 10"


def _refilled(value: str, digits: str) -> str:
    """The value with its digits replaced, one after the other; all else stays in its place."""
    step = f"""IF(c BETWEEN '0' AND '9', named_struct('done', concat(acc.done, substr({digits}, acc.place, 1)), 'place', acc.place + 1),
        named_struct('done', concat(acc.done, c), 'place', acc.place))"""
    return f"aggregate(split({value}, ''), named_struct('done', '', 'place', 1), (acc, c) -> {step}, acc -> acc.done)"


def _power(n: str) -> str:
    return f"CAST(pow(10, {n}) AS BIGINT)"


def _halves(left: str, right: str, sizes: tuple[str, str], valid: str = "true") -> str:
    """Two numbers below two sizes, or null for a value that fails its check."""
    return f"""IF({valid}, named_struct('left', CAST({left} AS BIGINT), 'right', CAST({right} AS BIGINT),
        'lefts', CAST({sizes[0]} AS BIGINT), 'rights', CAST({sizes[1]} AS BIGINT)), NULL)"""


def _digit_halves(digits: str, valid: str) -> str:
    front = f"(length({digits}) DIV 2)"
    back = f"(length({digits}) - {front})"
    numbers = f"substr({digits}, 1, CAST({front} AS INT))", f"substr({digits}, CAST({front} AS INT) + 1)"
    return _halves(*numbers, (_power(front), _power(back)), valid)


#: v.value's date format; where a slash parts them the day comes first, unless only the other order is a date.
_FORMAT = """CASE WHEN substr(v.value, 5, 1) = '-' THEN 'yyyy-MM-dd' WHEN substr(v.value, 5, 1) = '/' THEN 'yyyy/MM/dd'
    WHEN substr(v.value, 3, 1) = '.' THEN 'dd.MM.yyyy'
    WHEN try_to_timestamp(v.value, 'dd/MM/yyyy') IS NOT NULL THEN 'dd/MM/yyyy' ELSE 'MM/dd/yyyy' END"""
#: A phone's country code, which stays.
_CODE = r"regexp_extract(v.value, r'^([+][0-9]{1,3}[ .-]?(?=[(0-9]))', 1)"


def _steps(key: str) -> list[str]:
    """SQL that maps the array ``values`` of (kind, value), one step after the other, to one with a pseudonym."""
    patterns = {**WORDS, **NUMBERS}
    kind = " ".join(f"WHEN v RLIKE {_text(f'^(?:{p})$')} THEN '{k}'" for k, p in patterns.items())
    body = "CASE v.kind WHEN 'card' THEN substr(v.digits, 1, length(v.digits) - 1) ELSE v.digits END"
    area, group, serial = (f"CAST(substr(v.value, {a}, {n}) AS BIGINT)" for a, n in ((1, 3), (5, 2), (8, 4)))
    octet = [f"CAST(split(v.value, '[.]')[{i}] AS BIGINT)" for i in range(4)]
    days = f"datediff(CAST(try_to_timestamp(v.value, v.format) AS DATE), {_FIRST_DAY})"
    cycle = _YEARS_400
    halves = f"""CASE v.kind
        WHEN 'ip' THEN {_halves(f"{octet[0]} * 256 + {octet[1]}", f"{octet[2]} * 256 + {octet[3]}", ("65536", "65536"))}
        WHEN 'date' THEN {_halves(f"v.days DIV {cycle[1]}", f"v.days % {cycle[1]}", (str(cycle[0]), str(cycle[1])), f"v.days BETWEEN 0 AND {cycle[0] * cycle[1] - 1}")}
        WHEN 'ssn' THEN {_halves(f"{area} - IF({area} > 666, 2, 1)", f"({group} - 1) * 9999 + {serial} - 1", ("898", "99 * 9999"), f"{area} NOT IN (0, 666) AND {area} < 900 AND {group} > 0 AND {serial} > 0")}
        WHEN 'phone' THEN {_digit_halves("v.body", "length(v.body) BETWEEN 7 AND 15")}
        WHEN 'card' THEN {_digit_halves("v.body", f"{_luhn('v.digits')} = 0")} END"""
    numbers = _network(
        "named_struct('left', v.halves.left, 'right', v.halves.right)",
        f"pmod(acc.left + pmod({_noise(key, 'v.kind', 'step', 'acc.right')}, v.halves.lefts), v.halves.lefts)",
        f"pmod(acc.right + pmod({_noise(key, 'v.kind', 'step', 'acc.left')}, v.halves.rights), v.halves.rights)",
    )
    # An email's name and host, or a secret: characters of an alphabet are shifted by noise of the other half.
    alphabet = "IF(v.kind = 'secret', '0123456789abcdef', '0123456789abcdefghijklmnopqrstuvwxyz')"
    size = "IF(v.kind = 'secret', 16, 36)"

    def shifted(text: str, other: str) -> str:
        at = f"pmod(instr({alphabet}, c) - 1 + {_noise(key, 'v.kind', 'step', 'i', other)}, {size})"
        return f"array_join(transform(split({text}, ''), (c, i) -> IF(instr({alphabet}, c) > 0, substr({alphabet}, CAST({at} AS INT) + 1, 1), c)), '')"

    front = "CAST(length(v.letters) DIV 2 AS INT)"
    letters = _network(
        f"named_struct('left', substr(v.letters, 1, {front}), 'right', substr(v.letters, {front} + 1))",
        shifted("acc.left", "acc.right"),
        shifted("acc.right", "acc.left"),
    )
    joined = "concat(lpad(CAST(v.moved.left AS STRING), CAST(length(v.body) DIV 2 AS INT), '0'), lpad(CAST(v.moved.right AS STRING), length(v.body) - CAST(length(v.body) DIV 2 AS INT), '0'))"
    with_check = f"concat(v.body, CAST(pmod(10 - {_luhn("concat(v.body, '0')")}, 10) AS STRING))"
    pseudonym = f"""CASE v.kind
        WHEN 'ip' THEN concat_ws('.', v.moved.left DIV 256, v.moved.left % 256, v.moved.right DIV 256, v.moved.right % 256)
        WHEN 'date' THEN date_format(date_add({_FIRST_DAY}, CAST(v.moved.left * {cycle[1]} + v.moved.right AS INT)), v.format)
        WHEN 'ssn' THEN concat_ws('-', lpad(CAST(v.moved.left + IF(v.moved.left >= 665, 2, 1) AS STRING), 3, '0'),
            lpad(CAST(v.moved.right DIV 9999 + 1 AS STRING), 2, '0'), lpad(CAST(v.moved.right % 9999 + 1 AS STRING), 4, '0'))
        WHEN 'phone' THEN concat({_CODE}, {_refilled(f"substr(v.value, length({_CODE}) + 1)", "v.body")})
        WHEN 'card' THEN {_refilled("v.value", "v.body")} END"""
    keep = "'kind', v.kind, 'value', v.value"
    return [
        f"transform(values, v -> named_struct('kind', CASE {kind} END, 'value', v))",
        f"""transform(values, v -> named_struct({keep},
            'digits', CASE v.kind WHEN 'phone' THEN regexp_replace(substr(v.value, length({_CODE}) + 1), '[^0-9]', '') WHEN 'card' THEN regexp_replace(v.value, '[^0-9]', '') END,
            'format', CASE v.kind WHEN 'date' THEN {_FORMAT} END,
            'letters', lower(CASE v.kind WHEN 'secret' THEN v.value WHEN 'email' THEN regexp_extract(v.value, '^(.*)[.]', 1) END)))""",
        f"transform(values, v -> named_struct({keep}, 'digits', v.digits, 'body', {body}, 'format', v.format, 'letters', v.letters, 'days', IF(v.kind = 'date', {days}, NULL)))",
        f"transform(values, v -> named_struct({keep}, 'body', v.body, 'format', v.format, 'letters', v.letters, 'halves', {halves}))",
        f"""transform(values, v -> named_struct({keep}, 'body', v.body, 'format', v.format,
            'moved', IF(v.halves IS NULL, NULL, {numbers}), 'letters', IF(v.letters IS NULL, NULL, {letters})))""",
        f"""transform(values, v -> named_struct({keep}, 'moved', v.moved, 'format', v.format,
            'body', IF(v.kind IN ('phone', 'card') AND v.moved IS NOT NULL, {joined}, NULL), 'letters', concat(v.letters.left, v.letters.right)))""",
        f"transform(values, v -> named_struct({keep}, 'moved', v.moved, 'format', v.format, 'letters', v.letters, 'body', IF(v.kind = 'card', {with_check}, v.body)))",
        f"""transform(values, v -> named_struct({keep}, 'pseudonym', CASE
            WHEN v.kind = 'email' THEN concat(v.letters, '.', substring_index(v.value, '.', -1))
            WHEN v.kind = 'secret' THEN IF(v.value = lower(v.value), v.letters, upper(v.letters))
            WHEN v.moved IS NOT NULL THEN {pseudonym} END))""",
    ]


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, found, n_found of every row of ``docs``, by the secret ``key``.

    ``text`` has each value that is valid in its format replaced by its pseudonym, and is the
    original where none is found; ``found`` has (kind, value, pseudonym) of each in text order.
    Numbers that fail their check (a Luhn sum, a day that does not exist, a year out of 1800 to
    2199) stay as they are. Letters of an email come back in lower case; its last part stays. A
    null text stays null, with nothing found. Other columns are not read; repeated rows are repeated.
    """
    pattern = _text(f"({_ANY})")
    # Most texts have neither a digit nor an @ and are not searched.
    values = f"IF(text RLIKE '[0-9@]', regexp_extract_all(text, {pattern}, 1), CAST(array() AS ARRAY<STRING>))"
    found = docs.select("doc_id", "text").withColumn("values", F.expr(f"coalesce({values}, CAST(array() AS ARRAY<STRING>))"))
    for step in _steps(key):
        found = found.select("doc_id", "text", F.expr(step).alias("values"))
    pieces = f"zip_with(split(text, {_text(_ANY)}, -1), values, (a, v) -> concat(a, coalesce(v.pseudonym, v.value, '')))"
    return found.select(
        "doc_id",
        F.expr(f"IF(size(values) > 0, array_join({pieces}, ''), text)").alias("text"),
        F.expr("filter(values, v -> v.pseudonym IS NOT NULL)").alias("found"),
    ).withColumn("n_found", F.size("found").cast("long"))
