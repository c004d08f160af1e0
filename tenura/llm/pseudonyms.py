"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

A value that looks like one of the known kinds is first validated (Luhn and mod-97 digits, ranges, calendar). Its free
characters are read as a number below the size of its format, the number is permuted by a Feistel
network under the key, walked until it is below that size again, and written back in the same
format. Equal values get equal pseudonyms in every document, and the key takes them back. Only where a card or account
number stands so near to other digits that its pseudonym would be read with them, it gets another, to be taken back.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
N_DAYS = (LAST_DAY - FIRST_DAY).days + 1


def feistel(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1, another for each kind; ``back`` undoes it."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def f(number: int, turn: int) -> int:
        told = f"{kind} {size} {turn} {number}".encode()
        return int.from_bytes(hashlib.blake2b(told, key=key, digest_size=min(64, half // 8 + 1)).digest(), "big") & mask

    while True:
        left, right = value >> half, value & mask
        if back:
            for turn in reversed(range(ROUNDS)):
                left, right = right ^ f(left, turn), left
        else:
            for turn in range(ROUNDS):
                left, right = right, left ^ f(right, turn)
        value = (left << half) | right
        if value < size:
            return value


def permute_characters(text: str, key: bytes, kind: str, back: bool = False, hexadecimal: bool = False) -> str:
    """Digits become digits, lower-case letters lower-case letters, upper-case upper-case; the rest stays.

    In a ``hexadecimal`` text the lower-case letters are a to f and may become digits.
    """
    classes = [DIGITS + "abcdef"] if hexadecimal else [DIGITS, LOWER, UPPER]
    of = [next((c for c in classes if x in c), "") for x in text]
    value, size = 0, 1
    for x, c in zip(text, of):
        if c:
            value, size = value * len(c) + c.index(x), size * len(c)
    value = feistel(value, size, key, kind, back)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if of[i]:
            value, at = divmod(value, len(of[i]))
            out[i] = of[i][at]
    return "".join(out)


def luhn_digit(digits: str) -> str:
    """The check digit that belongs behind ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _refill(text: str, characters: str) -> str:
    """``text`` with its letters and digits replaced in order."""
    fill = iter(characters)
    return "".join(next(fill) if c.isalnum() else c for c in text)


def card(text: str, key: bytes, back: bool = False) -> str | None:
    """Payment card numbers: first digit, length and a right check digit stay."""
    digits = "".join(c for c in text if c.isdigit())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = digits[0] + permute_characters(digits[1:-1], key, "card", back)
    return _refill(text, body + luhn_digit(body))


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban(text: str, key: bytes, back: bool = False) -> str | None:
    """Bank account numbers: the country, the classes of characters and a right check number stay."""
    plain = "".join(c for c in text if c.isalnum())
    country, account = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or _iban_check(country, account) != plain[2:4]:
        return None
    account = permute_characters(account, key, "iban", back)
    return _refill(text, country + _iban_check(country, account) + account)


def social_security(text: str, key: bytes, back: bool = False) -> str | None:
    """US social security numbers; area 000, 666 and 900 up, group 00 and serial 0000 are not given out."""
    area, group, serial = (int(x) for x in re.findall(r"\d+", text))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area -= 1 + (area > 666)
    value = feistel((area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn", back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    area += 1 + (area >= 665)
    return _refill(text, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """Telephone numbers. In the North American plan area and exchange begin with 2 to 9 and stay so; of others
    the country code stays."""
    digits = "".join(c for c in text if c.isdigit())
    national = digits[-10:]
    if len(digits) in (10, 11) and (len(digits) == 10 or digits[0] == "1"):
        area, exchange, line = int(national[:3]), int(national[3:6]), int(national[6:])
        if area >= 200 and exchange >= 200:
            value = ((area - 200) * 800 + exchange - 200) * 10_000 + line
            value, line = divmod(feistel(value, 800 * 800 * 10_000, key, "phone", back), 10_000)
            area, exchange = divmod(value, 800)
            return _refill(text, f"{digits[:-10]}{area + 200}{exchange + 200}{line:04d}")
        if not text.startswith("+"):
            return None
        while True:  # written as a number of the plan, though not one: permuted among those
            national = f"{feistel(int(national), 10**10, key, 'phone', back):010d}"
            if national[0] < "2" or national[3] < "2":
                return _refill(text, digits[:-10] + national)
    if not text.startswith("+") or not 8 <= len(digits) <= 15:
        return None
    return _refill(text, digits[:2] + permute_characters(digits[2:], key, "phone", back))


def address(text: str, key: bytes, back: bool = False) -> str | None:
    """IPv4 addresses; written without leading zeros, so their length may change."""
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def date(text: str, key: bytes, back: bool = False) -> str | None:
    """Dates from 1900 to 2099, year first or last; they stay such dates, in their order and with their separators.

    With the year last the day comes first, unless only the month can.
    """
    a, b, c = re.findall(r"\d+", text)
    year_first = len(a) == 4
    year, month, day = (int(a), int(b), int(c)) if year_first else (int(c), int(b), int(a))
    month_first = not year_first and month > 12
    if month_first:
        month, day = day, month
    try:
        when = datetime.date(year, month, day)
    except ValueError:
        return None
    if not FIRST_DAY <= when <= LAST_DAY:
        return None
    number = (when - FIRST_DAY).days
    if year_first:
        when = FIRST_DAY + datetime.timedelta(feistel(number, N_DAYS, key, "date", back))
        return _refill(text, f"{when.year:04d}{when.month:02d}{when.day:02d}")
    # a date whose day can be read as a month must not change how the others are read
    while True:
        number = feistel(number, N_DAYS, key, "date", back)
        when = FIRST_DAY + datetime.timedelta(number)
        if not month_first or when.day > 12:
            break
    first, second = (when.month, when.day) if month_first else (when.day, when.month)
    return _refill(text, f"{first:02d}{second:02d}{when.year:04d}")


def email(text: str, key: bytes, back: bool = False) -> str | None:
    """Mail addresses: what stands before the top-level domain is permuted within its classes of characters."""
    name, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{permute_characters(f'{name}@{host}', key, 'email', back)}.{top}"


def secret(text: str, key: bytes, back: bool = False) -> str | None:
    """Credentials: a known prefix stays."""
    head = "AKIA" if text.startswith("AKIA") else ""
    body = text[len(head):]
    hexadecimal = not head and re.fullmatch(r"[0-9a-f]+", body) is not None
    return head + permute_characters(body, key, "secret", back, hexadecimal)


#: In order of preference where matches overlap. Fixed patterns of the kinds' written forms.
KINDS: list[tuple[str, str, Callable]] = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", email),
    ("aws_key", r"\bAKIA[0-9A-Z]{16}\b", secret),
    ("credential", r"(?i:(?<=password=)|(?<=password: )|(?<=token = \")|(?<=token=)|(?<=secret=)|(?<=api_key=))[A-Za-z0-9_\-]{8,}", secret),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\d/-]|\.\d)", date),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", address),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social_security),
    ("card", r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])", card),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d(?:[ .-]?\d){7,14}(?!\d)", phone),
]


#: Written forms of card numbers, which are also looked for beside other digits: dates of expiry, check values, counts.
_BEFORE, _BEHIND = r"(?<![\d.])(?<![^\d]-)", r"(?!\d)(?!-(?!\d))"
CARDS = [re.compile(f"{_BEFORE}(?:{form}){_BEHIND}") for form in (
    r"\d{4}(?:[ -]\d{4}){3}", r"\d{13,19}", r"\d{4}[ -]\d{6}[ -]\d{4,5}", r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}",
    r"\d{4}(?:[ -]\d{3}){3}", r"\d{4}(?:[ -]\d{4}){2}[ -]\d")]
#: The countries of account numbers, by length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBANS = [re.compile(r"\b(?:" + "|".join(rf"(?:{ks.replace(' ', '|')})\d\d(?: ?[A-Z0-9]){{{n - 4}}}"
                                        for n, ks in IBAN_LENGTHS.items()) + r")\b")]


def _ends(kind: str, match: re.Match) -> list[int]:
    """Where a value that begins with ``match`` may end, the longest first."""
    shorter = [i for i in range(match.end() - 1, match.start() + 14, -1) if match.string[i] == " "] if kind == "iban" else []
    return [match.end(), *shorter]


def _forms() -> Iterator[tuple[str, re.Pattern, Callable]]:
    for kind, pattern, replace in KINDS:
        for form in (*{"card": CARDS, "iban": IBANS}.get(kind, ()), re.compile(pattern)):
            yield kind, form, replace


FORMS = list(_forms())


def find(text: str, kinds: tuple[str, ...] | None = None) -> Iterator[tuple[int, int, str, Callable]]:
    """The values of a text that may be personal: (first, end, kind, how to replace it), not overlapping.

    What fails its validation is tried with its shorter ends, then the search goes on behind its first character.
    """
    taken: list[tuple[int, int]] = []
    for kind, form, replace in FORMS:
        if kinds is not None and kind not in kinds:
            continue
        found, at = [], 0
        while m := form.search(text, at):
            a, at = m.start(), m.start() + 1
            for b in _ends(kind, m):
                i = bisect.bisect_left(taken, (b, 0))
                if (i == 0 or taken[i - 1][1] <= a) and replace(text[a:b], b"", False) is not None:
                    found.append((a, b))
                    yield a, b, kind, replace
                    at = b
                    break
        if found:
            taken = sorted(taken + found)


#: Kinds whose values may begin and end inside other digits, and how far around them that may matter.
INSIDE, AROUND = ("iban", "card"), 40


def _replaced(before: str, value: str, behind: str, kind: str, replace: Callable, key: bytes, back: bool) -> str:
    """The pseudonym of a value in its surroundings: the first in its cycle after which the same is found there."""
    new = replace(value, key, back)
    if kind not in INSIDE:
        return new

    def spans(x: str) -> list[tuple]:
        return sorted(f[:3] for f in find(before + x + behind, INSIDE))

    wanted = spans(value)
    while new != value and spans(new) != wanted:
        new = replace(new, key, back)
    return new


def pseudonymise_text(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its values replaced, and where they stood: (first, end, kind)."""
    spans = sorted((a, b, kind, replace) for a, b, kind, replace in find(text)) if re.search(r"[0-9@]|(?i:password|token|secret|api_key)", text) else []
    # a value is replaced in view of those before it as pseudonyms and of those behind it as they were
    pieces, at = [], 0
    for a, b, _, _ in spans:
        pieces += [text[at:a], text[a:b]]
        at = b
    pieces.append(text[at:])

    def near(parts: Iterable[str], last: bool) -> str:
        out = ""
        for part in parts:
            out = part[-AROUND:] + out if last else out + part[:AROUND]
            if len(out) >= AROUND:
                break
        return out[-AROUND:] if last else out[:AROUND]

    order = range(len(spans))
    for i in reversed(order) if back else order:
        j, (_, _, kind, replace) = 2 * i + 1, spans[i]
        before = near((pieces[k] for k in range(j - 1, -1, -1)), True) if kind in INSIDE else ""
        behind = near((pieces[k] for k in range(j + 1, len(pieces))), False) if kind in INSIDE else ""
        pieces[j] = _replaced(before, pieces[j], behind, kind, replace, key, back)
    return "".join(pieces), [(a, b, kind) for a, b, kind, _ in spans]


SPAN = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()),
                     T.StructField("kind", T.StringType())])


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``spans``: (first, end, kind) of each value in the old text.

    ``key`` has 16 to 64 bytes; ``back`` with the same key restores the values. Null texts stay null without spans, as
    do empty ones. A column ``spans`` is replaced, all others are kept.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    kept = [c for c in docs.columns if c != "spans"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept if c != text)).alias("row") if set(kept) - {text}
                       else F.lit(None).cast("string").alias("row"), F.col(f"`{text}`").alias("text"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(None, []) if t is None else pseudonymise_text(t, key, back) for t in batch.column("text").to_pylist()]
            texts, spans = zip(*made) if made else ((), ())
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
            spans = [[{"first": a, "end": b, "kind": k} for a, b, k in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, kind)],
                                             ["row", "text", "spans"])

    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()),
                           T.StructField("spans", T.ArrayType(SPAN))])
    out = rows.mapInArrow(replace, schema)
    return out.select(*(F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in kept), "spans")
