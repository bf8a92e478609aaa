"""Format-preserving pseudonyms for personal data.

Numbers and dates are recognised by their format, validated (checksums, ranges,
calendar), and replaced by a keyed permutation of all valid values of that format. A
permutation has no collisions, so equal values stay linked across documents and
different ones stay different. The permutation is a Feistel network on an integer
range, walked along its cycle until it falls into the range.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import lru_cache
from hashlib import blake2b
from ipaddress import IPv6Address
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import Fields, slices

ROUNDS = 8

# Dates outside these years are left alone; inside, they are permuted among all days.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGIT = "0123456789"

# Letters beyond ASCII stay as they are; A to Z and the accented ones of Latin-1 fold.
_TO_LOWER = {
    code: chr(code + 32) for code in (*range(0x41, 0x5B), *range(0xC0, 0xDF)) if code != 0xD7
}


class Permutation:
    """A keyed permutation of 0..size-1 for any size and tweak."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, half: int, size: int) -> int:
        data = half.to_bytes(max(1, (half.bit_length() + 7) // 8), "big")
        width = (size.bit_length() + 7) // 8 + 8
        found, block = b"", 0
        while len(found) < width:
            head = b"%s|%d|%d|" % (tweak, number, block)
            found += blake2b(head + data, key=self.key, digest_size=32).digest()
            block += 1
        return int.from_bytes(found[:width], "big") % size

    def _once(self, tweak: bytes, value: int, a: int, b: int, inverse: bool) -> int:
        left, right = divmod(value, b)  # left < a, right < b
        for number in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            sign = -1 if inverse else 1
            if number % 2:
                right = (right + sign * self._round(tweak, number, left, b)) % b
            else:
                left = (left + sign * self._round(tweak, number, right, a)) % a
        return left * b + right

    def __call__(self, tweak: str, value: int, size: int, inverse: bool = False) -> int:
        """The image of ``value``; at most a few steps of the cycle lie outside the range."""
        if size < 2:
            return value
        b = isqrt(size - 1) + 1
        a = -(-size // b)
        name = b"%s|%d" % (tweak.encode(), size)
        value = self._once(name, value, a, b, inverse)
        while value >= size:
            value = self._once(name, value, a, b, inverse)
        return value


def _mixed(text: str) -> tuple[int, list[str | None]]:
    """A text's letters and digits as one number, with the alphabet of every character."""
    value, alphabets = 0, []
    for ch in text:
        own = next((x for x in (LOWER, UPPER, DIGIT) if ch in x), None)
        alphabets.append(own)
        if own:
            value = value * len(own) + own.index(ch)
    return value, alphabets


def _unmixed(value: int, alphabets: list[str | None], text: str) -> str:
    out = []
    for ch, own in zip(reversed(text), reversed(alphabets)):
        if own:
            value, at = divmod(value, len(own))
            ch = own[at]
        out.append(ch)
    return "".join(reversed(out))


def _permuted_text(p: Permutation, kind: str, text: str, inverse: bool) -> str:
    """``text`` with its letters and digits permuted; their classes and all else stay.

    Letters are permuted in lower case and get their case back, so that two spellings
    of one address stay linked.
    """
    lower = text.translate(_TO_LOWER)
    value, alphabets = _mixed(lower)
    size = 1
    for own in alphabets:
        size *= len(own) if own else 1
    # The pattern of classes is the format: each has a permutation of its own.
    shape = "".join("a" if x == LOWER else "0" if x == DIGIT else c for x, c in zip(alphabets, lower))
    mapped = _unmixed(p(f"{kind}|{shape}", value, size, inverse), alphabets, lower)
    return "".join(m.upper() if c in UPPER else m for m, c in zip(mapped, text))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGIT)


def _redigit(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order; separators stay."""
    source = iter(digits)
    return "".join(next(source) if c in DIGIT else c for c in text)


def luhn_check(payload: str) -> int:
    """The digit that completes ``payload``."""
    total = 0
    for at, ch in enumerate(reversed(payload)):
        n = int(ch) * (2 - at % 2)
        total += n - 9 if n > 9 else n
    return -total % 10


def _card(p: Permutation, text: str, inverse: bool) -> str | None:
    digits = _digits(text)
    head, payload = digits[0], digits[1:-1]
    if luhn_check(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    size = 10 ** len(payload)
    moved = head + str(p(f"card|{head}", int(payload), size, inverse)).zfill(len(payload))
    return _redigit(text, moved + str(luhn_check(moved)))


def _ssn(p: Permutation, text: str, inverse: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    index, serial = divmod(p("ssn", index, 898 * 99 * 9999, inverse), 9999)
    area, group = divmod(index, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _north_american(digits: str) -> bool:
    return len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"


def _outside(p: Permutation, digits: str, inverse: bool) -> str:
    """Ten digits that are no North American number, permuted among all such."""
    while True:
        digits = str(p("phone|1|outside", int(digits), 10**10, inverse)).zfill(10)
        if not _north_american(digits):
            return digits


def _phone(p: Permutation, text: str, inverse: bool) -> str | None:
    digits = _digits(text)
    country, national = ("", digits)
    if text.startswith("+"):
        country, national = (digits[:1], digits[1:]) if digits[0] == "1" else (digits[:2], digits[2:])
    if country in ("", "1"):
        if not _north_american(national):
            # Without the country code such digits need not be a phone number.
            return _redigit(text, country + _outside(p, national, inverse)) if country else None
        area, exchange, line = int(national[:3]), int(national[3:6]), int(national[6:])
        index = ((area - 200) * 800 + exchange - 200) * 10_000 + line
        # One permutation with and without country code keeps the number linked.
        index, line = divmod(p("phone|1", index, 800 * 800 * 10_000, inverse), 10_000)
        area, exchange = divmod(index, 800)
        return _redigit(text, f"{country}{area + 200}{exchange + 200}{line:04d}")
    if not 6 <= len(national) <= 13:
        return None
    moved = p(f"phone|{country}", int(national), 10 ** len(national), inverse)
    return _redigit(text, country + str(moved).zfill(len(national)))


def _ip(p: Permutation, text: str, inverse: bool) -> str | None:
    parts = text.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, p("ip", value, 1 << 32, inverse).to_bytes(4, "big")))


def _ipv6(p: Permutation, text: str, inverse: bool) -> str | None:
    groups = [group for group in text.split(":") if group]
    # Two short words around a double colon may be names in a program.
    if len(groups) < 3 or not any(c in DIGIT for c in text):
        return None
    try:
        value = int(IPv6Address(text))
    except ValueError:
        return None
    moved = IPv6Address(p("ipv6", value, 1 << 128, inverse)).compressed
    return moved.upper() if text == text.upper() else moved


def _iban(p: Permutation, text: str, inverse: bool) -> str | None:
    plain = text.replace(" ", "")
    value = lambda s: int("".join(str(int(c, 36)) for c in s)) % 97
    if not 15 <= len(plain) <= 34 or value(plain[4:] + plain[:4]) != 1:
        return None
    body = _permuted_text(p, f"iban|{plain[:2]}", plain[4:], inverse)
    check = 98 - value(body + plain[:2] + "00")
    source = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(source) for c in text)


def _date(p: Permutation, text: str, inverse: bool) -> str | None:
    sep = next(c for c in text if c not in DIGIT)
    parts = text.split(sep)
    numbers = list(map(int, parts))
    day = None
    # Day before month where both readings are dates, except with the year in front.
    for order in ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
        try:
            day = date(*(numbers[i] for i in order))
            break
        except ValueError:
            pass
    if day is None or not FIRST_DAY <= day <= LAST_DAY:
        return None
    size = LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1
    moved = p("date", day.toordinal() - FIRST_DAY.toordinal(), size, inverse)
    new = date.fromordinal(FIRST_DAY.toordinal() + moved)
    out = [""] * 3
    for at, number in zip(order, (new.year, new.month, new.day)):
        out[at] = str(number).zfill(len(parts[at]))
    return sep.join(out)


def _email(p: Permutation, text: str, inverse: bool) -> str | None:
    local, _, domain = text.partition("@")
    host, _, top = domain.rpartition(".")
    if not host or not local.strip(".") or not 2 <= len(top) <= 24 or not top.isalpha():
        return None
    moved = _permuted_text(p, "email", f"{local}@{host}", inverse)
    return f"{moved}.{top}"


# Every repetition is bounded, so matching takes linear time on any text. Kinds are
# tried in this order at each place.
_NUMBERS = re.compile(
    r"(?<![0-9A-Za-z.])(?:"
    r"(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
    r"|(?P<ip>(?:[0-9]{1,3}\.){3}[0-9]{1,3})"
    r"|(?P<ipv6>(?<!:)(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4}|(?<=::))(?!:[0-9A-Fa-f:]))"
    r"|(?P<date>[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}"
    r"|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})"
    r"|(?P<card>[0-9]{13,19}|[0-9]{4}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}"
    r"|[0-9]{4}(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{5})"
    r"|(?P<phone>\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[2-9][0-9](?:[ .-]?\(?[0-9]{1,4}\)?){2,6}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
    r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})"
    # A date with the year in front may be followed by a time, a phone by an extension.
    r")(?:(?![0-9A-Za-z]|\.[0-9])|(?(s1)(?=[Tt][0-9]{2})|(?!))"
    r"|(?(phone)(?=[xX][0-9]{1,6}(?![0-9A-Za-z]))|(?!)))"
)
# Where a match of these kinds may end: before a separator.
_TOKEN_END = re.compile(r"(?<=[0-9A-Z)])(?=[ .-])")

_NUMBERS_INSIDE = re.compile(r"(?<![0-9A-Za-z.])[0-9]")

IBAN_LENGTHS = {
    country: int(length)
    for length, countries in {
        "15": "NO", "16": "BE", "18": "DK FI FO GL NL SD", "19": "MK SI",
        "20": "AT BA EE KZ LT LU MN XK", "21": "CH HR LI LV", "22": "BG BH CR DE GB GE IE ME RS VA",
        "23": "AE GI IL IQ OM SO TL", "24": "AD CZ DZ ES MD PK RO SA SE SK TN VG",
        "25": "LY PT ST", "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM",
        "28": "AL AZ BY CY DO GT HN HU LB NI PL SV", "29": "BR EG PS QA UA", "30": "JO KW MU YE",
        "31": "MT SC", "33": "RU",
    }.items()
    for country in countries.split()
}
_LOCAL = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F0-9._%+-]{1,64}\Z")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")

KINDS: dict[str, Callable[[Permutation, str, bool], str | None]] = {
    "iban": _iban,
    "ip": _ip,
    "ipv6": _ipv6,
    "date": _date,
    "ssn": _ssn,
    "card": _card,
    "phone": _phone,
    "email": _email,
}


@dataclass(frozen=True)
class Finding:
    kind: str
    start: int
    end: int
    replacement: str


class Pseudonymiser:
    """Finds and replaces personal data with one key."""

    def __init__(self, key: bytes):
        self.permutation = Permutation(key)
        self.moved = lru_cache(maxsize=1 << 14)(self._moved)

    def _moved(self, kind: str, text: str, inverse: bool) -> str | None:
        return KINDS[kind](self.permutation, text, inverse)

    def _number(self, text: str, start: int, inverse: bool) -> Finding | None:
        """The first number or date from ``start``.

        Where a match is not valid, shorter ones are tried and then later starts: it may
        have taken in the next word, or hide another number.
        """
        while match := _NUMBERS.search(text, start):
            start, end = match.span()
            kind = next(k for k in KINDS if k != "email" and match[k] is not None)
            new = self.moved(kind, match[kind], inverse)
            if new is not None:
                return Finding(kind, start, end, new)
            if kind in ("iban", "phone"):
                for end in self._ends(text, kind, start, end, inverse):
                    new = self.moved(kind, text[start:end], inverse)
                    if new is not None:
                        return Finding(kind, start, end, new)
            start += 1
        return None

    def _ends(self, text: str, kind: str, start: int, end: int, inverse: bool) -> list[int]:
        """The shorter ends to try for a match from ``start`` to ``end``, best first."""
        ends = [m.start() for m in _TOKEN_END.finditer(text, start, end)][::-1]
        if kind == "iban":
            length = IBAN_LENGTHS.get(text[start : start + 2])
            if length:
                return [e for e in ends if len(text[start:e].replace(" ", "")) == length]
            return ends
        # A phone number has no length of its own: what is another number is not part of it.
        following = self._inside(text, start, end, inverse)
        return [e for e in ends if following is None or e <= following]

    def _inside(self, text: str, start: int, end: int, inverse: bool) -> int | None:
        """Where the first valid number of another kind than a phone begins in a match."""
        for match in _NUMBERS_INSIDE.finditer(text, start + 1):
            if match.start() >= end:
                break
            number = _NUMBERS.match(text, match.start())
            if number and number["phone"] is None:
                kind = next(k for k in KINDS if k != "email" and number[k] is not None)
                if self.moved(kind, number[kind], inverse) is not None:
                    return match.start()
        return None

    def findings(self, text: str, inverse: bool = False) -> list[Finding]:
        """What would be replaced, in text order and without overlaps."""
        found = []
        at = text.find("@")
        while at >= 0:
            left = _LOCAL.search(text[max(0, at - 64) : at])
            right = _DOMAIN.match(text, at + 1)
            if left and right:
                start, end = at - len(left[0]), right.end()
                new = self.moved("email", text[start:end], inverse)
                if new is not None:
                    found.append(Finding("email", start, end, new))
            at = text.find("@", at + 1)
        emails = [(f.start, f.end) for f in found]
        one = self._number(text, 0, inverse)
        while one:
            found.append(one)
            one = self._number(text, one.end, inverse)
        if emails:
            found.sort(key=lambda f: (f.start, -f.end))
            kept: list[Finding] = []
            for one in found:
                if not kept or one.start >= kept[-1].end:
                    kept.append(one)
            return kept
        return found

    def replace(self, text: str, inverse: bool = False) -> tuple[str, list[Finding]]:
        found = self.findings(text, inverse)
        if not found:
            return text, found
        parts, last = [], 0
        for one in found:
            parts += [text[last : one.start], one.replacement]
            last = one.end
        return "".join((*parts, text[last:])), found


def pseudonymise(
    docs: DataFrame, key: bytes, fields: Fields = Fields(), findings: str | None = None
) -> DataFrame:
    """``docs`` with personal data in the text replaced; all columns and rows stay.

    A null text stays null. With ``findings`` a column of that name is added: an array
    of (kind, start, end) in the original text. No shuffle.
    """
    if findings in docs.columns:
        raise ValueError(f"there is a column {findings} already")
    place = docs.columns.index(fields.text)
    kinds = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    )

    def run(batches):
        change = Pseudonymiser(key)
        for batch in batches:
            for part in slices(batch, fields.text):
                texts, spans = [], []
                for text in part.column(fields.text).to_pylist():
                    new, found = change.replace(text) if text else (text, [])
                    texts.append(new)
                    spans.append([{"kind": f.kind, "start": f.start, "end": f.end} for f in found])
                columns, names = list(part.columns), list(part.schema.names)
                columns[place] = pa.array(texts, pa.string())
                if findings:
                    columns.append(pa.array(spans, kinds))
                    names.append(findings)
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = docs.schema
    if findings:
        schema = docs.withColumn(
            findings, F.lit(None).cast('array<struct<kind:string,start:int,end:int>>')
        ).schema
    return docs.mapInArrow(run, schema)
