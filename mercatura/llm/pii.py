"""Format-preserving pseudonyms for personal values, by a keyed Feistel network.

A value that passes its kind's check (Luhn, mod 97, calendar, number plan, byte ranges) is read
as a number of mixed radix, one digit for each place that may change, and permuted among all
numbers of that form. The two halves of the places take turns in adding a keyed hash of the other
half, which is a permutation whatever the radices. Stepping on by one between the network and its
inverse leaves no value as it was. What is written back has the same punctuation and passes the
same check. The same value gets the same pseudonym in every document, under one key.

Kinds: payment cards, IBANs, phone numbers, US social security and taxpayer numbers, IPv4 addresses, calendar
dates (permuted within 1900 to 2099, in numbers or with English names of months), the local parts of mail addresses,
and access keys and credentials (by character class; a credential has a digit, or a capital after a small
letter, as words have not).

Edge cases: a NULL text stays NULL, and an empty one empty; texts are taken whole; of overlapping
finds the first in the list of kinds wins; other columns pass through and columns with the names
of results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from calendar import monthrange
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date
from functools import lru_cache
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 10


class Feistel:
    """Keyed permutations of mixed-radix numbers, one for each kind and list of radices."""

    def __init__(self, key: bytes) -> None:
        if not 16 <= len(key) <= 64:
            raise ValueError("a key has 16 to 64 bytes")
        self._key = key

    def _hash(self, label: bytes, turn: int, half: int, size: int) -> int:
        raw = half.to_bytes(half.bit_length() // 8 + 1, "big")
        digest = hashlib.blake2b(label + bytes([turn]) + raw, key=self._key, digest_size=32).digest()
        return int.from_bytes(digest, "big") % size

    def _pass(self, label: bytes, value: int, left: int, right: int, back: bool) -> int:
        a, b = divmod(value, right)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                b = (b + sign * self._hash(label, turn, a, right)) % right
            else:
                a = (a + sign * self._hash(label, turn, b, left)) % left
        return a * right + b

    def _walk(self, label: bytes, value: int, left: int, right: int, size: int, back: bool) -> int:
        value = self._pass(label, value, left, right, back)
        while value >= size:
            value = self._pass(label, value, left, right, back)
        return value

    def permute(self, kind: str, digits: Sequence[int], radices: Sequence[int], step: int = 1) -> list[int]:
        """The pseudonym of ``digits``; ``step=-1`` undoes it."""
        half = len(radices) // 2
        left, right = prod(radices[:half]), prod(radices[half:])
        size = left * right
        if size < 2:
            return list(digits)
        if left == 1:
            # One place has no halves: the network runs on a few more numbers, and walks on from those beyond.
            left = isqrt(size - 1) + 1
            right = -(-size // left)
        label = f"{kind}:{','.join(map(str, radices))}:".encode()
        value = 0
        for digit, radix in zip(digits, radices, strict=True):
            value = value * radix + digit
        value = self._walk(label, value, left, right, size, False)
        value = self._walk(label, (value + step) % size, left, right, size, True)
        out = []
        for radix in reversed(radices):
            value, digit = divmod(value, radix)
            out.append(digit)
        return out[::-1]


def luhn(digits: Sequence[int]) -> bool:
    return (sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])) % 10 == 0


def _refill(text: str, digits: Sequence[int]) -> str:
    """``text`` with its decimal digits replaced."""
    left = iter(digits)
    return "".join(str(next(left)) if c.isdigit() else c for c in text)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def card(f: Feistel, text: str, step: int = 1) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1:
        return None
    # The first digit names the network, the last is the check digit.
    middle = f.permute("card", digits[1:-1], [10] * (len(digits) - 2), step)
    body = [digits[0], *middle]
    check = next(d for d in range(10) if luhn([*body, d]))
    return _refill(text, [*body, check])


# IBAN lengths by country, as in the registry.
IBAN_SIZES = dict(
    pair.split("=")
    for pair in (
        "AD=24 AE=23 AL=28 AT=20 AZ=28 BA=20 BE=16 BG=22 BH=22 BI=27 BR=29 BY=28 CH=21 CR=22 CY=28 CZ=24"
        " DE=22 DJ=27 DK=18 DO=28 EE=20 EG=29 ES=24 FI=18 FK=18 FO=18 FR=27 GB=22 GE=22 GI=23 GL=18 GR=27"
        " GT=28 HN=28 HR=21 HU=28 IE=22 IL=23 IQ=23 IS=26 IT=27 JO=30 KW=30 KZ=20 LB=28 LC=32 LI=21 LT=20"
        " LU=20 LV=21 LY=25 MC=27 MD=24 ME=22 MK=19 MN=20 MR=27 MT=31 MU=30 NI=28 NL=18 NO=15 OM=23 PK=24"
        " PL=28 PS=29 PT=25 QA=29 RO=24 RS=22 RU=33 SA=24 SC=31 SD=18 SE=24 SI=19 SK=24 SM=27 SO=23 ST=25"
        " SV=28 TL=23 TN=24 TR=26 UA=29 VA=22 VG=24 XK=20 YE=30"
    ).split()
)


def _iban_pattern() -> re.Pattern[str]:
    """Each country's length, spaces not counted, whatever follows."""
    by_size: dict[int, list[str]] = {}
    for country, size in IBAN_SIZES.items():
        by_size.setdefault(int(size), []).append(country)
    forms = [rf"(?:{'|'.join(c)})\d{{2}}(?: ?[0-9A-Z]){{{size - 4}}}" for size, c in by_size.items()]
    # A currency may be written right behind.
    end = r"(?:(?![0-9A-Za-z])|(?=[A-Z]{3}(?![0-9A-Za-z])))"
    return re.compile(rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join(forms)}){end}", re.ASCII | re.I)


# How small letters are written: without spaces or in groups of four, unlike prose.
_GROUPED = re.compile(r"[0-9a-z]+|[0-9a-z]{4}(?: [0-9a-z]{4})*(?: [0-9a-z]{1,3})?")


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(f: Feistel, text: str, step: int = 1) -> str | None:
    small = text != text.upper()
    if small and not _GROUPED.fullmatch(text):
        return None
    plain = text.replace(" ", "").upper()
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if IBAN_SIZES.get(country) != str(len(plain)) or _mod97(body + country + check) != 1:
        return None
    if not 2 <= int(check) <= 98:
        return None
    radices = [10 if c.isdigit() else 26 for c in body]
    values = [int(c) if c.isdigit() else ord(c) - 65 for c in body]
    new = "".join(
        str(v) if r == 10 else chr(65 + v)
        for v, r in zip(f.permute("iban", values, radices, step), radices, strict=True)
    )
    new = country + f"{98 - _mod97(new + country + '00'):02d}" + new
    left = iter(new.lower() if small else new)
    return "".join(c if c == " " else next(left) for c in text)


# The groups of taxpayer numbers, whose areas are 900 to 999.
_TAXPAYER_GROUPS = [g for a, b in ((50, 65), (70, 88), (90, 92), (94, 99)) for g in range(a, b + 1)]


def ssn(f: Feistel, text: str, step: int = 1) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area >= 900:
        if group not in _TAXPAYER_GROUPS:
            return None
        groups = len(_TAXPAYER_GROUPS)
        new = f.permute("taxpayer", [area - 900, _TAXPAYER_GROUPS.index(group), serial], [100, groups, 10000], step)
        return f"{new[0] + 900}-{_TAXPAYER_GROUPS[new[1]]:02d}-{new[2]:04d}"
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    place, group, serial = f.permute("ssn", [place, group - 1, serial - 1], [898, 99, 9999], step)
    return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(f: Feistel, text: str, step: int = 1) -> str | None:
    digits = _digits(text)
    plus = text.startswith("+")
    national = digits[1:] if plus and digits[0] == 1 else digits
    if len(national) == 10 and (not plus or digits[0] == 1):
        # North American: area code and exchange begin with 2 to 9.
        if national[0] < 2 or national[3] < 2:
            return None
        radices = [8, 10, 10, 8, 10, 10, 10, 10, 10, 10]
        values = [d - 2 if r == 8 else d for d, r in zip(national, radices, strict=True)]
        new = [
            v + 2 if r == 8 else v
            for v, r in zip(f.permute("phone", values, radices, step), radices, strict=True)
        ]
        return _refill(text, digits[: len(digits) - 10] + new)
    if not plus or not 8 <= len(digits) <= 15 or not digits[0]:
        return None
    # Elsewhere the first two digits stay, so that the country does.
    return _refill(text, digits[:2] + f.permute("phone", digits[2:], [10] * (len(digits) - 2), step))


def ipv4(f: Feistel, text: str, step: int = 1) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    return ".".join(map(str, f.permute("ipv4", [int(p) for p in parts], [256] * 4, step)))


FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
# The network runs on 271 x 270 numbers, a few more than days, and walks on from those beyond.
_DAYS = LAST_DAY - FIRST_DAY + 1
_DAY_RADICES = (271, 270)


def _day(f: Feistel, day: date, step: int) -> date:
    value = day.toordinal() - FIRST_DAY
    while True:
        a, b = f.permute("date", divmod(value, _DAY_RADICES[1]), _DAY_RADICES, step)
        value = a * _DAY_RADICES[1] + b
        if value < _DAYS:
            return date.fromordinal(FIRST_DAY + value)


def calendar_date(f: Feistel, text: str, step: int = 1) -> str | None:
    """Year first, or day first, or with slashes the month first unless that cannot be."""
    parts = re.split(r"[-/.]", text)
    numbers = [int(p) for p in parts]
    if len(parts[0]) == 4:
        order = (0, 1, 2)
    elif "/" in text and numbers[0] <= 12:
        order = (2, 0, 1)
    else:
        order = (2, 1, 0)
    year, month, day = (numbers[i] for i in order)
    if not 1900 <= year <= 2099 or not 1 <= month <= 12 or not 1 <= day <= monthrange(year, month)[1]:
        return None
    new = _day(f, date(year, month, day), step)
    values = dict(zip(order, (new.year, new.month, new.day), strict=True))
    separator = re.search(r"[-/.]", text)[0]  # type: ignore[index]
    return separator.join(f"{values[i]:0{len(parts[i])}d}" for i in range(3))


MONTHS = (
    "January February March April May June July August September October November December".split()
)


def written_date(f: Feistel, text: str, step: int = 1) -> str | None:
    """``March 5, 2024`` or ``5 March 2024``."""
    words = re.findall(r"\w+", text)
    month = next(w for w in words if w in MONTHS)
    number = next(w for w in words if w not in MONTHS)
    year, day = int(words[-1]), int(number)
    if not 1900 <= year <= 2099 or not 1 <= day <= monthrange(year, MONTHS.index(month) + 1)[1]:
        return None
    new = _day(f, date(year, MONTHS.index(month) + 1, day), step)
    values = iter([MONTHS[new.month - 1], f"{new.day:0{len(number)}d}"][:: 1 if words[0] == month else -1])
    return re.sub(r"\w+", lambda _: next(values, f"{new.year}"), text)


# Digits, Latin letters, and the letters beyond ASCII that mail addresses have: Latin, Greek, Cyrillic.
_CLASSES = (
    (48, 10), (65, 26), (97, 26), (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x100, 128),
    (0x391, 17), (0x3A3, 7), (0x3B1, 25), (0x410, 32), (0x430, 32),
)


def _by_class(f: Feistel, kind: str, text: str, step: int) -> str:
    """Digits, capitals, small letters and letters of other ranges each among themselves; the rest stays."""
    codes = [ord(c) for c in text]
    bases = [next((k for k in _CLASSES if k[0] <= c < sum(k)), None) for c in codes]
    values = [c - b[0] for c, b in zip(codes, bases, strict=True) if b]
    new = iter(f.permute(kind, values, [b[1] for b in bases if b], step))
    return "".join(chr(b[0] + next(new)) if b else chr(c) for c, b in zip(codes, bases, strict=True))


def mail(f: Feistel, text: str, step: int = 1) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{_by_class(f, 'mail', local, step)}@{domain}"


def access_key(f: Feistel, text: str, step: int = 1) -> str | None:
    return text[:4] + _by_class(f, "key", text[4:], step)


_HEX = re.compile(r"[0-9a-f]+")
_SECRET = re.compile(r"^(.*?[=:]\s*[\"']?)(.*)$", re.DOTALL)


def credential(f: Feistel, text: str, step: int = 1) -> str | None:
    name, value = _SECRET.match(text).groups()  # type: ignore[union-attr]
    # What has neither digits nor capitals inside is more likely a word.
    if not re.search(r"\d", value) and not re.search(r"[a-z][A-Z]", value):
        return None
    if _HEX.fullmatch(value):
        new = [int(c, 16) for c in value]
        while True:
            new = f.permute("hex", new, [16] * len(value), step)
            # Walks on to a value that has a digit too.
            if min(new) < 10:
                return name + "".join(f"{v:x}" for v in new)
    return name + _by_class(f, "secret", value, step)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: re.Pattern[str]
    write: Callable[..., str | None]


# The first of two overlapping finds wins. Each pattern starts with a narrow class or a literal,
# so that scanning a text without finds is quick.
KINDS = (
    Kind("credential", re.compile(
        r"(?:password|passwd|token|secret|api_key|apikey)\s?[=:]\s?[\"']?[0-9A-Za-z+/_\-]{8,}", re.I), credential),
    Kind("access_key", re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])"), access_key),
    Kind("iban", _iban_pattern(), iban),
    Kind("date", re.compile(
        r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!(?!T\d)[\w/-]|\.\d)",
        re.ASCII), calendar_date),
    Kind("written_date", re.compile(
        rf"(?<!\w)(?:(?:{'|'.join(MONTHS)}) \d{{1,2}}, ?\d{{4}}|\d{{1,2}} (?:{'|'.join(MONTHS)}),? \d{{4}})(?!\w)",
        re.ASCII), written_date),
    Kind("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII), ssn),
    Kind("ipv4", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", re.ASCII), ipv4),
    Kind("card", re.compile(r"(?<![\w.])\d{4}(?:[ .-]?\d{4}){2}(?:[ .-]?\d{1,7})(?![\w-])|(?<![\w.])\d{13,19}(?!\w)"
                            r"|(?<![\w.])\d{4}[ -]\d{6}[ -]\d{5}(?!\w)", re.ASCII), card),
    Kind("phone", re.compile(
        r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
        r"|(?<![\w+])\+(?!1\D)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
        r"|(?<![\w+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])", re.ASCII), phone),
)

_LETTERS = "A-Za-z" + "".join(f"{chr(a)}-{chr(a + n - 1)}" for a, n in _CLASSES[3:])
_LOCAL = re.compile(rf"[0-9{_LETTERS}._%+\-]{{1,64}}\Z")
_LABEL = rf"[0-9{_LETTERS}](?:[0-9{_LETTERS}\-]{{0,61}}[0-9{_LETTERS}])?"
_DOMAIN = re.compile(rf"(?:{_LABEL}\.)+[{_LETTERS}]{{2,24}}(?![0-9{_LETTERS}])")


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """Found from the ``@`` outwards: there are few of them."""
    at = text.find("@")
    while at >= 0:
        local = _LOCAL.search(text, max(0, at - 64), at)
        domain = _DOMAIN.match(text, at + 1)
        if local and domain:
            yield local.start(), domain.end()
        at = text.find("@", at + 1)


def find(text: str) -> list[tuple[int, int, str, Callable[..., str | None]]]:
    """Spans that look like a value of some kind, in order of the kinds."""
    out = [(a, b, "mail", mail) for a, b in _mails(text)]
    for kind in KINDS:
        out += [(m.start(), m.end(), kind.name, kind.write) for m in kind.pattern.finditer(text)]
    return out


def pseudonymise(text: str, f: Feistel, step: int = 1) -> tuple[str, list[tuple[str, str]]]:
    """The text with its values replaced, and the pseudonyms with their kinds, in text order."""
    taken: list[int] = []
    new: list[tuple[int, int, str, str]] = []
    for start, end, name, write in find(text):
        # ``taken`` holds starts and ends of what is replaced, in order.
        place = bisect_left(taken, start + 1)
        if place % 2 or (place < len(taken) and taken[place] < end):
            continue
        written = write(f, text[start:end], step)
        if written is not None:
            taken[place:place] = [start, end]
            new.append((start, end, name, written))
    if not new:
        return text, []
    new.sort()
    out, at = [], 0
    for start, end, _, written in new:
        out += [text[at:start], written]
        at = end
    return "".join([*out, text[at:]]), [(name, written) for _, _, name, written in new]


@lru_cache(maxsize=4)
def _network(key: bytes) -> Feistel:
    return Feistel(key)


def protect(
    df: DataFrame, key: bytes, text: str = "text", *, values: str = "pseudonyms"
) -> DataFrame:
    """Replace ``text`` by its pseudonymised form and add ``values``, an array of kind and
    pseudonym. The key must come from outside the data and be kept."""
    _network(key)
    kept = [c for c in df.columns if c not in (text, values)]
    entry = T.StructType([T.StructField("kind", T.StringType()), T.StructField("pseudonym", T.StringType())])
    schema = T.StructType(
        [
            *(f for f in df.schema.fields if f.name in kept),
            T.StructField(text, T.StringType()),
            T.StructField(values, T.ArrayType(entry)),
        ]
    )
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("pseudonym", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = _network(key)
        for batch in batches:
            done = [(t, []) if t is None else pseudonymise(t, network) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array([d[0] for d in done], pa.string()),
                    pa.array([[{"kind": k, "pseudonym": p} for k, p in d[1]] for d in done], arrow),
                ],
                [*kept, text, values],
            )

    return df.select(*kept, text).mapInArrow(run, schema)
