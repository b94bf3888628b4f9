"""Format-preserving pseudonyms for personal data.

Card numbers (Luhn), IBANs (mod 97), social security numbers, phone numbers, IPv4 addresses, calendar dates and e-mail
addresses are found and validated; each value is then permuted within the set of all values of its format by a keyed
Feistel network. Separators, lengths, country prefixes and domains stay, check digits are made anew, so a pseudonym is
as valid as what it stands for. The permutation sees only the normalised value: a number keeps its pseudonym whatever
its spacing, in all documents. So does a date whatever its notation, as far as the notation can write the pseudonym and be read
again: one with a single digit for the day, say, walks on along the permutation to a day of one digit. Without the key nothing leads back; with it,
``pseudonym(..., back=True)`` does.

Defined results: a null text stays null; a text without personal data stays as it is; values that fail validation are
left alone; repeated rows each give a row. Where more letters or digits follow a card number or an IBAN, the longest valid
part that ends with a group counts, for an IBAN that of its country's length; so a text that was changed is not always read the
same way again.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from datetime import date
from hashlib import blake2b
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_name

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")

_B, _E = rb"(?<![0-9A-Za-z])", rb"(?![0-9A-Za-z])"
PATTERNS = {
    "email": re.compile(rb"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(_B + rb"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}" + _E),
    "ip": re.compile(rb"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])"),
    "date": re.compile(_B + rb"(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?:" + _E + rb"|(?=[Tt][0-9]{2}|[Zz]" + _E + rb"))"),
    "ssn": re.compile(_B + rb"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _E),
    "phone": re.compile(
        rb"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}"
        rb"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4})" + _E
    ),
    "card": re.compile(_B + rb"[0-9](?:[ -]?[0-9]){12,18}" + _E),
}

#: Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 21, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: Country calling codes of one and two digits; all others have three.
CALLING_CODES = {
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52",
    "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93",
    "94", "95", "98",
}


def pseudonym(
    value: int, size: int, key: bytes, kind: str, back: bool = False, fits: Callable[[int], bool] = lambda x: True,
) -> int:
    """``value`` permuted within the numbers of 0 … ``size`` - 1 that ``fits`` by a Feistel network, walking on until it is
    inside again."""
    if size < 2:
        return value
    side = isqrt(size - 1) + 1
    width = (side.bit_length() + 7) // 8
    tag = f"{kind}:{size}:".encode()

    def mix(step: int, half: int) -> int:
        data = tag + bytes([step]) + half.to_bytes(width, "big")
        return int.from_bytes(blake2b(data, key=key, digest_size=min(width + 8, 64)).digest(), "big")

    while True:
        left, right = divmod(value, side)
        if back:
            for step in reversed(range(ROUNDS)):
                left, right = (right - mix(step, left)) % side, left
        else:
            for step in range(ROUNDS):
                left, right = right, (left + mix(step, right)) % side
        value = left * side + right
        if value < size and fits(value):
            return value


def luhn_digit(payload: str) -> str:
    """The check digit that makes a number valid."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _spelled(text: str, key: bytes, kind: str, back: bool) -> str:
    """Letters and digits permuted together, each place within its own kind."""
    kinds = [("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26) if c.isalpha() else (c, 1) for c in text]
    value, size = 0, 1
    for c, (zero, base) in zip(text, kinds, strict=True):
        value, size = value * base + ord(c) - ord(zero), size * base
    value = pseudonym(value, size, key, kind, back)
    out = []
    for zero, base in reversed(kinds):
        value, digit = divmod(value, base)
        out.append(chr(ord(zero) + digit))
    return "".join(reversed(out))


def _digits_into(form: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def _email(text: str, key: bytes, back: bool) -> str | None:
    local, _, domain = text.partition("@")
    return f"{_spelled(local, key, 'email', back)}@{domain}"


def _iban(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or not 2 <= int(plain[2:4]) <= 98 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _spelled(plain[4:], key, "iban", back)
    out = iter(plain[:2] + f"{98 - _mod97(body + plain[:2] + '00'):02d}" + body)
    return "".join(" " if c == " " else next(out) for c in text)


def _ip(text: str, key: bytes, back: bool) -> str | None:
    octets = text.split(".")
    if any(int(x) > 255 or str(int(x)) != x for x in octets):
        return None
    spans = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(x)] for x in octets]  # lengths stay
    value, size = 0, 1
    for x, (low, count) in zip(octets, spans, strict=True):
        value, size = value * count + int(x) - low, size * count
    value = pseudonym(value, size, key, "ip", back)
    out = []
    for low, count in reversed(spans):
        value, x = divmod(value, count)
        out.append(str(low + x))
    return ".".join(reversed(out))


def _date(text: str, key: bytes, back: bool) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    parts = text.split(mark)
    if len(parts[0]) == 4:
        order = (0, 1, 2)
    elif mark == "/" and int(parts[0]) <= 12:  # month first, unless it can't be one
        order = (2, 0, 1)
    else:
        order = (2, 1, 0)
    try:
        day = date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    day_first = mark == "/" and order == (2, 1, 0)  # read so because the day is above 12

    def fits(x: int) -> bool:
        new = date.fromordinal(FIRST_DAY + x)
        return all(
            len(str(value)) <= len(parts[i]) for i, value in zip(order, (new.year, new.month, new.day), strict=True)
        ) and not (day_first and new.day <= 12)

    new = date.fromordinal(FIRST_DAY + pseudonym(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date", back, fits))
    for i, value in zip(order, (new.year, new.month, new.day), strict=True):
        parts[i] = str(value).zfill(len(parts[i]))
    return mark.join(parts)


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(pseudonym(value, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"[^0-9]", "", text)
    code = 0
    if text[0] == "+":
        code = next((n for n in (1, 2) if digits[:n] in CALLING_CODES), 3)
    own = digits[code:]
    if not 6 <= len(own) <= 14:
        return None
    value = pseudonym(int(own), 10 ** len(own), key, "phone", back)
    return _digits_into(text, digits[:code] + str(value).zfill(len(own)))


def _card(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"[^0-9]", "", text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = str(pseudonym(int(digits[:-1]), 10 ** (len(digits) - 1), key, "card", back)).zfill(len(digits) - 1)
    return _digits_into(text, payload + luhn_digit(payload))


_RULES: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


def _ends(kind: str, value: bytes) -> list[int]:
    """How long a value may be within a match: the match itself, or for cards and IBANs also a part that ends with a group."""
    if kind not in ("card", "iban"):
        return [len(value)]
    sizes, n = {}, 0
    for group in re.finditer(rb"[0-9A-Za-z]+", value):
        n += len(group.group())
        sizes[group.end()] = n
    if kind == "card":
        return [i for i in sorted(sizes, reverse=True) if sizes[i] >= 13]
    own = IBAN_LENGTHS.get(value[:2].decode())
    return [i for i in sizes if sizes[i] == own and i < len(value)] + [len(value)]


def replaced(text: bytes, key: bytes, back: bool = False) -> tuple[bytes | None, dict[str, int]]:
    """The text with pseudonyms, or None where nothing changes, and how many values of each kind it had."""
    found: list[tuple[int, int, str, bytes]] = []
    for kind in KINDS:
        if kind == "email" and b"@" not in text:
            continue
        others, at = sorted((a, b) for a, b, _, _ in found), 0
        while m := PATTERNS[kind].search(text, at):
            start, at = m.start(), m.start() + 1
            i = bisect_right(others, (start, len(text)))
            if i and others[i - 1][1] > start:
                at = others[i - 1][1]
                continue
            free = others[i][0] if i < len(others) else len(text)
            for end in _ends(kind, m.group()):
                if start + end > free:
                    continue
                new = _RULES[kind](text[start : start + end].decode(), key, back)
                if new is not None:
                    found.append((start, start + end, kind, new.encode()))
                    at = start + end
                    break
    if not found:
        return None, {}
    out, last, counts = [], 0, dict.fromkeys(KINDS, 0)
    for a, b, kind, new in sorted(found):
        out += [text[last:a], new]
        last = b
        counts[kind] += 1
    return b"".join(out) + text[last:], counts


def pseudonymise(docs: DataFrame, key: bytes, name: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in its texts and a struct of counts by kind (``name``, the last column)."""
    name = fresh_name(docs, name)
    fields = ", ".join(f"n_{k} int" for k in KINDS)

    @F.pandas_udf(f"text binary, {fields}")
    def change(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            new, counts = (None, {}) if t is None else replaced(t, key)
            rows.append((new, *(counts.get(k, 0) for k in KINDS)))
        return pd.DataFrame(rows, columns=["text", *(f"n_{k}" for k in KINDS)])

    found = docs.withColumn(name, change(F.col("text").cast("binary")))
    new = F.coalesce(F.col(f"{name}.text").cast("string"), F.col("text"))
    return found.withColumn("text", new).withColumn(name, F.col(name).dropFields("text"))
