"""Operator 7: personal data replaced by format-preserving Feistel pseudonyms.

A value is found by pattern, validated (check digits, octets, calendar), and its
digits are permuted by a keyed Feistel network over exactly the values of its
format: cycle walking goes on until the result is valid again. The permutation
is a bijection, so equal values get equal pseudonyms in every document, and
different values different ones. Lengths, separators and check digits stay right.

=========  =====================================================  =======================
kind       validated                                              kept
=========  =====================================================  =======================
card       13 to 19 digits, Luhn                                  length, separators, Luhn
iban       country and length 15 to 34, remainder 97              country, remainder 97
ssn        area, group, serial not all zero                       separators
phone      international or bracketed area code, 10 digits        country code, separators
ip         four octets up to 255                                  dots
date       real day from 1900 to 2099, ISO or d/m/y, m/d/y        order, separators
email      local@domain.tld                                       domain; letters as letters
key        AKIA + 16 capitals or digits                           prefix
secret     password, token, secret or api key = value of 8 or     name, quotes; hex stays hex
           more letters and digits, at least one digit
=========  =====================================================  =======================

Values that fail validation stay as they are. Edge cases: a null text stays null
with no finds; repeated rows give equal results; null ids and other columns pass
through untouched; a value equal to its own image (one in the size of its format)
stays. Day-month order is month first where both readings are valid dates.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

ROUNDS = 10
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "key", "secret")

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1

PATTERNS = re.compile(
    r"""
    (?P<secret>(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)[ ]{0,2}[=:][ ]{0,2}["']?(?=[A-Za-z_-]*\d)[A-Za-z0-9_-]{8,})
  | (?P<email>(?<![\w.+-])[A-Za-z0-9_.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-]))
  | (?P<key>(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d))
  | (?P<date>(?<![\d/-])(?:\d{4}-\d\d-\d\d|\d{1,2}[/.]\d{1,2}[/.]\d{4}|\d{4}/\d\d/\d\d)(?![\d/-]|\.\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-]))
  | (?P<phone>(?<![\w+(])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-]))
  | (?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{5})(?![\w-]))
    """,
    re.VERBOSE | re.ASCII,
)
#: Every pattern needs one of these somewhere.
MAY_HOLD = re.compile(r"[0-9]|@", re.ASCII)


class Feistel:
    """A keyed permutation of 0..size-1, different for every ``tweak``."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, number: int, half: int) -> int:
        said = f"{tweak}|{number}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def permute(self, value: int, size: int, tweak: str) -> int:
        """Unbalanced halves a x b >= size; a result outside is permuted again."""
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        tweak = f"{tweak}|{size}"
        while True:
            left, right = divmod(value, b)
            for i in range(ROUNDS):
                if i % 2:
                    right = (right + self._round(tweak, i, left)) % b
                else:
                    left = (left + self._round(tweak, i, right)) % a
            value = left * b + right
            if value < size:
                return value

    def walk(self, value: int, size: int, tweak: str, valid: Callable[[int], bool]) -> int:
        """A permutation of the valid values alone; ``value`` must be valid."""
        while True:
            value = self.permute(value, size, tweak)
            if valid(value):
                return value

    def digits(self, digits: str, tweak: str, valid: Callable[[str], bool] = lambda d: True) -> str:
        n = len(digits)
        return f"{self.walk(int(digits), 10**n, f'{tweak}{n}', lambda v: valid(f'{v:0{n}d}')):0{n}d}"


def fill(shape: str, digits: str, at: Callable[[str], bool] = str.isdigit) -> str:
    """``shape`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if at(c) else c for c in shape)


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def card(f: Feistel, found: str) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not luhn(digits) or len(set(digits)) == 1:
        return None
    body = f.digits(digits[:-1], "card", lambda d: len(set(d)) > 1)
    return fill(found, body + next(c for c in "0123456789" if luhn(body + c)))


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def iban(f: Feistel, found: str) -> str | None:
    plain = found.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_check(country, rest) != check:
        return None
    new = characters(f, rest, "iban" + country)
    return fill(found, country + iban_check(country, new) + new, str.isalnum)


def characters(f: Feistel, text: str, tweak: str) -> str:
    """Digits to digits, capitals to capitals, small letters to small letters; everything else stays."""
    sets = [next((s for s in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c in s), c) for c in text]
    value, size = 0, 1
    for c, s in zip(text, sets):
        value, size = value * len(s) + s.index(c), size * len(s)
    shape = "".join(s[0] if len(s) > 1 else "\\" + s for s in sets)
    value = f.permute(value, size, f"{tweak}|{shape}")
    out = []
    for s in reversed(sets):
        value, k = divmod(value, len(s))
        out.append(s[k])
    return "".join(reversed(out))


def ssn(f: Feistel, found: str) -> str | None:
    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    digits = found.replace("-", "")
    return fill(found, f.digits(digits, "ssn", valid)) if valid(digits) else None


def phone(f: Feistel, found: str) -> str | None:
    head = re.match(r"\+\d{1,3}(?=\D)|\+1(?=\d{10}$)|", found)[0]
    shape = found[len(head) :]
    digits = re.sub(r"\D", "", shape)
    if not 7 <= len(digits) <= 13:
        return None

    def valid(d: str) -> bool:
        return d[0] not in "01" and (len(d) != 10 or d[3] not in "01")

    # A number that breaks the numbering rules is permuted among those that break them.
    kind = valid(digits)
    return head + fill(shape, f.digits(digits, "phone" + head + "ny"[kind], lambda d: valid(d) == kind))


def ip(f: Feistel, found: str) -> str | None:
    octets = found.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    value = int.from_bytes(bytes(map(int, octets)), "big")
    return ".".join(map(str, f.permute(value, 1 << 32, "ip").to_bytes(4, "big")))


def date(f: Feistel, found: str) -> str | None:
    sep = re.search(r"\D", found)[0]
    parts = found.split(sep)
    orders = ["ymd"] if len(parts[0]) == 4 else ["mdy", "dmy"] if sep == "/" else ["dmy", "mdy"]
    for place, order in enumerate(orders):
        at = {k: int(p) for k, p in zip(order, parts)}
        try:
            day = datetime.date(at["y"], at["m"], at["d"]).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        # A date that only the second order can read (its day is above 12) stays among such
        # dates, so that no result can be read in an order other than its own.
        moved = f.walk(day, DAYS, "date second", lambda v: datetime.date.fromordinal(v + FIRST_DAY).day > 12) if place else f.permute(day, DAYS, "date")
        new = datetime.date.fromordinal(moved + FIRST_DAY)
        values = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return sep.join(values[k] for k in order)
    return None


def email(f: Feistel, found: str) -> str | None:
    local, _, domain = found.rpartition("@")
    return characters(f, local, "email" + domain.lower()) + "@" + domain


def key(f: Feistel, found: str) -> str | None:
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    value = f.permute(int(found[4:], 36), 36**16, "key")
    out = []
    for _ in range(16):
        value, k = divmod(value, 36)
        out.append(alphabet[k])
    return "AKIA" + "".join(reversed(out))


def secret(f: Feistel, found: str) -> str:
    at = re.search(r"""[A-Za-z0-9_-]+$""", found).start()
    value = found[at:]
    if re.fullmatch(r"[0-9a-f]+", value):
        n = len(value)
        return f"{found[:at]}{f.permute(int(value, 16), 16**n, f'hex{n}'):0{n}x}"
    return found[:at] + characters(f, value, "secret")


MAKERS = {"card": card, "iban": iban, "ssn": ssn, "phone": phone, "ip": ip, "date": date, "email": email, "key": key, "secret": secret}


def pseudonymise(f: Feistel, text: str) -> tuple[str, dict[str, int]]:
    counts: dict[str, int] = {}
    if not MAY_HOLD.search(text):
        return text, counts

    def replace(m: re.Match) -> str:
        kind = next(k for k in KINDS if m[k] is not None)
        new = MAKERS[kind](f, m[0])
        if new is None:
            return m[0]
        counts[kind] = counts.get(kind, 0) + 1
        return new

    return PATTERNS.sub(replace, text), counts


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with ``text`` pseudonymised and a column ``pii``: a struct of the number of finds of each kind.

    One pass over the texts without a shuffle. Any other column passes through;
    a column named ``pii`` is replaced.
    """
    docs = docs.drop("pii")
    names = docs.columns
    at = names.index("text")
    counts = StructType([StructField(k, LongType()) for k in KINDS])
    schema = StructType([*docs.schema.fields, StructField("pii", counts)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            done = [(None, {}) if t is None else pseudonymise(f, t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            found = pa.StructArray.from_arrays([pa.array([c.get(k, 0) for _, c in done], pa.int64()) for k in KINDS], names=list(KINDS))
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, "pii"])

    return docs.mapInArrow(work, schema)
