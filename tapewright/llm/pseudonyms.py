"""Personal data: format-preserving pseudonyms.

Numbers and dates that pass their own validation (check digits, calendar, ranges) are replaced by others of the same
format, by a keyed Feistel permutation of the format's values. The permutation is one to one and depends on the value
alone, so equal values stay equal across documents, whatever their separators, and different ones stay different. Check
digits are made anew; ranges are kept by walking the permutation until it lands inside.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

ROUNDS = 10
FIRST_DAY, DAYS = datetime.date(1900, 1, 1), 73049  # to the end of 2099


class Feistel:
    """Keyed permutations of the numbers below a * b, by alternating additions to the two halves."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _round(self, tweak: str, n: int, half: int) -> int:
        return int.from_bytes(blake2b(f"{tweak}|{n}|{half}".encode(), key=self.key, digest_size=16).digest(), "big")

    def permute(self, value: int, a: int, b: int, tweak: str) -> int:
        left, right = divmod(value, b)
        for n in range(ROUNDS):
            if n % 2:
                right = (right + self._round(tweak, n, left)) % b
            else:
                left = (left + self._round(tweak, n, right)) % a
        return left * b + right

    def digits(self, text: str, radix: int, tweak: str) -> str:
        """A string of digits of that radix, replaced by one of equal length."""
        if not text:
            return text
        half = len(text) // 2
        found, out = self.permute(int(text, radix), radix**half, radix ** (len(text) - half), f"{tweak}{radix}:{len(text)}"), []
        for _ in text:
            found, d = divmod(found, radix)
            out.append("0123456789abcdef"[d])
        return "".join(reversed(out))

    def walk(self, value: int, a: int, b: int, tweak: str, inside: Callable[[int], bool]) -> int:
        """Permutes again until the value is inside; one to one on the values inside."""
        while True:
            value = self.permute(value, a, b, tweak)
            if inside(value):
                return value


def luhn_digit(payload: str) -> str:
    total = 0
    for k, d in enumerate(reversed(payload)):
        total += sum(divmod(int(d) * (2 - k % 2), 10))
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in turn."""
    it = iter(digits)
    return re.sub(r"\d", lambda _: next(it), shape)


def _card(f: Feistel, m: re.Match) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    new = digits[0] + f.digits(digits[1:-1], 10, "card")
    return _refill(m[0], new + luhn_digit(new))


def _iban(f: Feistel, m: re.Match) -> str | None:
    bare = m[0].replace(" ", "")
    numeric = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(bare) <= 34 or numeric(bare[4:] + bare[:4]) % 97 != 1:
        return None
    body = bare[4:]
    new = _refill(body, f.digits(re.sub(r"\D", "", body), 10, "iban"))
    check = f"{98 - numeric(new + bare[:2] + '00') % 97:02d}"
    it = iter(bare[:2] + check + new)
    return "".join(c if c == " " else next(it) for c in m[0])


#: The IBAN lengths of countries; of others every end is tried.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 "
    "IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}


def _iban_ends(m: re.Match) -> list[int]:
    """Where the value may end: at its country's length; anywhere between words if the country is unknown."""
    ends = [m.start() + k for k in range(len(m[0]), 14, -1) if k == len(m[0]) or m[0][k] == " "]
    length = IBAN_LENGTHS.get(m[0][:2])
    return ends if length is None else [e for e in ends if len(m[0][: e - m.start()].replace(" ", "")) == length]


def _ssn(f: Feistel, m: re.Match) -> str | None:
    def valid(n: int) -> bool:
        area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(m[0].replace("-", ""))
    return _refill(m[0], f"{f.walk(value, 10**4, 10**5, 'ssn', valid):09d}") if valid(value) else None


def _ipv4(f: Feistel, m: re.Match) -> str | None:
    parts = [int(x) for x in m[0].split(".")]
    if any(p > 255 for p in parts) or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    new = f.permute(int.from_bytes(bytes(parts), "big"), 1 << 16, 1 << 16, "ipv4")
    return ".".join(str(b) for b in new.to_bytes(4, "big"))


def _phone(f: Feistel, m: re.Match) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not 8 <= len(digits) <= 15:
        return None
    if m[0][0] != "+":
        return _refill(m[0], f.digits(digits, 10, "phone"))
    code = _COUNTRY_CODE.match(digits)[0]
    return _refill(m[0], code + f.digits(digits[len(code) :], 10, f"phone{code}"))


_COUNTRY_CODE = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _date(f: Feistel, m: re.Match) -> str | None:
    y, mo, d, sep = (m["y"], m["m"], m["d"], m["s"]) if m["y"] else (m["y2"], m["m2"], m["d2"], m["s2"])
    month_first = not m["y"] and int(mo) > 12
    if month_first:
        mo, d = d, mo
    if m["y"] and sep == "." and len(mo + d) < 4:
        return None
    try:
        day = (datetime.date(int(y), int(mo), int(d)) - FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    # a date with the month first stays one that can't be read with the day first
    new = FIRST_DAY + datetime.timedelta(f.walk(day, 1 << 8, 1 << 9, "date", lambda n: n < DAYS and (not month_first or (FIRST_DAY + datetime.timedelta(n)).day > 12)))
    year, month, day_ = f"{new.year:04d}", f"{new.month:0{len(mo)}d}", f"{new.day:0{len(d)}d}"
    return sep.join((year, month, day_) if m["y"] else (month, day_, year) if month_first else (day_, month, year))


def _email(f: Feistel, m: re.Match) -> str | None:
    local = m["local"]
    letters = re.sub(r"[^a-z]", "", re.sub(r"[A-Z]", lambda c: c[0].lower(), local))
    it, at = iter(_letters(f, letters)), iter(f.digits(re.sub(r"[^0-9]", "", local), 10, "email-digits"))
    wide = iter(_wide_letters(f, [c for c in local if c > "\x7f" and c.isalpha()]))
    out = re.sub(r"[a-z]|[A-Z]|[0-9]", lambda c: next(at) if c[0].isdigit() else next(it).upper() if c[0].isupper() else next(it), local)
    return "".join(next(wide) if c > "\x7f" and c.isalpha() else c for c in out) + m[0][len(local) :]


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """The letters of c's case in its block of 128 code points."""
    first = ord(c) // 128 * 128
    return "".join(x for x in map(chr, range(first, first + 128)) if x.isalpha() and (x.isupper(), x.islower()) == (c.isupper(), c.islower()))


def _wide_letters(f: Feistel, letters: list[str]) -> list[str]:
    """Letters beyond ASCII, replaced together by others of their alphabets: one to one on all texts of these alphabets."""
    alphabets, half = [_alphabet(c) for c in letters], len(letters) // 2
    n = 0
    for c, alphabet in zip(letters, alphabets):
        n = n * len(alphabet) + alphabet.index(c)
    n = f.permute(n, prod(map(len, alphabets[:half])), prod(map(len, alphabets[half:])), "email-wide" + "".join(a[0] for a in alphabets))
    out = []
    for alphabet in reversed(alphabets):
        n, k = divmod(n, len(alphabet))
        out.append(alphabet[k])
    return out[::-1]


def _letters(f: Feistel, text: str) -> str:
    if not text:
        return text
    n = 0
    for c in text:
        n = n * 26 + ord(c) - 97
    half = len(text) // 2
    n, out = f.permute(n, 26**half, 26 ** (len(text) - half), f"email:{len(text)}"), []
    for _ in text:
        n, d = divmod(n, 26)
        out.append(chr(97 + d))
    return "".join(reversed(out))


def _secret(f: Feistel, m: re.Match) -> str | None:
    new = f.digits(m["hex"], 16, "secret")
    return m["lead"] + "".join(c.upper() if was.isupper() else c for c, was in zip(new, _cased(m["hex"])))


def _cased(text: str) -> str:
    """The text with the digits in the case of the letter before them (or, at the front, of the first letter)."""
    out, case = [], next((c for c in text if c.isalpha()), "a")
    for c in text:
        case = c if c.isalpha() else case
        out.append(case)
    return "".join(out)


#: Tried in this order; what one kind has replaced, later kinds don't see.
KINDS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("email", re.compile(r"(?P<local>[A-Za-z0-9\u00C0-\u024F\u0370-\u052F][A-Za-z0-9\u00C0-\u024F\u0300-\u052F._%+-]*)@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), _email),
    ("secret", re.compile(r"(?P<lead>\b(?:token|secret|api[_-]?key|password)\s*[=:]\s*[\"']?)(?P<hex>[0-9a-f]{16,})(?![0-9a-zA-Z])", re.I), _secret),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b"), _iban),
    ("card", re.compile(r"(?<![\w.+])[2-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w.-]*\d)|(?<![\w.+])3\d{3}[ -]?\d{6}[ -]?\d{5}(?!\w)"), _card),
    ("ipv4", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), _ipv4),
    ("date", re.compile(r"(?<![\w.])(?:(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})|(?P<d2>\d{1,2})(?P<s2>[-/.])(?P<m2>\d{1,2})(?P=s2)(?P<y2>\d{4}))(?![\w]|\.\d)"), _date),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), _ssn),
    ("phone", re.compile(r"(?<![\w.])(?:\+[1-9](?:[ .()-]{0,2}\d){7,14}|(?:\(0?\d{2,4}\)[ -]?|\d{2,4}[ -])\d{3}[ -]\d{2,4}(?:[ -]\d{2,4})?|(?:\(\d{3}\) ?|\d{3}\.)\d{3}\.\d{4})(?!\w|\.\d)"), _phone),
)
#: Where a match may end besides its own end, for kinds whose pattern can run on over what follows the value.
ENDS: dict[str, Callable[[re.Match], list[int]]] = {"iban": _iban_ends}
#: What a text must hold for any kind to match: digits, an address, or the name of a secret.
_MAYBE = re.compile(r"\d|@|token|secret|api[_-]?key|password", re.I)


def pseudonymize(text: str, feistel: Feistel) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with pseudonyms, and (kind, value, pseudonym) of each replaced value in the order of kinds and places."""
    if not _MAYBE.search(text):
        return text, []
    found: list[tuple[str, str, str]] = []
    pieces: list[tuple[bool, str]] = [(False, text)]
    for kind, pattern, make in KINDS:
        done: list[tuple[bool, str]] = []
        for fixed, piece in pieces:
            at, m = 0, None if fixed else pattern.search(piece)
            while m:
                next_ = m.start() + 1
                for end in ENDS[kind](m) if kind in ENDS else (m.end(),):
                    value = m if end == m.end() else pattern.fullmatch(piece, m.start(), end)
                    new = make(feistel, value) if value else None
                    if new is not None:
                        found.append((kind, value[0], new))
                        done += [(False, piece[at : value.start()]), (True, new)]
                        at = next_ = end
                        break
                m = pattern.search(piece, next_)
            done.append((fixed, piece[at:]))
        pieces = done
    return "".join(p for _, p in pieces), found


def pseudonymize_documents(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_values, kinds (sorted, distinct), pseudonyms (in order), new_text.

    A null or empty text has no values and comes back as an empty text. Null ids and repeated rows are kept; other
    columns are not read. Each row is worked on alone, so nothing is shuffled; the values themselves are not returned.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            for part in slices(batch, 1):
                texts, found = zip(*(pseudonymize(t or "", feistel) for t in part.column(1).to_pylist()))
                columns = [pa.array([len(f) for f in found], pa.int64()), pa.array([sorted({k for k, _, _ in f}) for f in found], pa.list_(pa.string())), pa.array([[p for _, _, p in f] for f in found], pa.list_(pa.string())), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[id_col, "n_values", "kinds", "pseudonyms", "new_text"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_values long, kinds array<string>, pseudonyms array<string>, new_text string")
