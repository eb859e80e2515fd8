"""Personal data: validated values replaced by format-preserving Feistel pseudonyms."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import string
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns

ROUNDS = 8
# Characters permuted as one number; a longer text is permuted piece by piece.
PIECE = 64
# Dates are permuted among these days.
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

FIELDS = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("n_pii", T.LongType()), T.StructField("pii_kinds", T.StringType()),
])

# A text without any of these characters holds nothing that PATTERN finds.
GATE = re.compile(r"[0-9@=:]")
# A value ends and begins where its own alphabet does: letters of other scripts and '_' may touch it.
_END = r"(?![A-Za-z0-9])"
_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = r"(?:(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in _MONTHS) + r"|sept)\.?)"
# Secret names may be parts of longer ones.
_SECRET = r"(?P<secret>(?i:password|passwd|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?(?P<value>[^\s\"'<>&#*$%|,;]{5,}[^\s\"'<>&#*$%|,;.:!?()]))"
_LETTERS = (
    rf"(?P<key>(?:AKIA|ASIA)[A-Z0-9]{{16}}{_END}|(?:ghp|gho|ghs)_[A-Za-z0-9]{{36}}{_END}|sk[-_][A-Za-z0-9_-]{{20,}})",
    rf"(?P<iban>[A-Z]{{2}}\d\d(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END})",
    rf"(?P<named>{_MONTH} ?\d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}{_END})",
)
_FIGURES = (
    rf"(?P<ip>(?<!\.)\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?![A-Za-z0-9]|\.\d))",
    r"(?P<iso>\d{4}(?P<sep0>[/.-])\d{1,2}(?P=sep0)\d{1,2}(?!\d|(?P=sep0)\d))",
    r"(?P<day>(?<![/.])\d{1,2}(?P<sep>[/.])\d{1,2}(?P=sep)\d{4}(?![A-Za-z0-9/]))",
    r"(?P<dashed>(?<!-)\d{1,2}-\d{1,2}-\d{4}(?![A-Za-z0-9-]))",
    rf"(?P<named2>\d{{1,2}}(?:st|nd|rd|th)?\.?[ -](?:of )?{_MONTH},?[ -]\d{{4}}{_END})",
    r"(?P<ssn>(?<!-)\d{3}-\d\d-\d{4}(?![A-Za-z0-9-]))",
    rf"(?P<nanp>(?<!\()(?:\+?1[ .-]?)?(?:\(\d{{3}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}{_END})",
    rf"(?P<phone>(?<!\+)(?:\+|00)\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{1,4}}(?:[ .-]?\d{{2,4}}){{1,4}}{_END})",
    r"(?P<card>(?<!-)(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{5})(?![A-Za-z0-9-]))",
    # A national number: trunk prefix 0, or a mobile one as in China.
    r"(?P<national>(?:(?:\(0[1-9]\d{0,3}\)|0[1-9]\d{0,3})(?:[ ./-]|(?<=\)))\d{2,8}(?:[ .-]\d{2,4}){0,4}|0[1-9]\d{8,9}|1[3-9]\d(?:[ -]?\d{4}){2})(?![A-Za-z0-9/]|[.-]\d))",
)
# A match begins outside a run of its own alphabet, which most places of a text do not; secret names begin anywhere.
PATTERN = re.compile(
    r"(?:(?=[PpSsTtAa])" + _SECRET + r"|(?<![A-Za-z0-9])(?:(?=[A-Za-z])(?:" + "|".join(_LETTERS) + r")|(?=[0-9+(])(?:" + "|".join(_FIGURES)
    + r")|(?P<email>(?<![.+%_-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9]))))")

_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
_HEX = "0123456789abcdef"


class Pseudonyms:
    """Keyed permutations of values, within the format of each."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, sizes: tuple[int, int], value: int, size: int) -> int:
        said = f"{kind}|{n}|{sizes[0]:x}|{sizes[1]:x}|{value:x}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=64).digest(), "big") % size

    def _feistel(self, kind: str, value: int, sizes: tuple[int, int], back: bool) -> int:
        """A permutation of the numbers below sizes[0] * sizes[1], or its inverse."""
        halves = list(divmod(value, sizes[1]))
        for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
            side = n % 2
            shift = self._round(kind, n, sizes, halves[1 - side], sizes[side])
            halves[side] = (halves[side] + (-shift if back else shift)) % sizes[side]
        return halves[0] * sizes[1] + halves[1]

    def number(self, kind: str, value: int, size: int, sizes: tuple[int, int] | None = None) -> int:
        """The pseudonym of a number below size: the next one in an order that the key gives, so never itself.

        Without halves the nearest square is permuted, and numbers beyond size are walked over.
        """
        root = math.isqrt(size - 1) + 1
        sizes = sizes or (root, root)
        place = self._walk(kind, value, size, sizes, False)
        return self._walk(kind, (place + 1) % size, size, sizes, True)

    def _walk(self, kind: str, value: int, size: int, sizes: tuple[int, int], back: bool) -> int:
        value = self._feistel(kind, value, sizes, back)
        while value >= size:
            value = self._feistel(kind, value, sizes, back)
        return value

    def digits(self, kind: str, values: list[int], radix: list[int]) -> list[int]:
        """Permute a mixed-radix number of single figures."""
        if len(values) < 2:
            return [self.number(kind, v, r) for v, r in zip(values, radix, strict=True)]
        middle = len(values) // 2
        sizes, number = [1, 1], 0
        for n, (v, r) in enumerate(zip(values, radix, strict=True)):
            number = number * r + v
            sizes[n >= middle] *= r
        number = self.number(kind, number, sizes[0] * sizes[1], (sizes[0], sizes[1]))
        out = []
        for r in reversed(radix):
            number, v = divmod(number, r)
            out.append(v)
        return out[::-1]

    def characters(self, kind: str, text: str) -> str:
        """Permute letters and digits, each within its alphabet; all else stays."""
        if len(text) >= 8 and not set(text) - set(_HEX):
            alphabets = {c: _HEX for c in _HEX}
        else:
            alphabets = {c: a for a in _ALPHABETS for c in a}
        places = [k for k, c in enumerate(text) if c in alphabets]
        own = [alphabets[text[k]] for k in places]
        out = list(text)
        made: list[int] = []
        for start in range(0, len(places), PIECE):
            part = slice(start, start + PIECE)
            made += self.digits(kind, [a.index(text[k]) for k, a in zip(places[part], own[part], strict=True)], [len(a) for a in own[part]])
        for k, a, v in zip(places, own, made, strict=True):
            out[k] = a[v]
        return "".join(out)


def _refill(shape: str, digits: str) -> str:
    """shape with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in shape)


def luhn_digit(payload: str) -> str:
    total = 0
    for n, c in enumerate(reversed(payload)):
        v = int(c) * (1 if n % 2 else 2)
        total += v - 9 if v > 9 else v
    return str(-total % 10)


def _card(text: str, names: Pseudonyms) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    # The first digit tells the kind of card and stays; the check digit is made anew.
    body = digits[0] + "".join(map(str, names.digits("card", [int(c) for c in digits[1:-1]], [10] * (len(digits) - 2))))
    return _refill(text, body + luhn_digit(body))


def _iban_rest(text: str) -> int:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def _iban(text: str, names: Pseudonyms) -> str | None:
    """The number, or its longest valid beginning that ends at a blank: the words after it may look like more groups."""
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
        shorter, blank, _ = text.rpartition(" ")
        return _iban(shorter, names) if blank else None
    body = names.characters("iban", plain[4:])
    made = plain[:2] + f"{98 - _iban_rest(plain[:2] + '00' + body):02d}" + body
    fresh = iter(made)
    return "".join(c if c == " " else next(fresh) for c in text)


def _ip(text: str, names: Pseudonyms) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    return ".".join(map(str, names.digits("ip", parts, [256] * 4)))


def _day(value: date, names: Pseudonyms) -> date | None:
    if not FIRST_DAY <= value.toordinal() <= LAST_DAY:
        return None
    return date.fromordinal(FIRST_DAY + names.number("date", value.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1))


def _iso(text: str, names: Pseudonyms) -> str | None:
    sep = text[4]
    year, month, day = text.split(sep)
    try:
        made = _day(date(int(year), int(month), int(day)), names)
    except ValueError:
        return None
    wide = 2 if len(text) == 10 else 1
    return made and f"{made.year}{sep}{made.month:0{wide}d}{sep}{made.day:0{wide}d}"


def _named(text: str, names: Pseudonyms) -> str | None:
    """A date with the name of its month, which stays as short or long, and as large, as it was."""
    said = re.search(r"(?!st|nd|rd|th|of)[A-Za-z]{3,}", text)
    month = next(n for n, m in enumerate(_MONTHS, 1) if m[:3].lower() == said[0][:3].lower())
    day, year = (re.search(p, text) for p in (r"(?<!\d)\d{1,2}(?!\d)", r"\d{4}"))
    try:
        made = _day(date(int(year[0]), month, int(day[0])), names)
    except ValueError:
        return None
    if made is None:
        return None
    name = _MONTHS[made.month - 1]
    name = name if len(said[0]) > 4 or said[0].lower() == _MONTHS[month - 1].lower() else name[:3]
    name = name.upper() if said[0].isupper() else name.lower() if said[0].islower() else name
    wide = 2 if day[0].startswith("0") else 1
    parts = sorted([(said.span(), name), (day.span(), f"{made.day:0{wide}d}"), (year.span(), str(made.year))], reverse=True)
    for (start, end), new in parts:
        text = text[:start] + new + text[end:]
    ending = "th" if 11 <= made.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(made.day % 10, "th")
    return re.sub(r"(?<=\d)(?:st|nd|rd|th)", ending, text)


def _written(text: str, names: Pseudonyms) -> str | None:
    """Day and month in the order that is possible; with a stroke the month comes first if both are, with a point or dash the day."""
    sep = next(c for c in text if not c.isdigit())
    a, b, year = (int(p) for p in text.split(sep))
    for day, month in ((b, a), (a, b)) if sep == "/" else ((a, b), (b, a)):
        try:
            made = _day(date(year, month, day), names)
        except ValueError:
            continue
        if made is None:
            return None
        first, second = (made.day, made.month) if day == a and month == b else (made.month, made.day)
        wide = 2 if len(text) == 10 else 1
        return f"{first:0{wide}d}{sep}{second:0{wide}d}{sep}{made.year}"
    return None


def _ssn(text: str, names: Pseudonyms) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = area - 1 - (area > 666)
    area, group, serial = names.digits("ssn", [rank, group - 1, serial - 1], [898, 99, 9999])
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _nanp(text: str, names: Pseudonyms) -> str | None:
    digits = re.sub(r"\D", "", text)
    lead, own = digits[:-10], digits[-10:]
    if own[0] in "01" or own[3] in "01":
        return _national(text, names) if not lead and own[0] == "0" and own[1] != "0" else None
    radix = [8, 10, 10, 8, 10, 10, 10, 10, 10, 10]
    low = [2, 0, 0, 2, 0, 0, 0, 0, 0, 0]
    made = names.digits("nanp", [int(c) - o for c, o in zip(own, low, strict=True)], radix)
    return _refill(text, lead + "".join(str(v + o) for v, o in zip(made, low, strict=True)))


def _phone(text: str, names: Pseudonyms) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    # The first two digits are the region's and stay.
    made = names.digits("phone", [int(c) for c in digits[2:]], [10] * (len(digits) - 2))
    return _refill(text, digits[:2] + "".join(map(str, made)))


def _national(text: str, names: Pseudonyms) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 9 <= len(digits) <= 12:
        return None
    # The trunk prefix and the first digit of the area stay.
    made = names.digits("national", [int(c) for c in digits[2:]], [10] * (len(digits) - 2))
    return _refill(text, digits[:2] + "".join(map(str, made)))


def _email(text: str, names: Pseudonyms) -> str | None:
    local, domain = text.rsplit("@", 1)
    return f"{names.characters('email', local)}@{domain}"


def _key(text: str, names: Pseudonyms) -> str | None:
    head = 4
    return text[:head] + names.characters("key", text[head:])


HANDLERS = {
    "key": _key, "email": _email, "iban": _iban, "ip": _ip, "iso": _iso, "day": _written, "dashed": _written,
    "named": _named, "named2": _named, "ssn": _ssn,
    "nanp": _nanp, "phone": _phone, "national": _national, "card": _card,
}


# The kind of a pattern, where it has another name.
KINDS = {**dict.fromkeys(("iso", "day", "dashed", "named", "named2"), "date"), **dict.fromkeys(("nanp", "national"), "phone")}


def pseudonymize(text: str, names: Pseudonyms) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds of what was replaced."""
    kinds: list[str] = []
    if not GATE.search(text):
        return text, kinds

    parts, place = [], 0
    match = PATTERN.search(text)
    while match:
        kind, found, end = next(k for k in ("secret", *HANDLERS) if match[k]), match[0], match.end()
        if kind == "secret":
            value = match["value"]
            made = found[:match.start("value") - match.start()] + names.characters("secret", value) + found[match.end("value") - match.start():]
        else:
            made = HANDLERS[kind](found, names)
        if kind == "iban":
            # What is not part of it may hold another value.
            end = match.start() + (len(made) if made else len(found.split(" ")[0]))
        if made is not None:
            parts += [text[place:match.start()], made]
            place = end
            kinds.append(KINDS.get(kind, kind))
        match = PATTERN.search(text, end)
    return "".join([*parts, text[place:]]), kinds


@functools.lru_cache(maxsize=4)
def _names(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


def protect(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """docs with the text pseudonymized, n_pii and pii_kinds (sorted, comma-joined).

    Numbers are replaced only where they are valid (Luhn, IBAN remainder, octets, calendar days, number
    plans), and by valid ones of the same format; mail names and keys keep the class of each character.
    A value has one pseudonym under a key, however often and in however many documents it stands, and
    the pseudonym is never the value. Null and empty texts stay as they are, with n_pii 0.
    """
    fields = T.StructType([T.StructField(text, T.StringType()), *FIELDS.fields[1:]])

    def work(texts: pa.Array) -> dict[str, object]:
        rows = [(None, []) if t is None else pseudonymize(t, _names(key)) for t in texts.to_pylist()]
        return {text: [r[0] for r in rows], "n_pii": [len(r[1]) for r in rows],
                "pii_kinds": [",".join(sorted(set(r[1]))) for r in rows]}

    order = [c for c in docs.columns if c.lower() not in ("n_pii", "pii_kinds")]
    return add_columns(docs, text, fields, work).select(*[f"`{c}`" for c in order], "n_pii", "pii_kinds")
