"""Personal data as format-preserving pseudonyms.

Candidates are found by pattern and validated (check digits, number ranges, calendar). Each valid
value becomes a number below the size of its format, goes through a keyed permutation of that range
(a Feistel network with cycle walking) and is written back in the same format, with its check digits
made anew. So equal values stay equal in every document, different ones stay different, and only the
key leads back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The session's setting that holds the key; by this name Spark shows it nowhere.
KEY_SETTING = "spark.filing_jobs.pseudonym.secret"
ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Feistel:
    """Keyed permutations of 0..size-1, one for each name."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()

    def _run(self, value: int, size: int, name: str, rounds: range) -> int:
        half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        mask, width = (1 << half) - 1, (half + 7) // 8
        salt = f"{name}/{size}/".encode()
        backwards = rounds.step < 0
        while True:  # walk until the value is in range: the network permutes a power of four below 4 * size
            a, b = value >> half, value & mask
            for r in rounds:
                if backwards:
                    a, b = b ^ self._mix(salt, r, a, width, mask), a
                else:
                    a, b = b, a ^ self._mix(salt, r, b, width, mask)
            value = a << half | b
            if value < size:
                return value

    def _mix(self, salt: bytes, r: int, x: int, width: int, mask: int) -> int:
        digest = hashlib.blake2b(salt + bytes([r]) + x.to_bytes(width, "big"), key=self.key, digest_size=max(8, width)).digest()
        return int.from_bytes(digest, "big") & mask

    def permute(self, value: int, size: int, name: str) -> int:
        return self._run(value, size, name, range(ROUNDS)) if size > 1 else value

    def restore(self, value: int, size: int, name: str) -> int:
        return self._run(value, size, name, range(ROUNDS - 1, -1, -1)) if size > 1 else value


def luhn(digits: str) -> int:
    """The digit that completes ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def fill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in text)


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def characters(text: str, change: Callable[[int, int, str], int], name: str) -> str:
    """Digits become digits, letters letters of the same case; everything else stays."""
    value, size, kinds = 0, 1, [next((k for k in (DIGITS, LOWER, UPPER) if c in k), "") for c in text]
    for c, kind in zip(text, kinds, strict=True):
        if kind:
            value, size = value * len(kind) + kind.index(c), size * len(kind)
    value = change(value, size, name)
    out = []
    for c, kind in zip(reversed(text), reversed(kinds), strict=True):
        if kind:
            value, at = divmod(value, len(kind))
            c = kind[at]
        out.append(c)
    return "".join(reversed(out))


def card(text: str, change: Callable) -> str | None:
    digits = only_digits(text)
    if not 13 <= len(digits) <= 19 or int(digits[-1]) != luhn(digits[:-1]) or len(set(digits)) == 1:
        return None
    body = digits[1:-1]  # the first digit, which names the network, stays
    new = digits[0] + str(change(int(body), 10 ** len(body), f"card{digits[0]}")).zfill(len(body))
    return fill(text, new + str(luhn(new)))


#: Fixed values. Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def iban(text: str, change: Callable) -> str | None:
    """Of a country's length, without blanks or with one after every four characters."""
    plain = text.replace(" ", "")
    if len(plain) != IBAN_LENGTHS.get(plain[:2]) or text not in (plain, " ".join(plain[k : k + 4] for k in range(0, len(plain), 4))):
        return None
    number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    if int(number) % 97 != 1:
        return None
    body = characters(plain[4:], change, f"iban{plain[:2]}")
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    it = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(it) for c in text)


def social(text: str, change: Callable) -> str | None:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = (int(x) for x in text.split("-"))
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    value = change(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "social")
    rest, serial = divmod(value, 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


#: Addresses that are no one's: unspecified, this machine, broadcast.
NO_ONE = (0, 0x7F000001, 0xFFFFFFFF)


def address(text: str, change: Callable) -> str | None:
    """IPv4, but for those that are no one's. One with leading zeros becomes another one with leading zeros, of the same widths."""
    parts = text.split(".")
    value = [int(x) for x in parts]
    if max(value) > 255 or int.from_bytes(bytes(value), "big") in NO_ONE:
        return None
    if text == ".".join(map(str, value)):
        number = int.from_bytes(bytes(value), "big")
        number = change(number - sum(x < number for x in NO_ONE), (1 << 32) - len(NO_ONE), "address")
        for x in NO_ONE:
            number += number >= x
        return ".".join(map(str, number.to_bytes(4, "big")))
    sizes = [min(256, 10 ** len(x)) for x in parts]
    number = 0
    for v, size in zip(value, sizes, strict=True):
        number = number * size + v
    while True:  # walk on to one with leading zeros
        number = change(number, prod(sizes), "address" + "".join(str(len(x)) for x in parts))
        rest, new = number, []
        for size in reversed(sizes):
            rest, v = divmod(rest, size)
            new.append(v)
        out = ".".join(str(v).zfill(len(x)) for v, x in zip(reversed(new), parts, strict=True))
        if out != ".".join(map(str, reversed(new))) and int.from_bytes(bytes(reversed(new)), "big") not in NO_ONE:
            return out


#: Fixed values. Country codes of two digits; 1 and 7 are codes of one digit, all others have three.
TWO_DIGITS = (20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58, 60, 61, 62, 63, 64, 65, 66, 81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98)


def country_code(digits: str) -> str:
    return digits[:1] if digits[0] in "17" else digits[:2] if int(digits[:2]) in TWO_DIGITS else digits[:3]


def phone(text: str, change: Callable) -> str | None:
    """The country code of an international number stays. A number of ten digits without code, or with code 1, has the
    same pseudonym in all its spellings."""
    digits = only_digits(text)
    national = digits[1:] if digits[0] == "1" and len(digits) == 11 else digits
    if len(national) == 10 and (text[0] != "+" or len(digits) == 11):
        return fill(text, digits[: len(digits) - 10] + str(change(int(national), 10**10, "phone1")).zfill(10))
    if text[0] != "+" or not 10 <= len(digits) <= 15:
        return None
    code = country_code(digits)
    body = digits[len(code) :]
    if code == "1":  # of another length than numbers with this code have
        return None
    return fill(text, code + str(change(int(body), 10 ** len(body), f"phone{code}")).zfill(len(body)))


def date(text: str, change: Callable) -> str | None:
    """Calendar days of 1900 to 2099, year first or last.

    A spelling that can be read with the day first is. Days up to the twelfth stay such days and later ones
    later ones, so the new spelling is read as the old one was, and a day has one pseudonym in all spellings.
    """
    mark = next(c for c in text if c not in DIGITS)
    parts = text.split(mark)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)
    try:
        day = datetime.date(*(int(parts[k]) for k in order)).toordinal()
    except ValueError:
        if order == (0, 1, 2):
            return None
        order = (2, 0, 1)  # month first
        try:
            day = datetime.date(*(int(parts[k]) for k in order)).toordinal()
        except ValueError:
            return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    early, number = datetime.date.fromordinal(day).day <= 12, day - FIRST_DAY
    while True:  # walk on to a day of the same half
        number = change(number, LAST_DAY - FIRST_DAY + 1, "date")
        new = datetime.date.fromordinal(FIRST_DAY + number)
        if (new.day <= 12) == early:
            break
    out = ["", "", ""]
    for k, value in zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"), strict=True):
        out[k] = value
    return mark.join(out)


def email(text: str, change: Callable) -> str | None:
    """The local part changes; the domain stays."""
    local, _, domain = text.partition("@")
    return f"{characters(local, change, 'email' + domain.lower())}@{domain}"


def secret(text: str, change: Callable) -> str | None:
    """Keys and passwords: what follows the known beginning changes."""
    head, body = re.match(r"(AKIA|gh[a-z]_|sk-|(?:[A-Za-z_]+) ?[=:] ?[\"']?)(.*)", text, re.DOTALL).groups()
    return head + characters(body, change, "secret")


#: Kinds in the order in which they are tried at a place. Each pattern begins where no longer word or number would be cut.
KINDS: dict[str, tuple[str, Callable]] = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,63})@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}", email),
    "secret": (r"\bAKIA[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,255}\b|\bsk-[A-Za-z0-9]{20,}|\b(?:[Pp]assword|[Tt]oken|[Ss]ecret|[Aa]pi_?[Kk]ey) ?[=:] ?[\"']?[A-Za-z0-9]{8,}", secret),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    "date": (r"(?<![\d.])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\d]|[./-]\d)", date),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    "address": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", address),
    "card": (r"(?<![\d.+])(?:\d{13,19}|\d{4}(?:(?: \d{4}){3}|(?:-\d{4}){3}| \d{6} \d{4,5}|-\d{6}-\d{4,5}))(?!\d|\.\d)", card),
    "phone": (r"(?<![\w.])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)|(?<![\w.])\+(?!1)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w.])(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])", phone),
}
PATTERN = re.compile("|".join(f"(?P<{name}>{pattern})" for name, (pattern, _) in KINDS.items()), re.ASCII)
PATTERNS = {name: re.compile(pattern, re.ASCII) for name, (pattern, _) in KINDS.items()}
#: Where an IBAN or an international telephone number may end inside its longest match: never inside a word or a number.
ENDS = {"iban": re.compile(r"(?<=[A-Z0-9]) "), "phone": re.compile(r"(?<=[0-9])[ .-]")}
TOKEN = re.compile(r"[^A-Za-z0-9]+")
#: Every kind has one of these; most texts have none.
HINT = re.compile(r"[0-9@]|AKIA|gh[pousr]_|sk-|[Pp]assword|[Tt]oken|[Ss]ecret|[Aa]pi_?[Kk]ey")


def pseudonymise(text: str, cipher: Feistel, back: bool = False) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds found in order; ``back`` restores the values."""
    if not HINT.search(text):
        return text, []
    found: list[str] = []
    change = cipher.restore if back else cipher.permute

    out, at, low = [], 0, 0
    while m := PATTERN.search(text, low):
        kind, end, new = valid(text, m, change)
        if new is None:
            low = next_token(text, m)
            continue
        out += text[at : m.start()], new
        at = low = end
        found.append(kind)
    return "".join([*out, text[at:]]), found


def same(value: int, size: int, name: str) -> int:
    return value


def ends_of(name: str, text: str, start: int, end: int) -> list[int]:
    """Where a value that matches up to ``end`` may end, in the order in which it is tried.

    An IBAN or an international number may end at a whole word before that. Such a number ends before another value
    that begins inside its match: digits after a blank may as well be the next number, date or address.
    """
    if name not in ENDS or (name == "phone" and text[start] != "+"):
        return [end]
    inner = [k for k in range(start + 1, end) if ENDS[name].match(text, k)]
    if name == "phone":
        others = (k for k in inner if text[k] == " " and any(other_begins(n, text, k + 1) for n in KINDS))
        cut = next((k for k in others if phone(text[start:k], same) is not None), None)
        if cut is not None:
            return [cut]
    return [end, *reversed(inner)]


def other_begins(name: str, text: str, at: int) -> bool:
    m = PATTERNS[name].match(text, at)
    return m is not None and any(KINDS[name][1](text[at:e], same) is not None for e in ([m.end()] if name != "iban" else ends_of(name, text, at, m.end())))


def valid(text: str, m: re.Match, change: Callable) -> tuple[str, int, str | None]:
    """The kind, the end and the new value of what begins where ``m`` does; no value if nothing there is valid.

    Its own kind first, then later ones.
    """
    start = m.start()
    for name in list(KINDS)[list(KINDS).index(m.lastgroup) :]:
        own = PATTERNS[name].match(text, start)
        if own is None:
            continue
        for end in ends_of(name, text, start, own.end()):
            new = KINDS[name][1](text[start:end], change)
            if new is not None:
                return name, end, new
    return m.lastgroup, m.end(), None


def next_token(text: str, m: re.Match) -> int:
    """Where a candidate that is not valid is searched again: at its next token."""
    token = TOKEN.search(text, m.start(), m.end())
    return token.end() if token else m.end()


def session_key(spark: SparkSession) -> str:
    """The key in KEY_SETTING. Where it is unset, a random one is made and set: values are linked in this session alone."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonyms(df: DataFrame, *, key: str, text_col: str = "text", kinds_col: str = "pii_kinds", count_col: str = "pii_count") -> DataFrame:
    """All rows and columns of ``df`` with the text's personal data replaced, and what was found.

    Null stays null with no kinds; texts without valid personal data stay as they are. Repeated rows stay
    repeated, an empty table stays empty. Adds ``kinds_col`` (distinct, sorted) and ``count_col``; columns
    of those names are replaced.
    """
    if not key:
        raise ValueError("a key is needed")
    fields = [f for f in df.schema.fields if f.name not in (kinds_col, count_col)]
    at = [f.name for f in fields].index(text_col)
    inner = df.select(*(df[f"`{f.name}`"].alias(f"c{k}") for k, f in enumerate(fields)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Feistel(key)
        for batch in batches:
            done = [(t, []) if t is None else pseudonymise(t, cipher) for t in batch[f"c{at}"].to_pylist()]
            columns = [pa.array([t for t, _ in done], pa.string()) if k == at else batch[f"c{k}"] for k in range(len(fields))]
            kinds = pa.array([sorted(set(x)) for _, x in done], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, kinds, pa.array([len(x) for _, x in done], pa.int64())], [*(f"c{k}" for k in range(len(fields))), "kinds", "n"])

    schema = ", ".join([*(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(fields)), "kinds array<string>", "n long"])
    return inner.mapInArrow(run, schema).toDF(*(f.name for f in fields), kinds_col, count_col)
