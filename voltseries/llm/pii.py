"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A value is found by its pattern and validated (Luhn, mod 97, octets, calendar, digit
counts). It is read as a number within its format, permuted by a keyed Feistel network
over that range, and written back: separators, country codes, letter case and length
stay, check digits are made right again. One key gives equal values equal pseudonyms in
every document, and ``restore`` undoes them.

Cards and accounts are found beside other digits and words too: where a reading fails, its
shorter ones that end at a separator and then the later starts are tried. If the pseudonym
would by chance make a reading valid that failed before, it is permuted again; only then
does it differ from that of the same value elsewhere.

Values that fail validation, and all other text, are left as they are. Defined cases: a
null text stays null; null ids and repeated rows are kept; all other columns pass through
unchanged; a text of any length is handled whole.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python

ROUNDS = 10
DEFAULT_KEY = b"voltseries"  # a parameter; keep a real one secret
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
PIECE = 40  # signs permuted as one number
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


@lru_cache(maxsize=100_000)
def permuted(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of 0 … size - 1.

    The number is split in two digits of about the square root of the range; rounds add
    a keyed hash of one to the other. A result beyond the range is permuted again.
    """
    if size < 2:
        return value
    right = int(size**0.5) + 1
    left = -(-size // right)

    def mask(step: int, half: int) -> int:
        data = f"{kind}|{size}|{step}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest(), "big")

    while True:
        a, b = divmod(value, right)
        for step in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            add = mask(step, b if step % 2 == 0 else a) * (-1 if back else 1)
            if step % 2 == 0:
                a = (a + add) % left
            else:
                b = (b + add) % right
        value = a * right + b
        if value < size:
            return value


class Cipher:
    """The pseudonym of each kind of value, or the value itself if it is not valid."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back

    def number(self, value: int, size: int, kind: str) -> int:
        return permuted(value, size, self.key, kind, self.back)

    def digits(self, text: str, kind: str) -> str:
        return str(self.number(int(text), 10 ** len(text), kind)).zfill(len(text)) if text else text

    def signs(self, text: str, kind: str, alphabets: tuple[str, ...]) -> str:
        """Permute the signs that belong to an alphabet; all others keep their place.

        A long text is permuted in pieces, whose range one keyed hash covers.
        """
        if len(text) > PIECE:
            pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
            return "".join(self.signs(p, f"{kind} {i}" if i else kind, alphabets) for i, p in enumerate(pieces))
        own = [next((a for a in alphabets if c in a), "") for c in text]
        value, size = 0, 1
        for c, a in zip(text, own, strict=True):
            if a:
                value, size = value * len(a) + a.index(c), size * len(a)
        value, out = self.number(value, size, kind), []
        for c, a in zip(reversed(text), reversed(own), strict=True):
            if a:
                value, at = divmod(value, len(a))
                c = a[at]
            out.append(c)
        return "".join(reversed(out))

    def card(self, text: str) -> str:
        plain = re.sub(r"\D", "", text)
        if not 13 <= len(plain) <= 19 or luhn(plain) or len(set(plain)) == 1:
            return text
        body = plain[0] + self.digits(plain[1:-1], "card")
        return refill(text, body + str(-luhn(body + "0") % 10))

    def phone(self, text: str) -> str:
        plain = re.sub(r"\D", "", text)
        if not 8 <= len(plain) <= 15:
            return text
        # A written country code stays.
        code = len(re.match(r"\+?(\d*)", text)[1]) if text.startswith("+") else 0
        code = code if len(plain) - code >= 7 else max(0, len(plain) - 10)
        return refill(text, plain[:code] + self.digits(plain[code:], "phone"))

    def address(self, text: str) -> str:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255:
            return text
        value = self.number(int.from_bytes(bytes(octets), "big"), 2**32, "ip")
        return ".".join(str(x) for x in value.to_bytes(4, "big"))

    def social(self, text: str) -> str:
        def valid(plain: str) -> bool:
            return plain[:3] not in ("000", "666") and plain[0] != "9" and plain[3:5] != "00" and plain[5:] != "0000"

        plain = text.replace("-", "")
        if not valid(plain):
            return text
        while not valid(plain := self.digits(plain, "social")):
            pass
        return refill(text, plain)

    def account(self, text: str) -> str:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
            return text
        body = self.signs(plain[4:], "account", (DIGITS, UPPER))
        check = 98 - mod97(plain[:2] + "00" + body)
        return refill(text, f"{plain[:2]}{check:02d}{body}", r"[A-Z0-9]")

    def date(self, text: str) -> str:
        parts = re.split(r"([-./])", text)
        year_first = len(parts[0]) == 4
        try:
            numbers = [int(x) for x in parts[::2]]
            day = dt.date(*(numbers if year_first else reversed(numbers))).toordinal()
        except ValueError:
            return text
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return text
        # Days that need the written width are permuted among themselves.
        short = not year_first and (len(parts[0]) == 1 or len(parts[2]) == 1)
        new = dt.date.fromordinal(_FIRST_DAY + self.number(day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, "date"))
        if short:
            return f"{new.day}{parts[1]}{new.month}{parts[3]}{new.year}"
        order = (new.year, new.month, new.day) if year_first else (new.day, new.month, new.year)
        return "".join(f"{v:0{len(p)}d}{s}" for v, p, s in zip(order, parts[::2], [*parts[1::2], ""], strict=True))

    def email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        host, _, top = domain.rpartition(".")
        kinds = (LOWER, UPPER, DIGITS)
        return f"{self.signs(local, 'email', kinds)}@{self.signs(host, 'domain', kinds)}.{top}"

    def access_key(self, text: str) -> str:
        return text[:4] + self.signs(text[4:], "access key", (UPPER + DIGITS,))

    def secret(self, text: str) -> str:
        return self.signs(text, "secret", (HEX,)) if re.fullmatch(r"[0-9a-f]+", text) else self.signs(
            text, "secret", (LOWER, UPPER, DIGITS)
        )


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(twice[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def mod97(account: str) -> int:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def refill(text: str, signs: str, pattern: str = r"\d") -> str:
    """Put new signs in the places of the old ones, keeping separators."""
    new = iter(signs)
    return re.sub(pattern, lambda _: next(new), text)


# Patterns of values, other than cards, that start with a digit, a plus sign or a bracket.
_NUMBER = re.compile(
    r"(?P<address>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d))"
    r"|(?P<date>(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}([./])\d{1,2}\3\d{4})(?![\w-]|\.\d))"
    r"|(?P<social>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)"
    r"|(?<![\w)-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-]))",
    re.ASCII,
)
# Groups of digits that may hold cards, and the usual ways to group a card.
_DIGITS = re.compile(r"\d(?:[ -]?\d){12,}", re.ASCII)
_GROUP = re.compile(r"\d+", re.ASCII)
_CARD_GROUPS = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4)}
# A start consumes no digit that may start a value itself.
_START = re.compile(r"\+(?=\d)|\((?=\d)|\d+", re.ASCII)
_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w@])", re.ASCII)
_ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII)
_LONGEST = 43  # signs of an account with its blanks
_ACCESS_KEY = re.compile(r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)", re.ASCII)
_SECRET = re.compile(
    r"(?i:\b(?:token|password|passwd|secret|api_?key))\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_-]{8,})(?![A-Za-z0-9+/_-])"
)


Reading = tuple[tuple[int, ...], int, int]  # rank, start and end; the smallest rank is tried first


def _replaced(
    text: str,
    taken: list[Reading],
    rivals: Callable[[str, Reading], list[Reading]],
    valid: Callable[[str], bool],
    change: Callable[[str], str],
    back: bool,
) -> str:
    """The text with the taken readings changed, such that reading it again takes the same.

    A change may by chance make a reading valid that was tried before and was not. The
    value is then permuted again, as for results beyond a range, so ``back`` undoes it.
    Readings keep their length; the last change is undone first.
    """
    for one in reversed(taken) if back else taken:
        _, a, b = one
        near = rivals(text, one)
        while True:
            text = text[:a] + change(text[a:b]) + text[b:]
            if not any(valid(text[c:d]) for _, c, d in near):
                break
    return text


def _before(one: Reading, other: Reading) -> bool:
    """Whether one reading shares text with the other and is tried first."""
    return one[0] < other[0] and one[1] < other[2] and other[1] < one[2]


def _account_readings(text: str, start: int) -> Iterator[Reading]:
    """The longest account from a place on, and its shorter readings that end at a blank."""
    m = _ACCOUNT.match(text, start)
    while m:
        yield (start, -m.end()), start, m.end()
        blank = text.rfind(" ", start, m.end())
        m = _ACCOUNT.match(text, start, blank) if blank > 0 else None


def _accounts(text: str, cipher: Cipher, seen: dict[str, int] | None) -> tuple[str, list[tuple[int, int]]]:
    """The text with accounts replaced, and where they stand."""

    def valid(value: str) -> bool:
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and mod97(plain) == 1

    taken: list[Reading] = []
    m = _ACCOUNT.search(text)
    while m:
        found = next((r for r in _account_readings(text, m.start()) if valid(text[r[1] : r[2]])), None)
        if found:
            taken.append(found)
        m = _ACCOUNT.search(text, found[2] if found else m.start() + 1)

    def rivals(text: str, one: Reading) -> list[Reading]:
        first = max([r[2] for r in taken if r[2] <= one[1]], default=0)
        places = range(max(first, one[1] - _LONGEST), one[1] + 1)
        return [r for i in places for r in _account_readings(text, i) if _before(r, one)]

    if seen is not None and taken:
        seen["account"] = seen.get("account", 0) + len(taken)
    return _replaced(text, taken, rivals, valid, cipher.account, cipher.back), [r[1:] for r in taken]


def _card_readings(text: str, groups: list[tuple[int, int]], i: int) -> tuple[list[int], list[int]]:
    """Last groups of the cards that may start with group i: usually grouped ones, others.

    Of the usual ones the shorter is tried first, as a security code may follow a card;
    of the others the longer.
    """
    usual, other = [], []
    a = groups[i][0]
    if a and (text[a - 1] == "_" or text[a - 1].isascii() and text[a - 1].isalnum()):
        return usual, other
    sizes: list[int] = []
    for j in range(i, min(i + 19, len(groups))):
        c, d = groups[j]
        sizes.append(d - c)
        if sum(sizes) > 19:
            break
        after = text[d : d + 1]
        if sum(sizes) < 13 or after == "_" or after.isascii() and after.isalnum():
            continue
        if j == i or tuple(sizes) in _CARD_GROUPS and len({text[e] for _, e in groups[i:j]}) == 1:
            usual.append(j)
        else:
            other.insert(0, j)
    return usual, other


def _cards(text: str, cipher: Cipher, seen: dict[str, int] | None, spans: list[tuple[int, int]]) -> str:
    """Cards outside of the spans; every group of digits may start one."""

    def valid(value: str) -> bool:
        plain = re.sub(r"\D", "", value)
        return not luhn(plain) and len(set(plain)) > 1

    def run(text: str, groups: list[tuple[int, int]]) -> str:
        """Cards of neighbouring groups."""
        readings = [_card_readings(text, groups, i) for i in range(len(groups))]
        owner: list[Reading | None] = [None] * len(groups)
        taken: list[Reading] = []
        for kind in range(2):
            for i in range(len(groups)):
                for at, j in enumerate(readings[i][kind]):
                    a, b = groups[i][0], groups[j][1]
                    if not any(owner[i : j + 1]) and valid(text[a:b]):
                        taken.append(((kind, i, at), a, b))
                        owner[i : j + 1] = [taken[-1]] * (j + 1 - i)

        def rivals(_: str, one: Reading) -> list[Reading]:
            first = one[0][1]
            near = []
            for i in range(max(0, first - 18), len(groups)):
                if groups[i][0] >= one[2]:
                    break
                for kind in range(2):
                    for at, j in enumerate(readings[i][kind]):
                        r = ((kind, i, at), groups[i][0], groups[j][1])
                        if _before(r, one) and not any(o and o[0] < r[0] for o in owner[i : j + 1]):
                            near.append(r)
            return near

        if seen is not None and taken:
            seen["card"] = seen.get("card", 0) + len(taken)
        a, b = groups[0][0], groups[-1][1]
        # The digits alone are changed, so that a long text is not copied for every card.
        moved = [(r, c - a, d - a) for r, c, d in taken]
        return _replaced(
            text[a:b], moved, lambda t, o: [(r, c - a, d - a) for r, c, d in rivals(t, (o[0], o[1] + a, o[2] + a))],
            valid, cipher.card, cipher.back,
        )

    out, done, at = [], 0, 0
    for m in _DIGITS.finditer(text):
        groups: list[tuple[int, int]] = []
        parts = [groups]
        for g in _GROUP.finditer(text, m.start(), m.end()):
            while at < len(spans) and spans[at][1] <= g.start():
                at += 1
            if at < len(spans) and spans[at][0] < g.end():
                groups = []
                parts.append(groups)
            else:
                groups.append(g.span())
        for groups in parts:
            if groups:
                out += [text[done : groups[0][0]], run(text, groups)]
                done = groups[-1][1]
    return "".join([*out, text[done:]])


def _no_phone(change: Callable[[str], str], cipher: Cipher, after: str) -> Callable[[str], str]:
    """A change of a value after a plus sign, repeated until sign and value are no phone."""

    def one(value: str) -> str:
        while (value := change(value)) and (m := _NUMBER.match(f"+{value}{after}")) and cipher.phone(m[0]) != m[0]:
            pass
        return value

    return one


def pseudonymised(text: str, cipher: Cipher, seen: dict[str, int] | None = None) -> str:
    """The text with all valid values replaced; counts them by kind in ``seen``."""

    def swap(kind: str, change: Callable[[str], str]) -> Callable[[re.Match], str]:
        def one(m: re.Match) -> str:
            value = m[m.lastindex or 0] if kind == "secret" else m[0]
            new = change(value)
            if seen is not None and new != value:
                seen[kind] = seen.get(kind, 0) + 1
            return m[0][: len(m[0]) - len(value)] + new

        return one

    if "AKIA" in text:
        text = _ACCESS_KEY.sub(swap("access_key", cipher.access_key), text)
    if "=" in text or ":" in text:
        text = _SECRET.sub(swap("secret", cipher.secret), text)
    if "@" in text:
        text = _EMAIL.sub(swap("email", cipher.email), text)
    if _START.search(text):
        text, accounts = _accounts(text, cipher, seen)
        out, done, size, spans, at = [], 0, 0, [], 0

        def put(a: int, b: int, new: str) -> None:
            nonlocal done, size
            out.extend([text[done:a], new])
            size += a - done + len(new)
            spans.append((size - len(new), size))
            done = b

        for start in _START.finditer(text):
            while at < len(accounts) and accounts[at][1] <= start.start():
                put(*accounts[at], text[slice(*accounts[at])])
                at += 1
            if start.start() < done or not (m := _NUMBER.match(text, start.start())):
                continue
            if at < len(accounts) and m.end() > accounts[at][0]:
                continue
            kind = m.lastgroup or "date"
            change = getattr(cipher, kind)
            if kind != "phone" and text[m.start() - 1 : m.start()] == "+":
                change = _no_phone(change, cipher, text[m.end() : m.end() + 40])
            new = swap(kind, change)(m)
            if new != m[0]:
                put(m.start(), m.end(), new)
        for span in accounts[at:]:
            put(*span, text[slice(*span)])
        text = _cards("".join([*out, text[done:]]), cipher, seen, spans)
    return text


def _replacing(at: int, key: bytes, back: bool, count: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Cipher(key, back)
        for batch in batches:
            texts, kinds = [], []
            for text in batch.column(at).to_pylist():
                seen: dict[str, int] = {}
                texts.append(None if text is None else pseudonymised(text, cipher, seen))
                kinds.append(seen)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            names = list(batch.schema.names)
            if count:
                columns += [
                    pa.array([sum(s.values()) for s in kinds], pa.int64()),
                    pa.array([",".join(sorted(s)) for s in kinds], pa.string()),
                ]
                names += ["n_values", "kinds"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pseudonymise(docs: DataFrame, key: bytes = DEFAULT_KEY, count: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; with ``count`` also n_values and kinds."""
    ready_python(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = docs.schema
    if count:
        schema = docs.limit(0).withColumns({"n_values": F.lit(0).cast("long"), "kinds": F.lit("")}).schema
    return docs.mapInArrow(_replacing(docs.columns.index("text"), key, False, count), schema)


def restore(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """Undo ``pseudonymise`` for whoever holds the key."""
    ready_python(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_replacing(docs.columns.index("text"), key, True, False), docs.schema)
