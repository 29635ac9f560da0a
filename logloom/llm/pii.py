"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text: at-signs, plus signs,
digits, URL schemes and identifier cues. Local parsers expand each anchor to
the boundaries of an address, number or account and validate it. Only the
surroundings of anchors are looked at again, so a text is read once.

Kinds email, ip, card and phone are leftmost, non-overlapping matches each; the
kinds url, iban, account and secret are added by schemes and cues.

Null text is empty. Rows are scanned one by one, whatever their number, order,
length or repetition; null ids are kept, and so are extra columns (spans,
n_<kind> and redacted replace columns of these names).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import unused

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "account", "secret")
KINDS = BASE + ADDED

#: What the automaton looks for beside '@', '+' and digits, in lower case.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:")
ACCOUNT_CUES = ("account no", "account number", "acct", "konto", "iban", "customer id", "passport", "ssn")
SECRET_CUES = ("token", "api_key", "api-key", "apikey", "secret", "password", "passwd")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_URL = re.compile(r"[^\s<>\"'`{}|\\^]+")
_AFTER_CUE = re.compile(r"""[\s:=#."'-]{1,6}""")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"[A-Z]{0,3}[0-9](?:[ -]?[0-9]){5,19}(?![A-Za-z0-9])")
_SECRET = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for char in "0123456789":
        out.add_word(char, ("digit", 1))
    out.add_word("@", ("email", 1))
    out.add_word("+", ("phone", 1))
    for kind, words in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for word in words:
            out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    value = 0
    for char in iban[4:] + iban[:4]:
        value = (value * (100 if char.isalpha() else 10) + int(char, 36)) % 97
    return value == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


class _Scan:
    """One text's spans; `ends` holds where the last match of a kind ended, kept or dropped."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int, int]] = []  # start, kind's number, end
        self.ends = dict.fromkeys(KINDS, 0)
        self.digits_to = 0
        self.plain_to = 0  # end of a secret's run that holds no digit

    def keep(self, kind: str, start: int, end: int) -> None:
        self.spans.append((start, KINDS.index(kind), end))

    def email(self, at: int) -> None:
        text, start, least = self.text, at, self.ends["email"]
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            self.ends["email"] = found.end()
            self.keep("email", start, found.end())

    def digit(self, at: int) -> None:
        # Card chains are maximal, so the first digit past the last one starts the next.
        if at >= self.ends["card"]:
            self.ends["card"] = at + 1
            if found := _CHAIN.match(self.text, at):
                self.ends["card"] = found.end()
                digits = found.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    self.keep("card", at, found.end())
        # A quad that fails from the first digit of a run fails from the others.
        if at >= self.ends["ip"] and at >= self.digits_to:
            if found := _QUAD.match(self.text, at):
                self.ends["ip"] = found.end()
                if all(map(_octet, found.group().split("."))):
                    self.keep("ip", at, found.end())
            else:
                self.digits_to = _DIGITS.match(self.text, at).end()

    def phone(self, at: int) -> None:
        if at >= self.ends["phone"] and (found := _PHONE.match(self.text, at)):
            self.ends["phone"] = found.end()
            if 10 <= sum(map(str.isdigit, found.group())) <= 15:
                self.keep("phone", at, found.end())

    def url(self, start: int, end: int) -> None:
        if start < self.ends["url"] or start and self.text[start - 1].isalnum():
            return
        if found := _URL.match(self.text, end):
            to = end + len(found.group().rstrip(".,;:!?)]*#$%&"))
            if to > end:
                self.ends["url"] = to
                self.keep("url", start, to)

    def _value(self, start: int, end: int) -> int:
        """Where a cue's value may start, or -1; the cue must be a word."""
        if start and self.text[start - 1].isalnum():
            return -1
        found = _AFTER_CUE.match(self.text, end)
        return found.end() if found else -1

    def account(self, start: int, end: int) -> None:
        at = self._value(start, end)
        if at < self.ends["iban"] or at < self.ends["account"] or at < 0:
            return
        if found := _IBAN.match(self.text, at):
            # The longest reading whose check digits hold.
            whole = found.group()
            for length in range(len(whole), 14, -1):
                iban = whole[:length].replace(" ", "")
                if whole[length - 1] != " " and 15 <= len(iban) <= 34 and mod97(iban):
                    self.ends["iban"] = at + length
                    self.keep("iban", at, at + length)
                    return
        if found := _ACCOUNT.match(self.text, at):
            self.ends["account"] = found.end()
            self.keep("account", at, found.end())

    def secret(self, start: int, end: int) -> None:
        at = self._value(start, end)
        if at < self.ends["secret"] or at < self.plain_to or at < 0:
            return
        found = _SECRET.match(self.text, at)
        # A word is not a secret: it takes digits. A later cue in the same run finds none either.
        if found and any(map(str.isdigit, found.group())):
            self.ends["secret"] = found.end()
            self.keep("secret", at, found.end())
        elif found:
            self.plain_to = found.end()


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in code points, by start, then kind."""
    scan = _Scan(text)
    # Lower-casing must not move positions.
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for last, (kind, length) in _automaton().iter(lower):
        if kind == "digit":
            if text[last] == lower[last]:
                scan.digit(last)
        elif kind == "email":
            scan.email(last)
        elif kind == "phone":
            scan.phone(last)
        else:
            getattr(scan, kind)(last + 1 - length, last + 1)
    return sorted(scan.spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each stretch of overlapping spans becomes [KIND] of its first span."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(out) + text[at:]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def pii(docs: DataFrame, text_col: str = "text", redacted: bool = False) -> DataFrame:
    """Add spans array<struct<kind, start, end>>, n_<kind> of the base kinds, and
    redacted (the text with its spans replaced) if asked for."""
    rest = [c for c in docs.columns if c not in ("spans", "redacted", *(f"n_{k}" for k in BASE))]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("spans", SPANS)] + [T.StructField("redacted", T.StringType())] * redacted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.columns[-1].to_pylist()]
            found = [find_spans(x) for x in texts]
            named = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in found]
            columns = [*batch.columns[:-1], pa.array(named, _ARROW_SPANS)]
            if redacted:
                columns.append(pa.array([redact(t, s) if s else t for t, s in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text_col).alias(unused(docs, "_text")[0])).mapInArrow(run, schema)
    kinds = F.transform("spans", lambda s: s["kind"])
    return out.withColumns({f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in BASE})


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
