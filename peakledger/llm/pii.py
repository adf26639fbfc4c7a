"""Personal data by anchor expansion: one Aho-Corasick pass finds at-signs, schemes, digits and cues; local parsers grow them.

Every parser is deterministic and looks at the neighbourhood of its anchor only. Anchors come in order of place and a parser never
goes back behind its last match, so its spans are the leftmost non-overlapping ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.shipping import by_value
from .common import arrow_pass

#: Kinds in the order in which spans are listed; the first four are defined by patterns, the others by a cue and a check.
KINDS = ("email", "ip", "card", "phone", "account", "login", "ssn")

# Characters and shapes of the spans.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DIGIT_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"://([^\s/@:?#]{1,64}):([^\s/@?#]{1,128})@")
AFTER_CUE = re.compile(r"[\x20:#=.]{1,3}(?:(?:no|nr|number|num)\b[\x20:#=.]{1,3})?", re.ASCII | re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){7,16}(?![A-Za-z0-9])")
SOCIAL = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
CUES = {"iban": "account", "account": "account", "acct": "account", "konto": "account", "cuenta": "account", "compte": "account", "ssn": "ssn"}

YEARS = range(1900, 2100)


def dated(text: str) -> bool:
    """Whether digits in groups are a date or years and no number of an account: 2024-01-15, 15 01 2024, 20240115, 2020-2021."""
    groups = [int(g) for g in re.split(r"[\x20-]", text)]
    if len(groups) == 1 and len(text) == 8:
        groups = [int(text[:4]), int(text[4:6]), int(text[6:])]
    if all(g in YEARS for g in groups):
        return True
    if len(groups) != 3:
        return False
    year, month, day = groups if groups[0] in YEARS else groups[::-1]
    return year in YEARS and (1 <= month <= 12 and 1 <= day <= 31 or 1 <= day <= 12 and 1 <= month <= 31)


Parser = Callable[[str, int, int], tuple[int, int, bool] | None]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else None


def _ip(text: str, dot: int, free: int) -> tuple[int, int, bool] | None:
    start = dot
    while start > free and text[start - 1] in DIGITS:
        start -= 1
    found = FOUR_PARTS.match(text, start) if start < dot else None
    return (start, found.end(), all(len(p := x.lstrip("0")) < 4 and int(p or 0) < 256 for x in found[0].split("."))) if found else None


def _card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = DIGIT_CHAIN.match(text, at) if at >= free else None
    if not found:
        return None
    digits = found[0].replace(" ", "").replace("-", "")
    return at, found.end(), 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = CALL.match(text, at) if at >= free else None
    return (at, found.end(), 8 <= sum(c in DIGITS for c in found[0]) <= 15) if found else None


def _account(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    gap = AFTER_CUE.match(text, at)
    if not gap:
        return None
    if found := IBAN.match(text, gap.end()):
        code = found[0].replace(" ", "")
        if 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return found.start(), found.end(), found.start() >= free
    found = ACCOUNT.match(text, gap.end())
    return (found.start(), found.end(), found.start() >= free and not dated(found[0])) if found else None


def _ssn(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    gap = AFTER_CUE.match(text, at)
    found = SOCIAL.match(text, gap.end()) if gap else None
    return (found.start(), found.end(), found.start() >= free) if found else None


def _login(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = LOGIN.match(text, at)
    return (found.start(1), found.end(2), True) if found else None


PARSERS: dict[str, Parser] = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "account": _account, "login": _login, "ssn": _ssn}


class Finder:
    """spans(text): by kind as in KINDS, then start; code points, end exclusive."""

    def __init__(self) -> None:
        import ahocorasick

        anchors: dict[str, tuple[str, bool]] = {"@": ("email", False), "://": ("login", False)}
        anchors |= {f"+{d}": ("phone", False) for d in DIGITS} | {f".{d}": ("ip", False) for d in DIGITS} | {d: ("card", False) for d in DIGITS}
        for cue, kind in CUES.items():
            anchors |= {form: (kind, True) for form in (cue, cue.upper(), cue.title())}
        self.automaton = ahocorasick.Automaton()
        for word, (kind, after) in anchors.items():
            self.automaton.add_word(word, (kind, 1 if after else 1 - len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        free = dict.fromkeys(KINDS, 0)
        found: list[tuple[str, int, int]] = []
        for last, (kind, shift) in self.automaton.iter(text):
            at = last + shift
            if kind == "card" and at < free["card"]:
                continue
            grown = PARSERS[kind](text, at, free[kind])
            if grown:
                start, free[kind], valid = grown
                if valid:
                    found.append((kind, start, grown[1]))
        return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


_finder: list[Finder] = []


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    if not _finder:
        _finder.append(Finder())
    return _finder[0].spans(text) if text else []


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans array of (kind, start, stop)) per row, by kind and start; none for null and empty texts. Repeated rows agree."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return arrow_pass(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")),
                      f"doc_id {kind}, spans array<struct<kind: string, start: int, stop: int>>",
                      lambda x: {"doc_id": x["doc_id"], "spans": [[{"kind": k, "start": a, "stop": b} for k, a, b in spans_of(t)] for t in x["text"]]})


def masked(text: str | None) -> str | None:
    """Spans become their kind in brackets; where spans of several kinds overlap, the earliest names the whole."""
    found = sorted(spans_of(text), key=lambda s: (s[1], -s[2]))
    if not found:
        return text
    out, at = [], 0
    for kind, start, stop in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def clean(docs: DataFrame) -> DataFrame:
    """The columns of documents with personal data masked; null texts stay null, n_chars follows a changed text."""
    @F.pandas_udf("string")
    def mask(text):
        return text.map(masked, na_action="ignore")

    names = docs.columns
    new = docs.select(F.struct(*names).alias("row"), mask(F.col("text")).alias("new_text"))
    same = F.col("new_text").eqNullSafe(F.col("row.text"))
    return new.select(*[
        F.col("new_text").alias(n) if n == "text" else F.when(same, F.col("row.n_chars")).otherwise(F.length("new_text")).cast(docs.schema[n].dataType).alias(n)
        if n == "n_chars" else F.col(f"row.{n}").alias(n) for n in names])


by_value(__name__)
