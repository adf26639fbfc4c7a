"""Secrets: fixed shapes, and strings that a tokenizer can hardly shorten.

A vocabulary learned from text writes words in a few long tokens and random strings in many short ones. So a long string with a low
number of characters per token is random; digests, identifiers and numbers are set aside first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from ..functions.shipping import by_value
from .common import arrow_pass

KINDS = ("assign", "access", "hex", "token")
#: Strings of at least this length with fewer characters per token count as random.
MIN_LENGTH = 20
MAX_CHARS_PER_TOKEN = 2.3
#: The same for strings without a digit, which are mostly words: a stricter limit.
MAX_CHARS_PER_TOKEN_OF_LETTERS = 2.2

# The shapes.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LONG = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
#: Lengths of hexadecimal digests in common use, identifiers in 8-4-4-4-12 form, numbers and dates.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
KNOWN = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_=-]+|(?:sha(?:1|256|384|512)|md5)[-_=][A-Za-z0-9+/=-]+")
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")


class Vocabulary:
    """Characters per token under a file of ranks (base64 token, rank)."""

    def __init__(self, ranks: str, pattern: str) -> None:
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def chars_per_token(self, string: str) -> float:
        return len(string) / len(self.encoding.encode_ordinary(string))


_loaded: dict[str, Vocabulary] = {}


def known(string: str) -> bool:
    """Digests, identifiers and numbers, which are random but not secret."""
    return bool(KNOWN.fullmatch(string) or HEXADECIMAL.fullmatch(string) and len(string) in DIGEST_LENGTHS)


def spans_of(text: str | None, ranks: str, pattern: str) -> list[tuple[str, int, int]]:
    """By start, then kind as in KINDS; a random string that overlaps a fixed shape is not listed again."""
    if not text:
        return []
    low = text.lower()
    found = []
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    longest = max(map(len, text.split()), default=0)
    if longest >= 16:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)] + [("hex", *m.span()) for m in HEX.finditer(text)]
    if longest >= MIN_LENGTH:
        shapes, at, reach = sorted((a, b) for _, a, b in found), 0, 0
        for m in LONG.finditer(text):
            # reach: the last end among the shapes that begin before this string's end
            while at < len(shapes) and shapes[at][0] < m.end():
                at, reach = at + 1, max(reach, shapes[at][1])
            if reach > m.start() or known(m[0]):
                continue
            if ranks not in _loaded:
                _loaded[ranks] = Vocabulary(ranks, pattern)
            limit = MAX_CHARS_PER_TOKEN if any(c.isdigit() for c in m[0]) else MAX_CHARS_PER_TOKEN_OF_LETTERS
            if _loaded[ranks].chars_per_token(m[0]) < limit:
                found.append(("token", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans array of (kind, start, stop)) per row, by start and kind; none for null and empty texts. Repeated rows agree.

    ranks: a tiktoken vocabulary file that every executor has at this path; pattern: its pretoken pattern.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return arrow_pass(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")),
                      f"doc_id {kind}, spans array<struct<kind: string, start: int, stop: int>>",
                      lambda x: {"doc_id": x["doc_id"], "spans": [[{"kind": k, "start": a, "stop": b} for k, a, b in spans_of(t, ranks, pattern)] for t in x["text"]]})


by_value(__name__)
