"""Benchmark decontamination: a hash set of benchmark n-grams goes to every task, which scans the token windows of its documents.

Windows are looked up by a rolling hash over whole documents at once; each hit is verified word for word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.shipping import by_value
from .common import ROWS_AT_ONCE, stored, utf8

WINDOW = 10
#: Benchmark windows that one scan may hold (about 150 bytes each); more are scanned in several slices, one after the other.
WINDOWS_AT_ONCE = 1_000_000
#: A document with a larger share of words in benchmark windows goes; from others only the windows are taken out.
MAX_HIT_SHARE = 0.5
#: A document from which windows were taken goes if fewer words are left.
MIN_LEFT = 10

#: A-Z become lower case; what is neither letter nor digit of ASCII, nor a byte of a longer character, separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The windows of some benchmark items: (item id, text bytes) in, hits of a document's words out."""

    def __init__(self, items: list[tuple[str, bytes]], size: int) -> None:
        from xxhash import xxh64_intdigest

        self.items: dict[bytes, set[str]] = defaultdict(set)
        sizes: dict[bytes, int] = {}
        for item, text in items:
            found = words_of(text)
            for k in range(max(1, len(found) - size + 1) if found else 0):
                gram = b" ".join(found[k:k + size])
                self.items[gram].add(item)
                sizes[gram] = min(size, len(found))
        self.codes = {w: xxh64_intdigest(w) | 1 for gram in self.items for w in gram.split()}
        self.hashes: dict[int, np.ndarray] = {}
        for n in set(sizes.values()):
            grams = [g for g, s in sizes.items() if s == n]
            coded = np.array([[self.codes[w] for w in g.split()] for g in grams], np.uint64)
            self.hashes[n] = np.unique((coded * self._powers(n)).sum(axis=1, dtype=np.uint64))
        self.power, self.unpower = self._powers(0), self._powers(0)

    @staticmethod
    def _powers(n: int, base: np.uint64 = MULTIPLIER) -> np.ndarray:
        return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)])[:n]

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            self.power, self.unpower = self._powers(2 * n), self._powers(2 * n, INVERSE)

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Occurring windows as (first word, end), in order of length and place, and the items they belong to."""
        spans, items = [], set()
        if not self.items or not found:
            return spans, items
        n = len(found)
        self._grow(n + 1)
        coded = np.fromiter(map(self.codes.get, found, repeat(0)), np.uint64, n)
        summed = np.r_[np.uint64(0), np.cumsum(coded * self.power[:n])]
        for size, known in self.hashes.items():
            if n < size:
                continue
            rolled = (summed[size:] - summed[:-size]) * self.unpower[:n - size + 1]
            at = np.searchsorted(known, rolled)
            at[at == len(known)] = 0
            for k in np.flatnonzero(known[at] == rolled).tolist():
                owners = self.items.get(b" ".join(found[k:k + size]))
                if owners:
                    spans.append((k, k + size))
                    items |= owners
        return spans, items


def _scan(docs: DataFrame, items: list[tuple[str, bytes]], size: int, cutting: bool) -> DataFrame:
    """Adds one slice's hits to spans (flat list of begin, end) and items; cutting: writes texts with hits without them to cut."""
    target: list[pa.Schema] = [to_arrow_schema(docs.schema)]
    shipped = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Windows(shipped.value, size)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                counts, spans, owners, cut = [], [], [], []
                for raw, s, i in zip(batch.column("raw"), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                    found = words_of(raw.as_py())
                    more, their = known.hits(found)
                    counts.append(len(found))
                    spans.append(s + [x for span in more for x in span])
                    owners.append(sorted({*i, *their}))
                    cut.append(without(raw.as_py(), spans[-1]).decode("utf-8", "replace") if cutting and spans[-1] else None)
                new = {"n_words": counts, "spans": spans, "items": owners, "cut": cut}
                yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in target[0]], schema=target[0])

    return docs.mapInArrow(run, docs.schema)


def scanned(docs: DataFrame, benchmark: DataFrame, keep: list[Column], text: str = "text", item_id: str = "item_id", item_text: str = "text",
            size: int = WINDOW, at_once: int = WINDOWS_AT_ONCE, cutting: bool = False) -> DataFrame:
    """keep's columns, raw (text as bytes), n_words, spans (flat list of word places begin, end, ...) and items (sorted ids as strings).

    cutting adds cut: the text without its spans, null where there are none. It is made in the scan itself, as a second Python
    function in a task would keep a second worker alive.

    A benchmark of any size can be used: its distinct items are dealt into slices of bounded size, and documents pass through one scan a
    slice. Each scan but the last is stored, so that a worker never waits with its slice for the next one. Null texts have no words.
    An item without words has no window; items with a null id count under "null".
    """
    wide = docs.select(*keep, utf8(text).alias("raw"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"),
                       *([F.lit(None).cast("string").alias("cut")] if cutting else []))
    tests = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), utf8(item_text).alias("raw"))
    # An upper bound on the words of the distinct rows, hence on the windows, without moving any text.
    by_hash = tests.groupBy(F.xxhash64("item", "raw")).agg(F.max(F.floor((F.octet_length("raw") + 1) / 2)).alias("w"))
    weight = by_hash.agg(F.sum("w").alias("w")).first()["w"] or 0
    slices = max(1, -(-weight // at_once))
    for k in range(slices):
        part = tests.where(F.pmod(F.xxhash64("item", "raw"), F.lit(slices)) == k).distinct()
        last = k == slices - 1
        wide = _scan(wide, [(r["item"], bytes(r["raw"])) for r in part.collect()], size, cutting and last)
        if not last:
            wide = stored(wide, "scan")
    return wide


def covered(spans: list[int]) -> list[tuple[int, int]]:
    """Flat spans, joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[int]) -> bytes:
    """The text without the characters from the first to the last letter of each joined span."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(FOLD))]
    keep, at = [], 0
    for a, b in covered(spans):
        keep.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*keep, text[at:]])


def hit_words() -> Column:
    """Words inside any span, from the flat list `spans`."""
    pairs = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)), lambda i: F.struct(F.get("spans", i).alias("a"), F.get("spans", i + 1).alias("b"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))
    total = F.aggregate(pairs, start, lambda s, p: F.struct(
        (s["n"] + F.greatest(F.lit(0), p["b"] - F.greatest(p["a"], s["end"]))).alias("n"), F.greatest(s["end"], p["b"]).alias("end")), lambda s: s["n"])
    return F.when(F.size("spans") == 0, F.lit(0)).otherwise(total).cast("long")


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) per row; repeated rows give equal rows."""
    hits = scanned(docs, benchmark, [F.col(doc_id).alias("doc_id")], **options)
    return hits.select("doc_id", "n_words", hit_words().alias("n_hit"), "items", (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, max_share: float = MAX_HIT_SHARE, min_left: int = MIN_LEFT, **options) -> DataFrame:
    """The columns of documents. Benchmark windows are taken out of the texts; documents that are mostly benchmark go.

    Documents without a hit come back as they were, null and empty texts included; n_chars follows a changed text.
    """
    names = docs.columns
    hits = scanned(docs, benchmark, [F.struct(*names).alias("row")], cutting=True, **options).withColumn("n_hit", hit_words())
    left = F.col("n_words") - F.col("n_hit")
    stay = hits.where((F.size("spans") == 0) | ((F.col("n_hit") <= max_share * F.col("n_words")) & (left >= min_left)))
    return stay.withColumn("new_text", F.coalesce("cut", F.col("row.text"))).select(*[
        F.col("new_text").alias(n) if n == "text" else F.when(F.size("spans") > 0, F.length("new_text")).otherwise(F.col("row.n_chars")).cast(docs.schema[n].dataType).alias(n)
        if n == "n_chars" else F.col(f"row.{n}").alias(n) for n in names])


by_value(__name__)
