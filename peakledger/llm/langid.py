"""Language identification with bit-sliced Bloom filters over character n-grams.

All languages' filters have the same slots and hash functions and are stored across: a slot holds one bit per language. Combining an
n-gram's slots with AND gives the set of languages whose filter holds it. A text's bits are counted per language, the counts are
corrected for the filter's false positives, and the language with the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.shipping import by_value
from .common import arrow_pass, checkpoint

LENGTHS = (3, 4)
#: log2 of the slots; hash functions; n-grams kept per language, from the most frequent; documents learned from per language, on average.
SLOT_BITS = 20
HASHES = 3
GRAMS = 30_000
SAMPLE = 2_000
#: An n-gram belongs to a language if at least this share of its sampled documents, and two of them where there are two, hold it.
MIN_SHARE = 0.005
#: Characters worked on at once.
CHARS_AT_ONCE = 1 << 19
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, 0 for what is no letter and around each text, and the number of each one's text."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join(f"\0{t}" for t in [*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(low) + 1), [len(t) + 2 for t in low] + [1])
    return np.where(_letters[0][codes], codes, 0), owner


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, number of text) of every n-gram: letters with at most a word's edge at either end; a bounded part at a time."""
    def parts() -> Iterator[tuple[int, list[str]]]:
        begin, held = 0, 0
        for k, t in enumerate(texts):
            if held and held + len(t) > CHARS_AT_ONCE:
                yield begin, texts[begin:k]
                begin, held = k, 0
            held += len(t)
        yield begin, texts[begin:]

    for begin, some in parts():
        codes, owner = _codes(some)
        for n in LENGTHS:
            for at in range(0, len(codes) - n + 1, CHARS_AT_ONCE):
                x = codes[at:at + CHARS_AT_ONCE + n - 1].astype(np.uint64)
                size = len(x) - n + 1
                inner = np.ones(size, bool)
                for k in range(1, n - 1):
                    inner &= x[k:k + size] != 0
                start = np.flatnonzero(inner)
                mixed = np.full(len(start), n, np.uint64)
                for k in range(n):
                    mixed = (mixed ^ x[start + k]) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                yield mixed * np.uint64(0xBF58476D1CE4E5B9), begin + owner[at + start]


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    return [((hashes >> np.uint64(64 - SLOT_BITS * (k + 1))) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """languages in order of name; slices[w, slot]: bits of languages 64w to 64w + 63."""

    def __init__(self, members: dict[str, np.ndarray]) -> None:
        self.languages = sorted(members)
        self.slices = np.zeros((max(1, -(-len(self.languages) // 64)), 1 << SLOT_BITS), np.uint64)
        for k, language in enumerate(self.languages):
            for slot in _slots(members[language]):
                self.slices[k // 64, slot] |= np.uint64(1 << k % 64)
        fill = [float(((self.slices[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(len(self.languages))]
        self.false = np.array([f ** HASHES for f in fill])

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: its n-grams, and per language the share of them in its filter, corrected for false positives."""
        total = np.zeros(len(texts) + 1)
        counts = np.zeros((len(self.languages), len(texts) + 1))
        for hashes, owner in grams(texts):
            slots = _slots(hashes)
            total += np.bincount(owner, minlength=len(total))
            for k in range(len(self.languages)):
                if k % 64 == 0:
                    held = self.slices[k // 64][slots[0]]
                    for s in slots[1:]:
                        held &= self.slices[k // 64][s]
                counts[k] += np.bincount(owner, weights=(held >> np.uint64(k % 64)) & np.uint64(1), minlength=len(total))
        raw = counts / np.maximum(total, 1)
        return total[:-1], ((raw - self.false[:, None]) / (1 - self.false[:, None]))[:, :-1]

    def decide(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, corrected share from 0 to 1); ties go to the first name. No letter, or nothing learned: und, 0."""
        plain = [t or "" for t in texts]
        total, shares = self.shares(plain)
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        best = shares.argmax(axis=0)
        return [(self.languages[b], float(min(1.0, max(0.0, shares[b, i])))) if total[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, kept: int = GRAMS) -> Filters:
    """From rows with a language. Learns from about `sample` whole documents of each, those whose id hashes below that share.

    What reaches the driver is `kept` n-gram hashes a language; every value of lang is a language. Rows without text or language are
    not learned from.
    """
    labelled = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # A share of each language by hash: no language meets in one task, and no text is moved. Equal rows are chosen alike.
    totals = checkpoint(labelled.groupBy("lang").agg(F.count("*").alias("total")))  # a row a language
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    some = labelled.join(F.broadcast(totals), "lang").where(place < F.lit(float(sample)) / F.col("total")).select("lang", "text")

    def counted(x: dict[str, list]) -> dict[str, list]:
        """Documents of these that hold an n-gram, by language."""
        parts = list(grams(x["text"]))
        hashes, owner = np.concatenate([h for h, _ in parts]), np.concatenate([o for _, o in parts])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][:len(hashes)]
        names, number = np.unique(np.array(x["lang"], object).astype(str), return_inverse=True)
        held = np.stack([number[owner[new]].astype(np.uint64), hashes[new]])
        held = held[:, np.lexsort(held[::-1])]
        first = np.flatnonzero(np.r_[True, (held[:, 1:] != held[:, :-1]).any(axis=0)][:held.shape[1]])
        return {"lang": names[held[0, first].astype(int)].tolist(), "gram": held[1, first].view(np.int64), "docs": np.diff(np.r_[first, held.shape[1]])}

    found = arrow_pass(some.select("lang", "text"), "lang string, gram long, docs long", counted)
    sizes = some.groupBy("lang").agg(F.count("*").alias("size"))
    frequent = found.groupBy("lang", "gram").agg(F.sum("docs").alias("docs")).join(F.broadcast(sizes), "lang")
    frequent = frequent.where(F.col("docs") >= F.greatest(F.least(F.lit(2), F.col("size")), MIN_SHARE * F.col("size")))
    first = Window.partitionBy("lang").orderBy(F.desc("docs"), "gram")
    top = frequent.withColumn("n", F.row_number().over(first)).where(F.col("n") <= kept)
    rows = top.select("lang", "gram").toPandas()
    return Filters({k: g["gram"].to_numpy(np.int64).view(np.uint64) for k, g in rows.groupby("lang")})


def predict(docs: DataFrame, filters: Filters, keep: list[str], text: str = "text") -> DataFrame:
    """keep's columns, lang_pred and score per row; null texts and texts without a letter are und with score 0."""
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    shipped = docs.sparkSession.sparkContext.broadcast(filters)  # HASHES and GRAMS bound it, not the data

    def run(x: dict[str, list]) -> dict[str, list]:
        found = shipped.value.decide(x["text"])
        return {**{c: x[c] for c in keep}, "lang_pred": [k for k, _ in found], "score": [s for _, s in found]}

    return arrow_pass(docs.select(*keep, F.col(text).cast("string").alias("text")), f"{kinds}, lang_pred string, score double", run)


by_value(__name__)
