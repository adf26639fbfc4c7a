"""SimHash near-duplicates: fingerprints, exact candidate buckets, bit-sliced comparison inside buckets, components.

Two fingerprints that differ in at most two bits agree in at least two of any four blocks of them. So every such pair meets in a
bucket of fingerprints that share two 16-bit blocks. A bucket above a size is divided the same way by its other 32 bits, after
which at most 2**16 different fingerprints can share a bucket. Nothing is capped, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shipping import by_value
from .common import arrow_pass, checkpoint, utf8
from .components import components

BITS = 64
SEED = 42
WORDS = 3
RADIUS = 2
#: Buckets with more fingerprints are divided by their other bits.
DIVIDE_ABOVE = 512
#: (query, word of 64 members) pairs compared at once.
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: bytes, shingle: int = WORDS) -> int:
    """As a signed 64-bit number. A bit is set if it is set in over half of the shingles' hashes; no words: 0."""
    from xxhash import xxh64_digest

    found = text.lower().split()
    if not found:
        return 0
    line, ends = b" ".join(found), list(accumulate(len(w) + 1 for w in found))
    last = ends[shingle - 1:] or ends[-1:]
    hashes = b"".join([xxh64_digest(line[a:b - 1], SEED) for a, b in zip([0, *ends], last)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = WORDS) -> DataFrame:
    """(doc_id, body, fp long), one row per row; body is a hash of the text as it stands."""
    kind = docs.schema[doc_id].dataType.simpleString()
    read = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("body"), utf8(text).alias("raw"))
    return arrow_pass(read, f"doc_id {kind}, body long, fp long", lambda x: {"doc_id": x["doc_id"], "body": x["body"], "fp": [fingerprint(t, shingle) for t in x["raw"]]})


def _keys(value: Column, blocks: int, width: int) -> list[Column]:
    """value's blocks (from the lowest), every two of them joined, with the number of the choice on top."""
    part = [F.shiftrightunsigned(value, width * k).bitwiseAND(F.lit((1 << width) - 1).cast("long")) for k in range(blocks)]
    return [F.shiftleft(F.lit(n).cast("long"), 2 * width).bitwiseOR(F.shiftleft(part[i], width)).bitwiseOR(part[j])
            for n, (i, j) in enumerate(combinations(range(blocks), 2))]


def _other_bits(value: Column, choice: int) -> Column:
    """The 32 bits outside the two blocks of a choice."""
    i, j = list(combinations(range(4), 2))[choice]
    a, b = [k for k in range(4) if k not in (i, j)]
    mask = F.lit(0xFFFF).cast("long")
    return F.shiftleft(F.shiftrightunsigned(value, 16 * b).bitwiseAND(mask), 16).bitwiseOR(F.shiftrightunsigned(value, 16 * a).bitwiseAND(mask))


def _within(fp: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, fp) that connect the fingerprints of each bucket just as all pairs within the radius would."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    small = (sizes > 1) & (sizes <= BITS)
    root = np.arange(len(fp))
    if small.any():
        at = np.repeat(starts[small], sizes[small]) + np.concatenate([np.arange(n) for n in sizes[small]])
        word = np.repeat(np.arange(small.sum()), sizes[small])
        first = np.repeat(starts[small], sizes[small])
        planes = _planes(fp[at], word, at - first, int(small.sum()))
        near = np.zeros(len(at), np.uint64)
        # The lanes a bucket has: unused ones hold zero bits, which fingerprints of few bits would be near to.
        real = ~np.uint64(0) >> (BITS - sizes[small]).astype(np.uint64)
        for k in range(0, len(at), PAIRS_AT_ONCE):
            q = slice(k, k + PAIRS_AT_ONCE)
            near[q] = _alive(planes, word[q], fp[at[q]], radius) & real[word[q]]
        begin = np.searchsorted(at, first)
        root[at] = first + _lowest(_closure(near, begin, sizes[small].max()))
    for s, n in zip(starts[sizes > BITS], sizes[sizes > BITS]):
        root[s:s + n] = s + _spread(fp[s:s + n], radius)
    linked = root != np.arange(len(fp))
    return fp[linked], fp[root[linked]]


def _planes(fp: np.ndarray, word: np.ndarray, lane: np.ndarray, words: int) -> np.ndarray:
    """planes[b, w]: bit b of up to 64 fingerprints, one lane each. word must not fall."""
    opens = np.searchsorted(word, np.arange(words))
    shift = lane.astype(np.uint64)
    return np.stack([np.bitwise_or.reduceat(((fp >> np.uint64(b)) & np.uint64(1)) << shift, opens) for b in range(BITS)])


def _alive(planes: np.ndarray, word: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For each (word, query): the lanes whose fingerprint differs from the query in at most `radius` bits.

    The distances of 64 lanes grow together in bit-sliced counters; a word is given up when all its lanes are beyond the radius.
    """
    out = np.zeros(len(word), np.uint64)
    left = np.arange(len(word))
    digits = (radius + 1).bit_length()
    counter = [np.zeros(len(word), np.uint64) for _ in range(digits)]
    over = np.zeros(len(word), np.uint64)
    for b in range(BITS):
        carry = planes[b][word] ^ (np.uint64(0) - ((query >> np.uint64(b)) & np.uint64(1)))
        for k in range(digits):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b % 8 == 7:
            beyond = over | _above(counter, radius)
            alive = ~beyond
            keep = alive != 0
            if b == BITS - 1:
                out[left] = alive
            elif not keep.all():
                left, word, query, over = left[keep], word[keep], query[keep], over[keep]
                counter = [c[keep] for c in counter]
                if not len(left):
                    break
    return out


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced number is above the radius."""
    more, same = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            same = same & counter[k]
        else:
            more = more | (same & counter[k])
            same = same & ~counter[k]
    return more


def _closure(near: np.ndarray, begin: np.ndarray, lanes: int) -> np.ndarray:
    """Lanes reachable in any number of steps; near[i]: lanes next to row i, whose word begins at row begin[i]."""
    while True:
        wider = near.copy()
        for lane in range(lanes):
            has = np.flatnonzero((near >> np.uint64(lane)) & np.uint64(1))
            wider[has] |= near[begin[has] + lane]
        if (wider == near).all():
            return near
        near = wider


def _lowest(word: np.ndarray) -> np.ndarray:
    low = word & (~word + np.uint64(1))
    return np.log2(low.astype(np.float64)).astype(np.int64)


def _spread(fp: np.ndarray, radius: int) -> np.ndarray:
    """For a bucket of many words: the first member of each one's group; each member is a query once."""
    n = len(fp)
    lanes = np.arange(n)
    words = (n + BITS - 1) // BITS
    planes = _planes(fp, lanes // BITS, lanes % BITS, words)
    free = np.packbits(np.ones(n, np.uint8), bitorder="little")
    free = np.frombuffer(np.r_[free, np.zeros(words * 8 - len(free), np.uint8)].tobytes(), "<u8").copy()
    root, step = np.full(n, -1), max(1, PAIRS_AT_ONCE // words)
    for seed in range(n):
        if root[seed] >= 0:
            continue
        front = np.array([seed])
        root[seed] = seed
        free[seed // BITS] &= ~(np.uint64(1) << np.uint64(seed % BITS))
        while len(front):
            found = np.zeros(words, np.uint64)
            open_words = np.flatnonzero(free)
            if not len(open_words):
                break
            for k in range(0, len(front), step):
                ask = front[k:k + step]
                alive = _alive(planes, np.tile(open_words, len(ask)), np.repeat(fp[ask], len(open_words)), radius)
                found[open_words] |= np.bitwise_or.reduce(alive.reshape(len(ask), -1), axis=0)
            found &= free
            free &= ~found
            front = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
            root[front] = seed
    return root


def _link_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of bucket; the last bucket of a batch waits for its end."""
        def out(fp: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
            a, b = _within(fp, bucket, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(bucket):
                continue
            open_from = np.searchsorted(bucket, bucket[-1])
            if held and held[0][1][0] == bucket[-1]:
                held.append((fp, bucket))
                continue
            ready = [*held, (fp[:open_from], bucket[:open_from])]
            yield out(*map(np.concatenate, zip(*ready)))
            held = [(fp[open_from:], bucket[open_from:])]
        if held:
            yield out(*map(np.concatenate, zip(*held)))
    return run


def links(fps: DataFrame, radius: int = RADIUS, divide_above: int = DIVIDE_ABOVE) -> DataFrame:
    """fps (fp), different numbers -> (a, b): links within the radius that connect whatever all such pairs would connect."""
    if not 0 <= radius <= 2:
        raise ValueError("the buckets are exact for a radius of at most two bits")
    keyed = fps.select("fp", F.explode(F.array(*_keys(F.col("fp"), 4, 16))).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, "bucket")
    choice = F.shiftrightunsigned("bucket", 32)
    rest = F.coalesce(*[F.when(choice == n, _other_bits(F.col("fp"), n)) for n in range(6)])
    low = F.col("bucket").bitwiseAND(F.lit((1 << 35) - 1).cast("long"))
    fine = F.transform(F.array(*_keys(rest, 4, 8)), lambda k: F.shiftleft(low, 20).bitwiseOR(k).bitwiseOR(F.lit(1 << 62).cast("long")))
    bucket = F.explode(F.when(F.col("n") <= divide_above, F.array("bucket")).otherwise(fine))
    dealt = met.select("fp", bucket.alias("bucket")).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_link_batches(radius), "a long, b long")


def rooted(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """nodes (fp, ...), one per fingerprint, with root: a fingerprint that all of a component share."""
    found = components(links(nodes.select("fp"), radius))
    return nodes.join(found, nodes["fp"] == found["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp) -> (doc_id, fp, component_id): the smallest id of all documents that can be reached through links.

    Equal fingerprints are one node, so thousands of copies cost no comparison. Rows without an id take part in linking and are
    never the smallest; a component without any id has a null one.
    """
    nodes = rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), radius)
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(nodes.join(smallest, "root").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row. Null and empty texts have fingerprint zero and are linked like any other.

    Repeated rows give equal rows. The texts are read once: the fingerprints are checkpointed, 24 bytes a row.
    """
    prints = checkpoint(fingerprints(docs, doc_id, text, shingle))
    return groups(prints, radius).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The columns of documents: one row of each component, the first by doc_id (nulls last), then by a hash of the text.

    Rows are told apart by id and text together, so of rows that repeat an id only those of the same component go. Of rows that agree in
    both, one stays. Rows without an id go like others where a row of their component stays.
    """
    prints = checkpoint(fingerprints(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "body"))
    nodes = rooted(prints.groupBy("fp").agg(first.alias("best")))
    best = nodes.groupBy("root").agg(F.min("best").alias("best"))
    key = F.xxhash64("doc_id", "body")
    stay = best.select("best.doc_id", "best.body").select(key.alias("key"), "body").distinct()
    wide = docs.select(F.col("doc_id"), F.xxhash64("text").alias("body"), F.struct(*docs.columns).alias("row")).select(key.alias("key"), "body", "row")
    kept = wide.join(stay, ["key", "body"], "left_semi").dropDuplicates(["key", "body"])
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


by_value(__name__)
