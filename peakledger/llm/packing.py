"""Best-fit packing of token sequences, by the linear grouping scheme on a histogram of lengths.

Documents are tokenised and cut in one pass that also numbers the pieces of each length within the task; the pieces are stored.
What is packed is the histogram of lengths, which has at most `capacity` entries whatever the number of documents: large lengths
are rounded up within groups of equal cardinality, a few configurations of group sizes are chosen by exact subset sums, the actual
lengths take the places of their group, and small lengths are placed best-fit in what is left. The result, a short list of runs of
equal sequences, is then joined back to the pieces: the n-th piece of a length gets the n-th place of that length.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.shipping import by_value
from .common import per_worker, stored, utf8

CAPACITY = 2048
END = 0
#: Lengths up to this share of the capacity are small.
SMALL = 1 / 16
#: Numbers of groups that are tried; the fewest sequences win, the fewer groups among equals.
GROUPS = (16, 64, 256, 1024)
#: Bytes of ids in one Arrow batch.
BATCH_BYTES = 8 << 20
#: Texts with so many characters without a space go through the tokenizer whole.
UNBROKEN = 400

# Fixed value: the pattern of byte-level pretokens, and the part of it that is left where no two white-space characters meet.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
RUNS, SINGLE = r"|\s+(?!\S)|\s+", r"|\s"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


def ranks(file: dict) -> dict[bytes, int] | None:
    """Ids by token of a tokenizer file whose merges alone decide, or None: byte-level, nothing normalised, merges in order of ids."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not file.get("normalizer") and not file.get("truncation") and not file.get("padding")
             and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    letters, ids = byte_letters(), model.get("vocab")
    if not plain or not all(c in ids for c in letters):
        return None
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [ids.get(m, -1) for m in merged]
    if any(a >= b for a, b in zip([-1, *order], order)):
        return None
    return {bytes(letters[c] for c in token): ids[token] for token in [*letters, *merged]}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, those that the tokenizers library gives for the file.

    Where the file's merges alone decide, tiktoken applies them, as it is several times as fast. Texts that hold an added token or a
    very long unbroken run, and files of any other kind, go through the tokenizers library. Nothing is remembered between texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            merges = ranks(json.load(file))
        self.single = self.runs = None
        if merges is not None:
            import tiktoken

            self.single, self.runs = (tiktoken.Encoding(name, pat_str=PRETOKEN + rest, mergeable_ranks=merges, special_tokens={}).encode_ordinary
                                      for name, rest in (("single", SINGLE), ("runs", RUNS)))
        self.two_spaces, self.many_spaces = re.compile(r"\s\s").search, re.compile(r"\s{%d}" % UNBROKEN).search

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def unbroken(text: str) -> bool:
        at = 0
        while at + UNBROKEN < len(text):
            at = text.rfind(" ", at, at + UNBROKEN) + 1
            if not at:
                return True
        return False

    def __call__(self, text: str) -> bytes:
        if self.single is None or self.unbroken(text) or any(s in text for s in self.special):
            return self._whole(text)
        if not self.two_spaces(text):
            ids = self.single(text)
        elif self.many_spaces(text):
            return self._whole(text)
        else:
            ids = self.runs(text)
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the capacity."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, length, capacity)]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, task, nth): nth counts the pieces of equal length within the task.

    A null text is empty, and an empty one gives a piece with the end id only. Repeated rows are packed as often as they come.
    """
    kind = docs.schema[doc_id].dataType
    schema = f"doc_id {kind.simpleString()}, piece int, start long, length long, ids binary, task int, nth long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = per_worker(("encoder", tokenizer), lambda: Encoder(tokenizer)), defaultdict(int), TaskContext.get().partitionId()
        end = np.asarray([END], "<u4").tobytes()
        rows: list[tuple] = []

        def flush(kinds: pa.Schema) -> pa.RecordBatch:
            out = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, schema=kinds)

        for batch in batches:
            kinds = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                               ("ids", pa.binary()), ("task", pa.int32()), ("nth", pa.int64())])
            held = 0
            for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                ids = encode(raw.as_py().decode("utf-8", "replace")) + end
                for n, (start, size) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((key, n, start, size, ids[4 * start:4 * (start + size)], task, seen[size]))
                    seen[size] += 1
                held += len(ids)
                if held > BATCH_BYTES:
                    yield flush(kinds)
                    held = 0
            if rows:
                yield flush(kinds)

    return docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("raw")).mapInArrow(run, schema)


# A run is [times, [(length, count), ...], room]: so many sequences with the same lengths and the same room left.


def grouped(counts: list[tuple[int, int]], groups: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """counts: (length, n) from the longest. -> (rounded length, n, actual (length, n) from the longest) of equal cardinality."""
    total = sum(n for _, n in counts)
    out, now, room = [], [], 0
    for length, n in counts:
        while n:
            if not room:
                if now:
                    out.append(now)
                now, room = [], max(1, -(-total // groups))
            take = min(n, room)
            now.append((length, take))
            n, room = n - take, room - take
    if now:
        out.append(now)
    merged: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for g in out:
        merged[g[0][0]] += g  # groups that round to one length are one
    return [(size, sum(n for _, n in g), g) for size, g in merged.items()]


def configurations(sizes: list[tuple[int, int]], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """sizes: (size, n). -> (times, [(size, count), ...]): each holds the largest size left and fills the rest by exact subset sums."""
    left, out = dict(sizes), []
    order = sorted(left, reverse=True)
    while order:
        top = order[0]
        budget = capacity - top
        reach, steps = 1, []
        for size in order:
            if size > budget:
                continue
            for _ in range(min(left[size] - (size == top), budget // size)):
                before = reach
                reach |= (reach << size) & ((1 << budget + 1) - 1)
                if reach == before:
                    break
                steps.append((size, before))
            if reach >> budget & 1:
                break
        fill, used = reach.bit_length() - 1, {top: 1}
        for size, before in reversed(steps):
            if not before >> fill & 1:
                used[size] = used.get(size, 0) + 1
                fill -= size
        times = min(left[s] // n for s, n in used.items())
        out.append((times, sorted(used.items(), reverse=True)))
        for s, n in used.items():
            left[s] -= times * n
        order = [s for s in order if left[s]]
    return out


def substituted(chosen: list[tuple[int, list[tuple[int, int]]]], actual: dict[int, list[tuple[int, int]]], capacity: int) -> list[list]:
    """Places of a rounded size are taken by the actual lengths of its group, so a run is cut where a length is used up."""
    stock = {size: [list(x) for x in reversed(group)] for size, group in actual.items()}
    runs = []
    for times, config in chosen:
        while times:
            step, taken = times, []
            for size, count in config:
                for k in range(len(stock[size]) - 1, -1, -1):
                    length, n = stock[size][k]
                    if n >= count:  # one length for all places of the size
                        step = min(step, n // count)
                        taken.append((size, [(k, length, count)]))
                        break
                else:
                    step, need, mix = 1, count, []
                    for k in range(len(stock[size]) - 1, -1, -1):
                        use = min(need, stock[size][k][1])
                        if use:
                            mix.append((k, stock[size][k][0], use))
                            need -= use
                    taken.append((size, mix))
            lengths: dict[int, int] = defaultdict(int)
            for size, mix in taken:
                for k, length, use in mix:
                    stock[size][k][1] -= use * step
                    lengths[length] += use
            for size, _ in config:
                stock[size] = [x for x in stock[size] if x[1]]
            runs.append([step, sorted(lengths.items(), reverse=True), capacity - sum(a * b for a, b in lengths.items())])
            times -= step
    return runs


def best_fit(runs: list[list], counts: list[tuple[int, int]], capacity: int) -> list[list]:
    """Lengths from the longest, each into the sequences with the least room that holds it, whole runs at a time."""
    by_room: dict[int, list[list]] = defaultdict(list)
    for r in runs:
        by_room[r[2]].append(r)
    rooms = sorted(by_room)
    done: list[list] = []

    def put(run: list) -> None:
        if not by_room[run[2]] and run[2] not in rooms:
            insort(rooms, run[2])
        by_room[run[2]].append(run)

    for length, n in counts:
        while n:
            at = bisect_left(rooms, length)
            while at < len(rooms) and not by_room[rooms[at]]:
                rooms.pop(at)
            if at < len(rooms):
                times, lengths, room = by_room[rooms[at]].pop()
            else:
                times, lengths, room = -(-n // (capacity // length)), [], capacity
            fit = room // length
            full = min(times, n // fit)
            if full:
                put([full, [*lengths, (length, fit)], room - fit * length])
                times, n = times - full, n - full * fit
            if times and n:
                put([1, [*lengths, (length, n)], room - n * length])
                times, n = times - 1, 0
            if times and lengths:
                put([times, lengths, room])
    for group in by_room.values():
        done += group
    return done


def packed(histogram: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS, small: float = SMALL) -> list[list]:
    """Runs of sequences that hold just the lengths of the histogram. Its size depends on the capacity only."""
    full = histogram.get(capacity, 0)
    counts = sorted(((k, n) for k, n in histogram.items() if n and k < capacity), reverse=True)
    large = [(k, n) for k, n in counts if k > small * capacity]
    little = [(k, n) for k, n in counts if k <= small * capacity]
    best: list[list] | None = None
    for number in groups:
        sets = grouped(large, number)
        chosen = configurations([(size, n) for size, n, _ in sets], capacity)
        runs = best_fit(substituted(chosen, {size: g for size, _, g in sets}, capacity), little, capacity)
        if best is None or sum(r[0] for r in runs) < sum(r[0] for r in best):
            best = runs
    return ([[full, [(capacity, 1)], 0]] if full else []) + (best or [])


def places(runs: list[list]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, times * count, sequence, offset, count) per run and length: places first, first + 1, ... of a length are there."""
    out, first, sequence = [], defaultdict(int), 0
    for times, lengths, _ in runs:
        offset = 0
        for length, count in lengths:
            out.append((length, first[length], first[length] + times * count, sequence, offset, count))
            first[length] += times * count
            offset += length * count
        sequence += times
    return out


def _last_up_to(firsts: Column, rank: Column, most: int) -> Column:
    """Position of the last of the rising firsts that is not above rank, in as many steps as `most` has bits."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, (most - 1).bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(firsts, at + step) <= rank, at + step).otherwise(at))


def place(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cuts (task, length, nth, ...) with sequence_id and offset in place of task and nth: what is carried besides is up to the caller.

    The histogram of lengths, at most `capacity` rows, and the plan made from it pass through the driver.
    """
    spark = cuts.sparkSession
    by_task = cuts.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    blocks: dict[int, list] = defaultdict(list)
    for length, *rest in places(packed(histogram, capacity)):
        blocks[length].append(tuple(rest))
    rows = [(length, [b[0] for b in own], [b[1:] for b in own]) for length, own in blocks.items()]
    plan = spark.createDataFrame(rows, "length long, firsts array<long>, blocks array<struct<last long, sequence long, offset long, count long>>")
    kept = [c for c in cuts.columns if c not in ("task", "nth")]
    ranked = cuts.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth")).join(F.broadcast(plan), "length")
    at = _last_up_to(F.col("firsts"), F.col("rank"), max([len(r[1]) for r in rows] or [1]))
    ranked = ranked.withColumn("at", at).withColumn("b", F.get("blocks", F.col("at")))
    turn = F.col("rank") - F.get("firsts", F.col("at"))
    return ranked.select(*kept, (F.col("b.sequence") + F.floor(turn / F.col("b.count"))).cast("long").alias("sequence_id"),
                         (F.col("b.offset") + turn % F.col("b.count") * F.col("length")).cast("long").alias("offset"))


def cuts(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of docs, written once to the shared folder."""
    return stored(pieces(docs, tokenizer, capacity, doc_id, text), "pieces")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece with its ids and its place, gapless from 0 in a sequence.

    Null texts count as empty; an empty table gives an empty one. Other columns are not read.
    """
    return place(cuts(docs, tokenizer, capacity, doc_id, text), capacity)


by_value(__name__)
