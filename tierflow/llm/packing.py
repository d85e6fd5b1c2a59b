"""Packing of token pieces into sequences (operator 4): Martello-Toth reduction, then best fit.

Lengths are at most the capacity, so the whole instance is its histogram: one
count for each length. Only that table, whose size is the capacity and not the
data, is planned on the driver; the plan says for ranks of pieces of a length
which sequences and offsets they get. Ranks are counted in Spark.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm import word_bpe
from tierflow.llm.common import stored

CAPACITY = 2048
END_ID = 0
SLICES = 64  # parts of a length whose pieces are numbered independently
PIECES = "doc_id {key}, piece int, start long, length long, ids binary"
PLAN = ("length long, rank_from long, rank_to long, per_sequence long, first_sequence long, "
        "first_offset long")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids) of every row's token ids and a closing id 0.

    Rows of up to ``capacity`` ids are one piece; longer ones are cut at its
    multiples. A null or empty text is one piece with the closing id alone.
    Repeated rows give repeated pieces; other columns are ignored.
    """
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.encoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for begin, end in word_bpe.slices(sizes):
                flat, counts = bpe.encode(texts.slice(begin, end - begin).to_pylist())
                rows, at = [], 0
                for row, n in enumerate(map(int, counts)):
                    ids = np.append(flat[at:at + n], END_ID).astype("<u4")
                    at += n
                    rows += [(begin + row, p, s, min(capacity, n + 1 - s),
                              ids[s:s + capacity].tobytes())
                             for p, s in enumerate(range(0, n + 1, capacity))]
                row, piece, start, length, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(row)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES.format(key=key))


@dataclass
class Plan:
    """Sequences planned so far: pieces of a length are handed out in rank order."""

    capacity: int
    counts: dict[int, int]
    used: dict[int, int] = field(default_factory=dict)
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def put(self, length: int, sequences: int, each: int, first: int, offset: int) -> None:
        """Place ``each`` pieces of a length in each of so many sequences from ``first`` on."""
        rank = self.used.get(length, 0)
        self.used[length] = rank + sequences * each
        self.counts[length] -= sequences * each
        if not self.counts[length]:
            del self.counts[length]
        self.rows.append((length, rank, rank + sequences * each, each, first, offset))

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        """So many new sequences that hold just these lengths."""
        offset = 0
        for length in lengths:
            self.put(length, times, 1, self.sequences, offset)
            offset += length
        self.sequences += times


def reduce_instance(plan: Plan) -> None:
    """Fix every set that provably dominates all alternatives for its largest piece.

    A set dominates if the companions in any other feasible set can be swapped,
    in parts, for its own companions. That holds (a) for pairs that fill a
    sequence exactly, (b) for the largest piece alone if nothing fits beside it,
    (c) with the largest fitting companion if no sum of pieces that fits is
    larger, and (d) with that companion and the largest piece beside it, if no
    three pieces fit and no pair that fits has a larger second piece.
    """
    size = plan.capacity
    for length in sorted(plan.counts, reverse=True):
        other = size - length
        if length == size:
            plan.fix((length,), plan.counts[length])
        elif length > other and other in plan.counts:
            plan.fix((length, other), min(plan.counts[length], plan.counts[other]))
        elif length == other and plan.counts[length] > 1:
            plan.fix((length, length), plan.counts[length] // 2)
    while plan.counts:
        largest = max(plan.counts)
        chosen = _dominating(plan, largest)
        if chosen is None:
            return
        need = {x: chosen.count(x) for x in chosen}
        times = min(plan.counts[x] // n for x, n in need.items())
        # (c) and (d) hold as long as the same companions stay available.
        plan.fix(chosen, times)


def _dominating(plan: Plan, largest: int) -> tuple[int, ...] | None:
    """The set that dominates for a piece of the largest length, if one is proved."""
    room = plan.capacity - largest
    left = {x: n - (x == largest) for x, n in plan.counts.items() if x <= room}
    fitting = sorted(x for x, n in left.items() if n)
    if not fitting:
        return (largest,)
    companion = fitting[-1]
    if _best_sum(left, fitting, room) == companion:
        return (largest, companion)
    low = [x for x in fitting for _ in range(min(3, left[x]))][:3]
    if len(low) == 3 and sum(low) <= room:
        return None
    left[companion] -= 1
    beside = [x for x in fitting if left[x] and x <= room - companion]
    left[companion] += 1
    if not beside:
        return None
    second = max((min(a, b) for i, a in enumerate(fitting) for b in fitting[i:]
                  if a + b <= room and (a != b or left[a] > 1)), default=0)
    return (largest, companion, beside[-1]) if second <= beside[-1] else None


def _best_sum(left: dict[int, int], fitting: list[int], room: int) -> int:
    """The largest sum of available pieces that is at most ``room`` (sums as bits)."""
    sums, mask = 1, (1 << (room + 1)) - 1
    for x in fitting:
        copies, step = min(left[x], room // x), 1
        while copies:
            step = min(step, copies)
            sums |= (sums << (x * step)) & mask
            copies -= step
            step *= 2
        if sums >> room & 1:
            return room
    return sums.bit_length() - 1


def best_fit(plan: Plan) -> None:
    """Longest pieces first, each into the fullest sequence that still takes it.

    Sequences that are equally full and follow one another are one group, so a
    length costs as many steps as there are groups that it touches.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
    rooms: list[int] = []

    def add(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in groups:
                bisect.insort(rooms, room)
            groups.setdefault(room, []).append((first, many))

    def fill(length: int, room: int, first: int, many: int) -> None:
        """Fill so many sequences with as many pieces as they take."""
        each = room // length
        whole = min(many, plan.counts.get(length, 0) // each)
        if whole:
            plan.put(length, whole, each, first, plan.capacity - room)
            add(room - each * length, first, whole)
        rest = plan.counts.get(length, 0)
        if whole < many:
            if rest:
                plan.put(length, 1, rest, first + whole, plan.capacity - room)
                add(room - rest * length, first + whole, 1)
            kept = whole + bool(rest)
            add(room, first + kept, many - kept)

    for length in sorted(plan.counts, reverse=True):
        while length in plan.counts:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = plan.capacity // length
                many = -(-plan.counts[length] // each)
                first, plan.sequences = plan.sequences, plan.sequences + many
                fill(length, plan.capacity, first, many)
                break
            room = rooms[at]
            first, many = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            fill(length, room, first, many)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for a histogram of lengths (1 to capacity)."""
    plan = Plan(capacity, {k: n for k, n in counts.items() if n})
    reduce_instance(plan)
    best_fit(plan)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset.

    Pieces of a length are numbered in SLICES hashed parts, by document and piece
    in each; so a length that holds most pieces is still many groups. Equal rows
    get different places. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    parts = pieces.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)))
    sizes = stored(parts.groupBy("length", "_slice").agg(F.count("*").alias("_n")), "packing-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_packing(counts, capacity).rows, PLAN)
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_slice").orderBy("doc_id", "piece")
    ranked = (parts.withColumn("_own", F.row_number().over(own) - 1)
              # at most capacity x SLICES rows
              .join(F.broadcast(starts), ["length", "_slice"])
              .withColumn("_rank", F.col("_own") + F.col("_before")))
    by_length = plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "rank_from", "rank_to", "per_sequence", "first_sequence", "first_offset"))).alias("_plan"))
    # a row per length, at most capacity
    placed = ranked.join(F.broadcast(by_length), "length").withColumn(
        "_at", F.filter("_plan", lambda p: (p["rank_from"] <= F.col("_rank"))
                        & (F.col("_rank") < p["rank_to"]))[0])
    inside = F.col("_rank") - F.col("_at.rank_from")
    return placed.select(
        *[c for c in pieces.columns],
        (F.col("_at.first_sequence") + F.floor(inside / F.col("_at.per_sequence"))).cast("long")
        .alias("sequence_id"),
        (F.col("_at.first_offset") + inside % F.col("_at.per_sequence") * F.col("length")).cast("long")
        .alias("offset"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Contract columns of the packing query: each piece with its digest and its place."""
    pieces = stored(token_pieces(docs, tokenizer, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "packing-pieces")
    return pack(pieces, capacity)
