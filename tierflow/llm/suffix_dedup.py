"""Removal of repeated byte strings (operator 12): suffixes built column by column.

Every string of ``length`` bytes has an anchor, its smallest hashed k-gram, at the same
place wherever it occurs. So texts are cut into pieces, one for the strings of each
anchor; pieces of equal anchors meet in Spark, equal pieces are one, and the suffixes of
the others are sorted by a collection transform that takes one symbol of each piece a
round, with the common prefixes of neighbours. Prefixes of ``length`` bytes are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import cell_counts, stored, whole_groups

LENGTH = 200
GRAM = 32
CHUNK = 1 << 20  # bytes of text looked at together
PLACE = np.uint64((1 << 22) - 1)  # bits of an ordering key that hold the place in a chunk
LIMIT = 8192  # pieces of one key that are sorted together
CELL_BITS = 20  # of an anchor's hash: its cell in the table of counts
PIECES = ("key long, digest long, doc_id {id}, row long, begin long, end long, anchor int, times int, crowded boolean")
SPANS = "doc_id {id}, row long, begin long, end long"
BYTES = "doc_id {id}, row long, key long, begin long, anchor int, bytes binary"
KEPT = "doc_id {id}, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"


def _mix(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the bytes from each place on; ``gram`` is a power of two from 8."""
    x, size = data.astype(np.uint64), 1
    while size < 8:
        x = x[:-size] | (x[size:] << np.uint64(8 * size))
        size *= 2
    x = _mix(x, 0x9E3779B97F4A7C15)
    while size < gram:
        x = _mix(x[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + x[size:], 0xD6E8FEB86659FD93)
        size *= 2
    return x


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks forwards and back."""
    full = -(-len(x) // width) * width
    blocks = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(x) - width + 1], ahead[width - 1:len(x)])


def cut_pieces(data: np.ndarray, first: np.ndarray, last: np.ndarray,
               length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash of the anchor, begin, end, anchor) of the pieces of texts in a chunk.

    ``first`` and ``last`` are where the texts begin and end. A piece spans the strings,
    from one start to the next, that have the same anchor.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = gram_hashes(data)
    keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (window_minima(keys, length - GRAM + 1) & PLACE).astype(np.int64)
    long = last - first >= length
    change = np.zeros(len(chosen) + 1, np.int64)
    np.add.at(change, first[long], 1)
    np.add.at(change, last[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(change)[:-1] > 0)
    if not len(starts):
        return none, none, none, none
    chosen = chosen[starts]
    # Texts follow each other without a gap, so a text's last start and the next one's first are apart.
    breaks = np.flatnonzero((np.diff(starts) != 1) | (np.diff(chosen) != 0)) + 1
    low, high = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(starts)]]) - 1
    anchor = chosen[low]
    return hashes[anchor].view(np.int64), starts[low], starts[high] + length, anchor


def _chunks(offsets: np.ndarray, length: int) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """(texts, begins, ends) of chunks; a text larger than a chunk is given in overlapping parts."""
    texts: list[int] = []
    begins: list[int] = []
    ends: list[int] = []
    for i in range(len(offsets) - 1):
        begin, end = int(offsets[i]), int(offsets[i + 1])
        if texts and end - begins[0] > CHUNK:
            yield texts, begins, ends
            texts, begins, ends = [], [], []
        while end - begin > CHUNK:
            yield [i], [begin], [begin + CHUNK]
            begin += CHUNK - length + 1
        texts.append(i)
        begins.append(begin)
        ends.append(end)
    if texts:
        yield texts, begins, ends


def _merged(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each text, joined where they overlap or touch."""
    order = np.lexsort([begin, text])
    text, begin, end = text[order], begin[order], end[order]
    base = text * (1 << 40)  # ends of one text never reach the next one's
    reach = np.maximum.accumulate(base + end)
    new = np.concatenate([[True], base[1:] + begin[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(text)]]) - 1
    return text[at], begin[at], reach[last] - base[last]


def _text_chunks(text: pa.Array, length: int) -> Iterator[tuple[np.ndarray, tuple]]:
    """The bytes of each chunk of a column, with the texts, begins and ends there."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1] if len(text) else [0]
    content = text.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    for texts, begins, ends in _chunks(offsets, length):
        yield data[begins[0]:ends[-1]], (offsets, texts, begins, ends)


def crowded_cells(texts: DataFrame, length: int, limit: int) -> np.ndarray:
    """Which cells of anchors have so many pieces that one anchor may have more than ``limit``.

    Counts are of all pieces; a table of 2**CELL_BITS flags results for every input.
    """
    def anchors(text: pa.Array) -> Iterator[np.ndarray]:
        for part, (_, _, begins, ends) in _text_chunks(text, length):
            yield cut_pieces(part, np.array(begins) - begins[0], np.array(ends) - begins[0], length)[0].view(np.uint64)

    counts = cell_counts(texts.select("text"), anchors, CELL_BITS)
    return counts > max(limit, 4 * int(counts.mean()))


def _scan(length: int, cells, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1).to_numpy()
            for part, (offsets, texts, begins, ends) in _text_chunks(batch.column(2), length):
                first, last = np.array(begins) - begins[0], np.array(ends) - begins[0]
                key, begin, end, anchor = cut_pieces(part, first, last, length)
                if not len(key):
                    continue
                view = memoryview(part)
                digest = np.fromiter((xxhash.xxh3_64_intdigest(view[b:e]) for b, e in zip(begin.tolist(), end.tolist())),
                                     np.uint64, len(key)).view(np.int64)
                own = np.searchsorted(first, begin, side="right") - 1
                where = np.array(texts)[own]
                shift = begins[0] - offsets[where].astype(np.int64)
                order = np.lexsort([digest, key])
                same = (key[order][1:] == key[order][:-1]) & (digest[order][1:] == digest[order][:-1])
                at = np.flatnonzero(np.concatenate([[True], ~same]))
                times = np.diff(np.concatenate([at, [len(key)]]))
                one = order[at]
                several = np.ones(len(key), bool)
                several[one[times == 1]] = False
                # Pieces that are here twice are settled: one goes on for others' sake.
                done = _merged(where[several], (begin + shift)[several], (end + shift)[several]) \
                    if several.any() else (where[:0],) * 3
                who = np.concatenate([where[one], done[0]])
                row = rows[who]
                zero = np.zeros(len(done[0]), np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([key[one], rows[done[0]]])),
                    pa.array(np.concatenate([digest[one], zero])), ids.take(pa.array(who)), pa.array(row),
                    pa.array(np.concatenate([(begin + shift)[one], done[1]])),
                    pa.array(np.concatenate([(end + shift)[one], done[2]])),
                    pa.array(np.concatenate([(anchor - begin)[one], zero]).astype(np.int32)),
                    pa.array(np.concatenate([times, zero]).astype(np.int32)),
                    pa.array(np.concatenate([cells.value[(key[one].view(np.uint64) >> np.uint64(64 - CELL_BITS))
                                                         .astype(np.int64)], zero > 0]))], names)

    return run


def _sparse_minima(x: np.ndarray) -> list[np.ndarray]:
    out, step = [x], 1
    while 2 * step <= len(x):
        out.append(np.minimum(out[-1][:-step], out[-1][step:]))
        step *= 2
    return out


def repeated_starts(data: np.ndarray, first: np.ndarray, size: np.ndarray, anchor: np.ndarray,
                    group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Places in ``data`` where a string of a piece starts that another piece of its group has, too.

    Pieces of a group, which lie next to each other, are aligned at their anchors. Each
    round inserts the symbol before the suffix of every piece, from the last column to the
    first: ``order`` is the sorted order of the suffixes, ``symbols`` their transform (the
    symbols before them, in that order) and ``common`` the prefix that each suffix shares
    with the one before it. A stable sort by symbols gives the next order; the shared
    prefix of new neighbours is one more than the least between their old places.
    """
    zero, past = first + anchor, size - anchor
    order, common = np.arange(len(first)), np.zeros(len(first), np.int16)
    found = np.zeros(len(data), bool)
    _, group = np.unique(group, return_inverse=True)
    if len(group) < 1 << 16:
        group = group.astype(np.uint16)  # sorted by counting
    for column in range(int(past.max()) - 1, -int(anchor.max()) - 1, -1):
        stays = column >= -anchor[order]
        here = order[stays]
        inserted = column < past[here]
        symbols = np.zeros(len(here), np.uint16)
        symbols[inserted] = data[zero[here[inserted]] + column].astype(np.uint16) + 1
        by_symbol = np.argsort(symbols, kind="stable")
        owner = group[here]
        moved = by_symbol[np.argsort(owner[by_symbol], kind="stable")]
        place = np.flatnonzero(stays)[moved]
        new = np.zeros(len(here), np.int16)
        symbols, owner = symbols[moved], owner[moved]
        next_to = np.flatnonzero((symbols[1:] == symbols[:-1]) & (owner[1:] == owner[:-1]) & (symbols[1:] > 0)) + 1
        if len(next_to):
            low, high = place[next_to - 1] + 1, place[next_to] + 1
            level = np.frexp(high - low)[1] - 1
            minima = _sparse_minima(common)
            least = np.empty(len(next_to), np.int16)
            for k in range(int(level.max()) + 1):
                of = np.flatnonzero(level == k)
                if len(of):
                    least[of] = np.minimum(minima[k][low[of]], minima[k][high[of] - (1 << k)])
            new[next_to] = least + 1
        order, common = here[moved], new
        shared = common >= length
        shared[:-1] |= shared[1:]
        found[zero[order[shared]] + column] = True
    return found


def _sorted_suffixes(length: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces, _ in whole_groups(batches, ["key"]):
            pieces = pieces.combine_chunks()
            key, begin, anchor = (pieces.column(c).to_numpy() for c in ("key", "begin", "anchor"))
            texts = pieces.column("bytes").to_pylist()
            size = np.array([len(t) for t in texts])
            first = np.cumsum(size) - size
            found = np.flatnonzero(repeated_starts(
                np.frombuffer(b"".join(texts), np.uint8), first, size, anchor.astype(np.int64), key, length))
            if not len(found):
                continue
            piece = np.searchsorted(first, found, side="right") - 1
            new = np.concatenate([[True], (np.diff(found) != 1) | (np.diff(piece) != 0)])
            at = np.flatnonzero(new)
            last = np.concatenate([at[1:], [len(found)]]) - 1
            owner = piece[at]
            shift = begin[owner] - first[owner]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays([
                pieces.column("doc_id").combine_chunks().take(take), pieces.column("row").combine_chunks().take(take),
                pa.array(found[at] + shift), pa.array(found[last] + shift + length)], names)

    return run


def _settle(pieces: DataFrame, label: str) -> DataFrame:
    """Pieces that share their key, with ``n`` equal ones, ``nth`` among these, ``mixed`` if the key may have others.

    One shuffle by key serves all three; pieces alone with their key go. Crowded keys
    are dealt out by the pieces' digests as well, so that equal pieces alone meet, of
    which a slice of texts sends one; they count as mixed, which is safe.
    """
    part = ["key", "spread"]
    same, everything = Window.partitionBy(*part, "digest"), Window.partitionBy(*part)
    others = F.min("digest").over(everything) != F.max("digest").over(everything)
    counted = (pieces.withColumn("spread", F.when(F.col("crowded"), F.col("digest")).otherwise(0)).repartition(*part)
               .withColumn("n", F.sum("times").over(same))
               .withColumn("nth", F.row_number().over(same.orderBy("doc_id", "row", "begin")))
               .withColumn("mixed", F.col("crowded") | others).drop("spread"))
    return stored(counted.where("n >= 2 or mixed or times = 0"), label)


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def _by_row(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of one text next to it. Both sides are sorted, at any size of either."""
    b = rows.withColumnRenamed("doc_id", "_id").withColumnRenamed("row", "_row").hint("merge")
    return docs.join(b, docs["doc_id"].eqNullSafe(b["_id"]) & (docs["row"] == b["_row"]), how).drop("_id", "_row")


def _fetched(texts: DataFrame, pieces: DataFrame, layout: str) -> DataFrame:
    """The bytes of pieces, cut out of their texts."""
    lists = pieces.groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("key", "begin", "end", "anchor")).alias("pieces"))
    names = [c.split()[0] for c in layout.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, key, begin, anchor, cut = [], [], [], [], []

            def rows() -> pa.RecordBatch:
                take = pa.array(owner, pa.int64())
                return pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(key, pa.int64()),
                    pa.array(begin, pa.int64()), pa.array(anchor, pa.int32()), pa.array(cut, pa.binary())], names)

            for i, (text, mine) in enumerate(zip(batch.column(2), batch.column(3))):
                data = text.as_py().encode()
                for k, b, e, a in zip(*(mine.values.field(f).to_pylist() for f in ("key", "begin", "end", "anchor"))):
                    owner.append(i)
                    key.append(k)
                    begin.append(b)
                    anchor.append(a)
                    cut.append(data[b:e])
                    if len(cut) == LIMIT:
                        yield rows()
                        owner, key, begin, anchor, cut = [], [], [], [], []
            if cut:
                yield rows()

    return _by_row(texts, lists, "inner").select("doc_id", "row", "text", "pieces").mapInArrow(run, layout)


def _halves(pieces: DataFrame, length: int) -> DataFrame:
    """Pieces of crowded keys in two, by where their strings start; keys gain the bytes all strings of a half have.

    ``low`` and ``high`` bound the starts of a key's strings, counted from the anchor.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    half = F.explode(F.array(F.struct(F.col("low").alias("low"), middle.alias("high")),
                             F.struct((middle + 1).alias("low"), F.col("high").alias("high"))))
    parts = (pieces.where("low < high").withColumn("half", half)
             .withColumn("low", F.col("half.low")).withColumn("high", F.col("half.high")).drop("half"))
    start = F.greatest(F.lit(0), F.col("anchor") + F.col("low"))
    last = F.least(F.octet_length("bytes") - length, F.col("anchor") + F.col("high"))
    core = F.substring("bytes", F.col("anchor") + F.col("high") + 1, F.lit(length) + F.col("low") - F.col("high"))
    return (parts.withColumn("start", start).withColumn("last", last).where("start <= last")
            .withColumn("key", F.xxhash64("key", "low", "high", core))
            .withColumn("bytes", F.substring("bytes", F.col("start") + 1, F.col("last") - F.col("start") + length))
            .withColumn("begin", F.col("begin") + F.col("start")).withColumn("anchor", F.col("anchor") - F.col("start"))
            .withColumn("end", F.col("begin") + F.octet_length("bytes"))
            .withColumn("digest", F.xxhash64("bytes", "anchor")).withColumn("times", F.lit(1))
            .withColumn("crowded", F.lit(True)).drop("start", "last"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """(doc_id, row, begin, end) of byte spans of strings that start elsewhere, too; spans may overlap.

    ``row`` is a hash that, with the id, tells texts apart. Keys with more than ``limit``
    different pieces are halved by where the strings start, which adds bytes to the key,
    until groups are small; a key of one start has equal strings only, so this ends.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").where("text is not null").withColumn("row", _row())
    scanned = PIECES.format(id=kind)
    cells = docs.sparkSession.sparkContext.broadcast(crowded_cells(texts, length, limit))
    pieces = (texts.select("doc_id", "row", "text")
              .mapInArrow(_scan(length, cells, [c.split()[0] for c in scanned.split(", ")]), scanned))
    counted = _settle(pieces, "repeats-counted")
    spans = [counted.where("n >= 2 or times = 0").select("doc_id", "row", "begin", "end")]
    now = stored(_fetched(texts, counted.where("mixed and nth = 1 and times > 0"), BYTES.format(id=kind))
                 .withColumn("low", F.lit(GRAM - length)).withColumn("high", F.lit(0)), "repeats-pieces")
    ready = []
    while True:
        crowded = now.groupBy("key").count().where(F.col("count") > limit).select("key")
        crowded = stored(crowded, "repeats-crowded")
        if crowded.isEmpty():
            break
        ready.append(now.join(crowded, "key", "left_anti"))
        counted = _settle(_halves(now.join(crowded, "key", "left_semi"), length), "repeats-halves")
        spans.append(counted.where("n >= 2").select("doc_id", "row", "begin", "end"))
        now = counted.where("mixed and nth = 1").select(*now.columns)
    grouped = now
    for one in ready:
        grouped = grouped.unionByName(one)
    layout = SPANS.format(id=kind)
    spans.append(grouped.select("key", "doc_id", "row", "begin", "anchor", "bytes")
                 .repartition("key").sortWithinPartitions("key")
                 .mapInArrow(_sorted_suffixes(length, [c.split()[0] for c in layout.split(", ")]), layout))
    result = spans[0]
    for one in spans[1:]:
        result = result.unionByName(one)
    return result


def remove_repeats(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: its bytes without those of repeated strings.

    Each byte goes that lies in a string of ``length`` bytes which also starts anywhere
    else, in another row or in the same; all occurrences go, and overlaps count. ``spans``
    are the removed runs in order; ``kept`` is binary, as a character may be cut. A null
    text is an empty one. Repeated rows are repeats of each other. Rows with null ids are
    treated alike; other columns are ignored, whatever their names; an empty table gives
    an empty one. Texts of any length are scanned in overlapping chunks.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = repeated_spans(docs, length, limit).groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("begin", "end")).alias("spans"))
    layout = KEPT.format(id=kind)
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data, mine = (text.as_py() or "").encode(), []
                if spans.is_valid and len(spans):
                    begin, end = (spans.values.field(f).to_numpy() for f in ("begin", "end"))
                    _, begin, end = _merged(np.zeros(len(begin), np.int64), begin, end)
                    mine = list(zip(begin.tolist(), end.tolist()))
                at, parts = 0, []
                for b, e in mine:
                    parts.append(data[at:b])
                    at = e
                sizes.append(len(data))
                removed.append([{"begin": b, "end": e} for b, e in mine])
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    texts = docs.select("doc_id", "text").withColumn("row", _row())
    return _by_row(texts, lists, "left").select("doc_id", "text", "spans").mapInArrow(run, layout)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from the operator's spans and kept bytes."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Every string of every text by its hexadecimal bytes; bytes of those that come twice go.
SQL = """WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS id, doc_id, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
starts AS (  -- a hash of the string from each place on
  SELECT id, unnest(list_transform(range(greatest(0, length(h) // 2 - 199)),
      lambda s: md5_number_lower(substr(h, 2 * s + 1, 400)))) AS m,
    unnest(range(greatest(0, length(h) // 2 - 199))) AS s FROM texts),
twice AS (SELECT m FROM starts GROUP BY m HAVING count(*) > 1),
found AS (SELECT id, s, s - row_number() OVER (PARTITION BY id ORDER BY s) AS run FROM starts SEMI JOIN twice USING (m)),
runs AS (SELECT id, min(s) AS b, max(s) + 200 AS e FROM found GROUP BY id, run),
spans AS (  -- runs that overlap or touch are one
  SELECT id, min(b) AS b, max(e) AS e FROM (
    SELECT *, sum(new) OVER (PARTITION BY id ORDER BY b) AS span FROM (
      SELECT *, CASE WHEN b <= lag(e) OVER (PARTITION BY id ORDER BY b) THEN 0 ELSE 1 END AS new FROM runs))
  GROUP BY id, span),
kept AS (
  SELECT id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h FROM (
    SELECT id, h, e AS a, coalesce(lead(b) OVER (PARTITION BY id ORDER BY b), length(h) // 2) AS z FROM (
      SELECT id, h, b, e FROM spans JOIN texts USING (id) UNION ALL SELECT id, h, -1, 0 FROM texts))
  GROUP BY id)
SELECT doc_id, length(t.h) // 2 AS n_bytes, length(t.h) // 2 - length(k.h) // 2 AS n_removed,
  (SELECT count(*) FROM spans s WHERE s.id = t.id) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM texts t JOIN kept k USING (id)"""
