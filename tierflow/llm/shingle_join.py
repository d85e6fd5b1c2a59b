"""Exact n-gram Jaccard self-join with a token-group matrix (operator 5).

1. Every text becomes its set of hashed word shingles. Texts with equal sets are
   one class from here on. A table of fixed size counts tokens by their cells, so
   that tokens can be put in order, rare ones first.
2. Prefix tokens: in that order, two sets that are similar enough share several of
   their first n - ceil(t n) + l tokens, l being a small part of n. Tokens of
   passages that many texts have come late and are in few prefixes. Classes with
   fewer tokens there that any other class has are left out.
3. Each class joins the group of the smallest class it shares most prefix tokens
   with: groups of similar documents, cut into blocks of bounded size.
4. Each block is searched with its own members and its group's leader. Members that
   are connected by then need no further link between them. The union of the
   block's tokens is stored, as a bitmap.
5. The matrix, prefix token by block, is read in Spark: a class of a smaller
   component is a query to the blocks where a larger one has enough of its prefix
   tokens. The query's overlap with the stored union bounds its overlap with each
   member. Only blocks where that reaches t of the query are opened, that is, their
   texts are fetched and shingled, and members are checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import cell_counts, components, free_name, stored, worker_cache
from tierflow.session import settings
from tierflow.llm.word_bpe import Numbers, slices

WORDS = 5
PERCENT = 80
BLOCK_ROWS = 128
BLOCK_BYTES = 2 << 20
FILTER_BITS = 1 << 23
# Prefix tokens of a set beyond those that make one shared token certain, per cent of its size.
MORE = 2
CELL_BITS = 22  # of a token's hash: its cell in the table of counts
UNION_BITS = 16  # of a block's bitmap for each token of its union
QUERIES = 256  # queries to a block that are looked at together

# Joins are the same at every size, so none is a broadcast because a table happens to be small;
# texts, and blocks of texts, go to a task's Python in small batches.
PLANNING = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
BLOCKS_AT_ONCE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "32"}

KEEP = 100_000  # distinct words a worker remembers
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of 64-bit shingle hashes of texts, remembering the hashes of words."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.index, self.hashes = Numbers(), np.zeros(0, np.uint64)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text; a text of fewer words is one shingle."""
        if len(self.index) > KEEP:
            self.index, self.hashes = Numbers(), np.zeros(0, np.uint64)
        at = []
        for text in texts:
            words = (text or "").encode().translate(LOWER).split()
            at.append(np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)))
        new, end = self.index.take(), len(self.index)
        if end > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(max(end, 1 << 16), np.uint64)])
        self.hashes[end - len(new):end] = [xxhash.xxh64_intdigest(w) for w in new]
        return [self._set(self.hashes[x]) for x in at]

    def _set(self, words: np.ndarray) -> np.ndarray:
        n = len(words)
        if not n:
            return words
        size = min(n, self.words)
        shingles = words[:n - size + 1].copy()
        for i in range(1, size):
            shingles *= BASE
            shingles += words[i:n - size + 1 + i]
        return np.unique(mixed(shingles + np.uint64(size)))


def shingler(words: int) -> Shingler:
    """The worker's shingler."""
    return worker_cache(("shingles", words), lambda: Shingler(words))


def least_overlap(n: int, percent: int) -> int:
    """Tokens a set of n shares at least with a set that is similar enough."""
    return -(-percent * n // 100)


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """Prefix tokens of a set of n, and how many of them a similar enough set shares at least.

    The j-th of at least o = least_overlap(n) shared tokens comes among the first
    n - o + j of the set. The other set has o tokens or more and a prefix made
    the same way, so the first MORE per cent of o are shared in both prefixes.
    """
    overlap = least_overlap(n, percent)
    return min(n, n - overlap + max(1, MORE * n // 100)), max(1, MORE * overlap // 100)


def token_levels(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """How many rows have a token of each cell, as four times the binary logarithm: 4 MB for every input."""
    def tokens(texts: pa.Array) -> Iterator[np.ndarray]:
        hashed = shingler(words)
        for begin, end in slices(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)):
            yield from hashed.sets(texts.slice(begin, end - begin).to_pylist())

    counts = cell_counts(docs.select("text"), tokens, CELL_BITS)
    return np.ceil(4 * np.log2(counts + 1)).astype(np.uint8)


def ordered(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Numbers for tokens that put those of emptier cells first."""
    level = levels[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(55)) | (tokens >> np.uint64(9))


def first_tokens(tokens: np.ndarray, levels: np.ndarray, many: int) -> np.ndarray:
    """The first ``many`` of the ordered numbers, in any order."""
    numbers = ordered(tokens, levels)
    return np.partition(numbers, many - 1)[:many] if many < len(numbers) else numbers


def shingle_sets(docs: DataFrame, levels: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, prefix, bytes) of every row: size, two hashes of
    the whole set, its prefix tokens and the size of the text. Of equal sets that
    one slice of texts holds the first with a doc_id alone has its prefix."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared_levels = docs.sparkSession.sparkContext.broadcast(levels)  # of one size for every input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, by_cell = shingler(words), shared_levels.value
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for begin, end in slices(sizes):
                part = texts.slice(begin, end - begin)
                sets = hashed.sets(part.to_pylist())
                sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                others = np.array([np.bitwise_xor.reduce(mixed(s ^ BASE)) if len(s) else 0
                                   for s in sets], np.uint64).view(np.int64)
                named = np.flatnonzero(batch.column(0).slice(begin, end - begin).is_valid().to_numpy(
                    zero_copy_only=False))
                own = set(named[np.unique(sums[named], return_index=True)[1]].tolist())
                prefixes = [first_tokens(s, by_cell, prefix_sizes(len(s), percent)[0]).view(np.int64)
                            if i in own and len(s) else np.zeros(0, np.int64) for i, s in enumerate(sets)]
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin),
                    pa.array(list(map(len, sets)), pa.int64()), pa.array(sums), pa.array(others),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pc.binary_length(part).fill_null(0).cast(pa.int64())],
                    ["doc_id", "n_shingles", "s1", "s2", "prefix", "bytes"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, prefix array<long>, bytes long")


class Block:
    """Members of a block and their tokens: (token, member) pairs in token order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        members = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.members = members[order]
        tokens = tokens[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])[:len(tokens)])
        self.union = tokens[first]
        self.starts = np.append(first, len(tokens))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members similar enough to the query; empty if the union rules the block out."""
        at = np.searchsorted(self.union, query)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == query] if len(self.union) else at[:0]
        if len(at) < least_overlap(len(query), percent) or not len(at):
            return np.zeros(0, np.int64)
        begin, many = self.starts[at], self.starts[at + 1] - self.starts[at]
        inside = np.arange(int(many.sum())) + np.repeat(begin - np.cumsum(many) + many, many)
        shared = np.bincount(self.members[inside], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= percent * (len(query) + self.sizes - shared))


class Union:
    """A bitmap of the tokens of a block, UNION_BITS for each; other tokens may seem to be there."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, tokens: np.ndarray) -> Union:
        size = 1 << max(10, int(UNION_BITS * len(tokens)).bit_length())
        bits = np.zeros(size // 8, np.uint8)
        at = (tokens % np.uint64(size)).astype(np.int64)
        np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return cls(bits)

    def most_shared(self, query: np.ndarray) -> int:
        """A bound of the tokens that the query shares with any member of the block."""
        at = (query % np.uint64(8 * len(self.bits))).astype(np.int64)
        return int(((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).sum())


FOUND = "a long, b long, g long, block int, tokens binary"
LINKS = "a long, b long"


def _inside(words: int, percent: int):
    """Links in a block, and the union of its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = shingler(words)
        for batch in batches:
            for g, b, ids, texts in zip(*(batch.column(i) for i in range(4))):
                sets = hashed.sets(texts.as_py())
                ids = np.array(ids.as_py())
                links: list[tuple[int, int]] = []
                # Components inside the block: a member joins what it links with.
                root = np.arange(len(ids))
                block = Block(sets)
                for i, tokens in enumerate(sets):
                    for j in block.linked(tokens, percent):
                        one, other = root[i], root[j]
                        if one != other:
                            root[root == max(one, other)] = min(one, other)
                            links.append((int(ids[i]), int(ids[j])))
                n = len(links)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, _ in links] + [None], pa.int64()),
                    pa.array([x for _, x in links] + [None], pa.int64()),
                    pa.array([None] * n + [g.as_py()], pa.int64()), pa.array([None] * n + [b.as_py()], pa.int32()),
                    pa.array([None] * n + [Union.of(block.union).bits.tobytes()], pa.binary())],
                    [c.split()[0] for c in FOUND.split(", ")])

    return run


def _query_sets(words: int):
    """(key, id, component, tokens) of queries, from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = shingler(words)
        for batch in batches:
            for begin, end in slices(pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False)):
                part = batch.slice(begin, end - begin)
                sets = hashed.sets(part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())],
                    ["key", "id", "component", "tokens"])

    return run


def _bounded(percent: int):
    """Queries to a block whose bound by the block's union is large enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, b, union, queries in zip(*(batch.column(i) for i in range(4))):
                bits = Union(np.frombuffer(union.as_py(), np.uint8))
                keys = []
                for key, tokens in zip(queries.values.field("key"), queries.values.field("tokens")):
                    tokens = np.frombuffer(tokens.as_py(), "<u8")
                    if bits.most_shared(tokens) >= least_overlap(len(tokens), percent):
                        keys.append(key.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([g.as_py()] * len(keys), pa.int64()),
                     pa.array([b.as_py()] * len(keys), pa.int32())], ["key", "g", "b"])

    return run


def _opened(words: int, percent: int):
    """Links of queries with members of an opened block, one for each other component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = shingler(words)
        for batch in batches:
            for members, queries in zip(batch.column(0), batch.column(1)):
                ids, owners = (members.values.field(c).to_numpy() for c in ("id", "component"))
                block = Block(hashed.sets(members.values.field("text").to_pylist()))
                links: list[tuple[int, int]] = []
                for query, component, tokens in zip(*(queries.values.field(c) for c in ("id", "component", "tokens"))):
                    found = block.linked(np.frombuffer(tokens.as_py(), "<u8"), percent)
                    found = found[owners[found] != component.as_py()]
                    for i in np.unique(owners[found], return_index=True)[1]:
                        links.append((query.as_py(), int(ids[found[i]])))
                yield _link_batch(links)

    return run


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def similar_texts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id long, text).

    Two texts link when 100 x shared shingles >= percent x all shingles of both;
    a component is what links connect, named by its smallest doc_id. Null and
    empty texts have no shingles and link with nothing, nor do rows with a null
    doc_id (component null). Rows that share a doc_id share its component.
    Other columns are ignored; an empty table gives an empty one.
    """
    with settings(docs.sparkSession, PLANNING):
        sets, own = _decided(docs, words, percent)
    return (sets.join(own.hint("merge"), ["s1", "s2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
                "_component", "doc_id")).alias("component_id")))


def _decided(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sets of all rows, classes of equal sets with their component), both written."""
    spark = docs.sparkSession
    sets = stored(shingle_sets(docs, token_levels(docs, words), words, percent), "shingle-sets")
    with_text = sets.where("n_shingles > 0 and doc_id is not null")
    classes = stored(with_text.groupBy("s1", "s2", "n_shingles").agg(
        F.min("doc_id").alias("id"), F.max("bytes").alias("bytes")), "shingle-classes")
    # Postings name a class by its first hash, so equal sets are one without a join.
    sizes = classes.groupBy(F.col("s1").alias("key")).agg(F.min("n_shingles").alias("n"))
    postings = with_text.select(F.col("s1").alias("key"), F.explode("prefix").alias("token"))
    shared = stored(_shared(postings).drop("low"), "shingle-postings")
    shared = stored(_shared(_enough(shared, sizes, percent)).distinct(), "shingle-postings")
    named = classes.select(F.col("s1").alias("key"), "id", F.col("n_shingles").alias("n"), "bytes")
    blocks = stored(_blocks(shared, named), "shingle-groups")
    texts = stored(_with_texts(blocks.select("id", "g", "b"), docs.select(F.col("doc_id").alias("id"), "text")),
                   "shingle-texts")
    with settings(spark, BLOCKS_AT_ONCE):
        inside = stored(_links_inside(blocks, texts, words, percent), "shingle-inside")
    first = inside.where("a is not null").select("a", "b")
    unions = inside.where("g is not null").select("g", F.col("block").alias("b"), "tokens")
    parts = stored(components(first), "shingle-parts")
    with settings(spark, BLOCKS_AT_ONCE):
        more = stored(_links_across(shared, blocks, unions, texts, parts, words, percent), "shingle-links")
    final = components(first.union(more)).withColumnRenamed("node", "id")
    return sets, stored(classes.join(final, "id", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("component", "id").alias("_component")), "shingle-decided")


def _shared(postings: DataFrame) -> DataFrame:
    """Postings (token, key) of tokens that more than one class has, with the smallest of them.

    A class posts a token once for each slice of texts, and hundreds of tokens
    besides, so one token has a small part of the rows. The window's rows spill
    if they must.
    """
    own = Window.partitionBy("token")
    return (postings.select("token", "key", F.min("key").over(own).alias("low"),
                            F.max("key").over(own).alias("high"))
            .where("low <> high").drop("high"))


def _enough(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Postings of classes that share as many prefix tokens as a similar class would have.

    Tokens posted by several slices count more than once, which keeps a class.
    """
    overlap = F.ceil(F.col("n") * percent / 100)
    few = (shared.groupBy("key").agg(F.count("*").alias("found")).join(sizes, "key")
           .where(F.col("found") < F.greatest(F.lit(1), F.floor(overlap * MORE / 100))).select("key"))
    return shared.select("token", "key").join(few, "key", "left_anti")


def _blocks(shared: DataFrame, named: DataFrame) -> DataFrame:
    """(key, id, n, g, leader, b): each class's group, that of the leader, and its block there."""
    leaders = (shared.groupBy("key", "low").agg(F.count("*").alias("found"))
               .groupBy("key").agg(F.max(F.struct(
                   # a leader other than the class itself first
                   (F.col("low") < F.col("key")).alias("other"), F.col("found").alias("found"),
                   F.col("low").alias("low"))).alias("best"))
               .select("key", F.col("best.low").alias("g")).join(named, "key"))
    leaders = stored(leaders, "shingle-leaders")
    sizes = leaders.groupBy("g").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    leader = named.groupBy(F.col("key").alias("g")).agg(F.min("id").alias("leader"))
    return leaders.join(sizes, "g").join(leader, "g").select(
        "key", "id", "n", "g", "leader", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("b"))


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` with the text of their id.

    A table of FILTER_BITS bits of hashed ids, at most FILTER_BITS / 64 rows
    whatever the input, is broadcast and lets most other texts go before the
    shuffle of the exact join.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bits = rows.select(bit.alias("bit")).distinct().groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    near = (texts.select("id", "text").withColumn("bit", bit).withColumn("word", (F.col("bit") / 64).cast("int"))
            .join(F.broadcast(bits), "word")
            .where(F.expr("shiftrightunsigned(bits, cast(bit % 64 as int)) & 1L = 1L"))
            .select("id", "text"))
    return rows.join(near, "id")


def _links_inside(blocks: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that connect what is connected inside each block together with its leader, and its union."""
    own = blocks.select(F.col("id").alias("leader"), "g", F.col("b").alias("home"))
    guests = (blocks.select("leader", "g", "b").distinct().join(own, ["leader", "g"], "left")
              .where("home is null or home <> b").select(F.col("leader").alias("id"), "g", "b"))
    members = texts.select("id", "g", "b", "text").unionByName(_with_texts(guests, texts))
    filled = members.groupBy("g", "b").agg(
        F.collect_list(F.struct("id", "text")).alias("members"))
    return filled.select("g", "b", F.col("members.id").alias("ids"), F.col("members.text").alias("texts")).mapInArrow(
        _inside(words, percent), FOUND)


def _dealt(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """(g, b, queries): the queries to each block, in lists of about QUERIES."""
    many = pairs.groupBy("g", "b").agg(F.ceil(F.count("*") / QUERIES).alias("parts"))
    return (pairs.join(many, ["g", "b"]).withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
            .join(sets, "key").groupBy("g", "b", "part").agg(F.collect_list(F.struct(*columns)).alias("queries")))


def _links_across(shared: DataFrame, blocks: DataFrame, unions: DataFrame, texts: DataFrame, parts: DataFrame,
                  words: int, percent: int) -> DataFrame:
    """Links between components: classes of the smaller one are queries to blocks of the larger one.

    A query goes to a block that has enough of its prefix tokens from larger
    components and members of fitting sizes; so a component of many members
    is asked by the few others, not each of its members by all.
    """
    owned = blocks.join(parts, blocks.id == parts.node, "left").select(
        "key", "id", "g", "b", F.coalesce("component", "id").alias("component"), "n")
    owned = stored(owned, "shingle-owned")
    large = owned.groupBy("component").agg(F.count("*").alias("members"))
    # Dealt by token once: both sides of the join are made of the same columns of the same rows.
    ranks = owned.join(large, "component").select("key", "g", "b", F.col("n").cast("int").alias("n"), "members", "component")
    entries = shared.select("token", "key").join(ranks, "key").repartition("token")
    rank = F.struct("members", "component")
    cells = (entries.groupBy("token", "g", "b").agg(
        F.max(rank).alias("top"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("key").alias("last"))
        .select(F.col("token").alias("t"), F.col("g").alias("g2"), F.col("b").alias("b2"), "top", "least", "most", "last"))
    fits = (F.col("top") > rank) & (F.col("most") * 100 >= F.col("n") * percent) & (
        F.col("least") * percent <= F.col("n") * 100) & F.col("last").isNotNull()
    elsewhere = (F.col("g") != F.col("g2")) | (F.col("b") != F.col("b2"))  # its own block has been searched
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) * MORE / 100))
    pairs = stored(entries.join(cells, F.col("token") == F.col("t")).where(fits & elsewhere)
                   .groupBy("key", "n", "g2", "b2").agg(F.count("*").alias("found")).where(F.col("found") >= least)
                   .select("key", F.col("g2").alias("g"), F.col("b2").alias("b")), "shingle-pairs")
    asked = owned.select("key", "id", "component").join(pairs.select("key").distinct(), "key", "left_semi")
    sets = stored(_with_texts(asked, texts).select("key", "id", "component", "text").mapInArrow(
        _query_sets(words), "key long, id long, component long, tokens binary"), "shingle-queries")
    bound = stored(_dealt(pairs, sets, "key", "tokens").join(unions, ["g", "b"])
                   .select("g", "b", "tokens", "queries")
                   .mapInArrow(_bounded(percent), "key long, g long, b int"), "shingle-bound")
    open_ = bound.select("g", "b").distinct()
    members = (_with_texts(owned.join(open_, ["g", "b"], "left_semi").select("id", "g", "b", "component"), texts)
               .groupBy("g", "b").agg(F.collect_list(F.struct("id", "component", "text")).alias("members")))
    return (_dealt(bound, sets, "id", "component", "tokens").join(members, ["g", "b"])
            .select("members", "queries").mapInArrow(_opened(words, percent), LINKS))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each component; all columns stay.

    A document is a doc_id with its text: where texts share a doc_id, each is
    decided by its own links, and of several of one component one stays. Rows
    that link with nothing, null ids among them, all stay, and so do all rows
    that repeat a kept doc_id and text.
    """
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    document = free_name(docs, "_document")
    named = docs.withColumn(document, F.when(
        F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    known = named.where("doc_id is not null").select(
        F.col(document).alias("_document"), "doc_id", "text", F.xxhash64("text", "doc_id").alias("_other"))
    found = similar_texts(known.select(F.col("_document").alias("doc_id"), "text"), words, percent)
    members = found.where("component_id is not null").select(
        F.col("doc_id").alias("_document"), "component_id").distinct()
    # Where two documents have one hash, neither is dropped.
    ids = known.groupBy("_document").agg(F.min("doc_id").alias("doc_id"), F.min("_other").alias("_low"),
                                         F.max("_other").alias("_high")).where("_low = _high")
    members = stored(members.join(ids.select("_document", "doc_id"), "_document"), "shingle-members")
    kept = members.groupBy("component_id").agg(
        F.min(F.struct("doc_id", "_document")).alias("_first")).select(F.col("_first._document"))
    gone = members.select("_document").join(kept, "_document", "left_anti").withColumnRenamed("_document", "_gone")
    return named.join(gone, named[document] == gone["_gone"], "left_anti").select(*columns)
