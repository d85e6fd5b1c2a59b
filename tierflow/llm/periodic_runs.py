"""Periodic runs of words (operator 11): recursive frequency splitting, then a scan over lags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 6  # words of a run
TIMES = 4  # repetitions of its period
SLICE_BYTES = 2_000_000  # of text looked at together; a longer text is a slice of its own
WORD = r"[^\x20\x09-\x0D]+"
FOUND = "key {key}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def split_by_frequency(words: np.ndarray, owner: np.ndarray, least: int = LEAST,
                       times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """(positions, segment numbers) of the words that may belong to a run.

    Every word of a run occurs ``times`` times in it. A word that occurs less often
    in its segment cannot belong to one there, so it splits the segment; the parts
    are looked at again until nothing splits. Parts below ``least`` words go.
    """
    kinds = int(words.max(initial=0)) + 1
    place, segment, now = np.arange(len(words)), owner.astype(np.int64), words.astype(np.int64)
    done: list[np.ndarray] = []
    while len(place):
        _, which, counts = np.unique(segment * kinds + now, return_inverse=True, return_counts=True)
        keep = counts[which] >= times
        stable = np.bincount(segment, ~keep)[segment] == 0
        done.append(place[stable])
        keep &= ~stable
        place, now, segment = place[keep], now[keep], segment[keep]
        if len(place):
            segment = _numbered((np.diff(place) != 1) | (np.diff(segment) != 0))
            large = np.bincount(segment)[segment] >= least
            place, now, segment = place[large], now[large], segment[large]
    place = np.sort(np.concatenate(done)) if done else place
    segment = _numbered((np.diff(place) != 1) | (np.diff(owner[place]) != 0)) if len(place) else place
    large = np.bincount(segment)[segment] >= least if len(place) else np.zeros(0, bool)
    return place[large], segment[large]


def _numbered(breaks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(breaks)])


def _agree(words: np.ndarray, one: int, other: int, most: int, step: int) -> int:
    """How many words, from two places on (``step`` 1) or back (-1), are the same."""
    count, size = 0, 32
    while count < most:
        size = min(2 * size, most - count)
        a, b = one + step * count, other + step * count
        if step > 0:
            differ = words[a:a + size] != words[b:b + size]
        else:
            differ = (words[a - size + 1:a + 1] != words[b - size + 1:b + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return count + first
        count += size
    return count


def _has_part_period(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of this period also has a proper divisor of it as its period."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = period // factor
            if np.array_equal(words[start:start + period], words[start + part:start + part + period]):
                return True
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return False


def scan_lags(words: np.ndarray, segment: np.ndarray, least: int = LEAST,
              times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the segments, which lie one after the other.

    A run repeats its words at lag ``period`` over ``times - 1`` periods, so ``times``
    words at multiples of the lag are equal: only such places are looked at, which
    makes the scan of n words cost n/1 + n/2 + n/3 ... . Places inside a run whose
    period divides the lag are passed over: the stretch there is that run again.
    """
    if not len(words):
        return []
    at = np.arange(len(words))
    sizes = np.bincount(segment)
    ends = np.cumsum(sizes)
    inside = np.full(len(words), -1)
    periods: list[int] = []
    runs: list[tuple[int, int, int]] = []
    for lag in range(1, int(sizes.max()) // times + 1):
        fits = sizes[segment[at]] >= times * lag
        if 2 * int(fits.sum()) < len(at):  # go on with the segments that are long enough
            at = at[fits]
        marks = at[::lag]
        if len(marks) < times:
            continue
        same = words[marks[1:]] == words[marks[:-1]]
        count = len(marks) - times + 1
        hit = segment[marks[:count]] == segment[marks[times - 1:]]
        for i in range(times - 1):
            hit &= same[i:i + count]
        found = marks[:count][hit]
        run = inside[found]
        known = (run >= 0) & (run == inside[found + (times - 1) * lag])
        if known.any():
            known &= lag % np.array(periods)[run] == 0
            found = found[~known]
        for share in (2, 3, 4, 5, 7) if times > 2 else ():  # other places of the same stretch
            found = found[words[found + lag // share] == words[found + lag // share + lag]]
        passed = -1
        for place in map(int, found):
            if place < passed:
                continue
            end = int(ends[segment[place]])
            begin = end - int(sizes[segment[place]])
            right = place + _agree(words, place, place + lag, end - place - lag, 1)
            left = place - _agree(words, place - 1, place - 1 + lag, place - begin, -1)
            passed, length = right, right - left + lag
            if length >= max(least, times * lag) and not _has_part_period(words, left, lag):
                inside[left:left + length] = len(periods)
                periods.append(lag)
                runs.append((left, length, lag))
    return runs


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST,
                  times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """Per text, given as its words, the runs (start, length, period) by start, then period."""
    numbers: dict[bytes, int] = {}
    sizes = [len(words) for words in texts]
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words),
                       np.int64, sum(sizes))
    owner = np.repeat(np.arange(len(texts)), sizes)
    place, segment = split_by_frequency(flat, owner, least, times)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    first = np.cumsum([0, *sizes])
    for start, length, period in scan_lags(flat[place], segment, least, times):
        text = int(owner[place[start]])
        found[text].append((int(place[start] - first[text]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words), bool)
    for start, length, period in runs:
        dropped[start + period:start + length] = True
    return b" ".join(words[i] for i in np.flatnonzero(~dropped))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield begin, len(sizes)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
              times: int = TIMES) -> DataFrame:
    """(key, n_words, runs, collapsed) of every row.

    Words are what lies between ASCII white space. A run is a stretch of words of
    smallest period q, at least ``least`` words and ``times`` periods long, that no
    neighbouring word extends; ``runs`` lists all of them by start, then period.
    ``collapsed`` is the text with each run cut to its first period. A null or empty
    text has no words, no runs and '' as its collapsed text. Rows are independent:
    repeated rows and null keys stay as they are, other columns are ignored whatever
    their names, an empty table gives an empty one. There is no shuffle; a task works
    on a few megabytes of text at a time, or on one longer text.
    """
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _slices(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)):
                texts = batch.column(1).slice(begin, end - begin).to_pylist()
                words = [t.encode().split() if t else [] for t in texts]
                runs = runs_of_texts(words, least, times)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs],
                             pa.list_(item)),
                    pa.array([collapse(w, r).decode() for w, r in zip(words, runs)], pa.string()),
                ], ["key", "n_words", "runs", "collapsed"])

    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, FOUND.format(key=kind)).withColumnRenamed("key", key))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in the texts that the contract names, the words from one on repeat periodically."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    step = 1 + F.floor((n - F.col("a")) / (3 + g % 8))

    def word(_: Column, i: Column) -> Column:
        return F.get("words", F.when(i < F.col("a"), i).otherwise(
            F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))

    planted = F.array_join(F.transform("words", word), " ")
    return (docs.select("doc_id", "text", h.alias("h"), words.alias("words"))
            .withColumn("a", F.when(n > 0, g % n)).withColumn("p", step)
            .select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text")))


def run_digests(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from the operator's runs and collapsed texts."""
    found = find_runs(with_planted_periods(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", longest)
    period = -F.col("best.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), period.alias("period"),
        F.floor(F.col("best.length") * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
