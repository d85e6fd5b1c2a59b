"""Language of texts by Viterbi over per-word scores (operator 6).

Words are scored under a letter model of each language (a letter after its two
predecessors). The script of a word, found from code point ranges, narrows the
languages it may have. A best path that pays for each change of language labels
the words of a text; the language with most letters is the text's, its share of
the letters the score.
"""

from __future__ import annotations

import bisect
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import worker_cache
from tierflow.llm.word_bpe import Numbers, slices

# The letter model is fitted on about this many labelled rows of each language at most, chosen by a
# hash of the row: the only bound of the fit. All languages and all their letter triples are learned.
FIT_ROWS = 3_000
SWITCH = 12.0  # what a change of language costs, as a difference of log probabilities
SMOOTH = 0.5
SCRIPT_SHARE = 0.01  # of a language's letters, for a script to be one of its own
FORBIDDEN = 60.0  # what a word of a script that is not the language's costs
KEEP = 300_000  # distinct pieces a worker remembers
CELLS = 400_000  # texts x words of one best-path batch

LEAST_SCORE = 0.5  # a text whose language has a smaller share of its letters is rejected

UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")
# First code points of script ranges, and what begins there.
RANGES = [(0x41, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"),
          (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"),
          (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xB80, "tamil"),
          (0xC00, "other"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"),
          (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
          (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
          (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
          (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han")]
STARTS = [r[0] for r in RANGES]


def script(letter: str) -> str:
    """Script of a letter by its range."""
    return RANGES[max(0, bisect.bisect_right(STARTS, ord(letter)) - 1)][1]


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that no model learns from: crc32 of the id's text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words[lang].update(LETTERS.findall(text.lower()))
        rows = []
        for lang, counts in words.items():
            grams: Counter = Counter()
            for word, n in counts.items():
                padded = f"\x02\x02{word}\x03"
                for i in range(len(padded) - 2):
                    grams[padded[i:i + 3]] += n
            rows += [(lang, g, n) for g, n in grams.items()]
        lang, gram, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(gram, pa.string()),
                                          pa.array(n, pa.int64())], ["lang", "gram", "n"])


def _packed(letters: str) -> int:
    """Up to three letters as one number."""
    number = 0
    for letter in letters:
        number = number << 21 | ord(letter)
    return number


class Counts:
    """How often each language has a key: languages and counts of a key lie next to each other."""

    def __init__(self, keys: np.ndarray, languages: np.ndarray, n: np.ndarray):
        order = np.lexsort([languages, keys])
        keys, languages, n = keys[order], languages[order], n[order]
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (languages[1:] != languages[:-1]))[:len(keys)])
        self.n = np.add.reduceat(n, first) if len(first) else n
        self.languages = languages[first].astype(np.int32)
        keys = keys[first]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        self.keys, self.begin = keys[begin], np.append(begin, len(keys))

    def of(self, key: int, out: np.ndarray) -> np.ndarray:
        """Counts by language in ``out``, whose length is the number of languages."""
        out[:] = 0
        at = int(np.searchsorted(self.keys, np.uint64(key)))
        if at < len(self.keys) and self.keys[at] == key:
            part = slice(self.begin[at], self.begin[at + 1])
            out[self.languages[part]] = self.n[part]
        return out


class LetterModel:
    """Log probabilities of letters after their two predecessors, for every language at once.

    Counts are sparse, so the model's size is that of what was learned, not that times the languages.
    """

    def __init__(self, rows: list[tuple[str, str, int]] | pa.Table):
        if isinstance(rows, list):
            lang, gram, n = zip(*rows) if rows else ((), (), ())
            rows = pa.table({"lang": pa.array(lang, pa.string()), "gram": pa.array(gram, pa.string()),
                             "n": pa.array(n, pa.int64())})
        coded = rows.column("lang").combine_chunks().dictionary_encode()
        names, n = coded.dictionary.to_pylist(), rows.column("n").to_numpy()
        totals = np.bincount(coded.indices.to_numpy(), n, len(names))
        rank = sorted(range(len(names)), key=lambda i: (-totals[i], names[i]))
        self.languages = [names[i] for i in rank]
        place = np.zeros(len(names), np.int64)
        place[rank] = np.arange(len(names))
        at = place[coded.indices.to_numpy()]
        grams = np.array([_packed(g) for g in rows.column("gram").to_pylist()], np.uint64)
        letter = np.uint64((1 << 21) - 1)
        self.three = Counts(grams, at, n)
        self.two = Counts(grams & np.uint64((1 << 42) - 1), at, n)
        self.one = Counts(grams & letter, at, n)
        self.after_two = Counts(grams >> np.uint64(21), at, n)
        self.after_one = Counts(grams >> np.uint64(21) & letter, at, n)
        self.total = np.bincount(at, n, len(names))
        self.ends = len(self.one.keys) + 1
        scripts: dict[str, np.ndarray] = {}
        for code, begin, end in zip(self.one.keys.tolist(), self.one.begin[:-1], self.one.begin[1:]):
            if code != 3:  # the end of a word
                own = scripts.setdefault(script(chr(code)), np.zeros(len(names)))
                own[self.one.languages[begin:end]] += self.one.n[begin:end]
        letters = sum(scripts.values(), np.zeros(len(names)))
        # Languages a script narrows to; a script of none tells nothing.
        self.narrow = {}
        for name, counts in scripts.items():
            own = counts >= SCRIPT_SHARE * np.maximum(letters, 1)
            if own.any():
                self.narrow[name] = np.where(own, 0.0, -FORBIDDEN)
        self.spare = [np.zeros(len(names)) for _ in range(5)]
        self.forget()

    def forget(self) -> None:
        """Drop the triples' values that are kept."""
        self.numbers: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages)), np.float32)

    def log_probability(self, gram: str) -> np.ndarray:
        three, two, one, after_two, after_one = self.spare
        key = _packed(gram)
        first = (self.one.of(key & (1 << 21) - 1, one) + SMOOTH) / (self.total + SMOOTH * self.ends)
        second = (self.two.of(key & (1 << 42) - 1, two) + SMOOTH * first) / (
            self.after_one.of(key >> 21 & (1 << 21) - 1, after_one) + SMOOTH)
        third = (self.three.of(key, three) + SMOOTH * second) / (
            self.after_two.of(key >> 21, after_two) + SMOOTH)
        return np.log(third)

    def number(self, gram: str) -> int:
        known = self.numbers.get(gram)
        if known is None:
            known = self.numbers[gram] = len(self.numbers)
            if known == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[known] = self.log_probability(gram)
        return known

    def piece_scores(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores [piece, language] and the number of letters of each piece."""
        if len(self.numbers) * len(self.languages) > 4 * KEEP:
            self.forget()
        scores = np.zeros((len(pieces), len(self.languages)), np.float32)
        letters = np.zeros(len(pieces), np.int64)
        grams, owner = [], []
        for i, piece in enumerate(pieces):
            for word in LETTERS.findall(piece.lower()):
                letters[i] += len(word)
                own = self.narrow.get(script(word[0]))
                if own is None:
                    continue
                scores[i] += own
                padded = f"\x02\x02{word}\x03"
                found = [self.number(padded[j:j + 3]) for j in range(len(padded) - 2)]
                grams += found
                owner += [i] * len(found)
        if grams:
            values = self.table[grams]
            owners = np.array(owner)
            first = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
            scores[owners[first]] += np.add.reduceat(values, first, axis=0)
        return scores, letters


def best_paths(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi labels of [text, word, language] scores padded after ``sizes`` words.

    All changes cost the same, so a state's best predecessor is itself or the
    best state of all; ties stay, then go to the more frequent language.
    """
    texts, words, languages = scores.shape
    value = scores[:, 0].copy()
    top = np.zeros((texts, words), np.int16)
    stayed = np.ones((texts, words, languages), bool)
    rows = np.arange(texts)
    for t in range(1, words):
        top[:, t] = best = value.argmax(1)
        change = (value[rows, best] - switch)[:, None]
        stay = value >= change
        stayed[:, t] = stay
        value = np.where(stay, value, change)
        live = (t < sizes)[:, None]
        value += np.where(live, scores[:, t], 0)
        value -= value.max(1, keepdims=True)
    labels = np.zeros((texts, words), np.int16)
    now = value.argmax(1)
    for t in range(words - 1, -1, -1):
        labels[:, t] = now
        now = np.where(stayed[rows, t, now], now, top[:, t])
    return labels


class Labeller:
    """Labels texts with one model, remembering scores of pieces between white space."""

    def __init__(self, model: LetterModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index = Numbers()
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """(language, share of letters, runs of (language, words)) of each text."""
        if len(self.index) * max(4, len(self.model.languages)) > 4 * KEEP:
            self.forget()
        at = []
        for text in texts:
            pieces = (text or "").split()
            at.append(np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces)))
        new = self.index.take()
        if new:
            scores, letters = self.model.piece_scores(new)
            self.scores = np.concatenate([self.scores, scores])
            self.letters = np.concatenate([self.letters, letters])
        at = [x[self.letters[x] > 0] for x in at]
        found: list[tuple[str, float, list[tuple[str, int]]]] = [(UNKNOWN, 0.0, [])] * len(texts)
        if not self.model.languages:
            return found
        order = sorted((i for i, x in enumerate(at) if len(x)), key=lambda i: len(at[i]))
        while order:
            longest = len(at[order[-1]])
            many = max(1, CELLS // (longest * max(4, len(self.model.languages)) // 4))
            batch, order = order[-many:], order[:-many]
            sizes = np.array([len(at[i]) for i in batch])
            padded = np.zeros((len(batch), longest), np.int64)
            for row, i in enumerate(batch):
                padded[row, :len(at[i])] = at[i]
            labels = best_paths(self.scores[padded], sizes)
            for row, i in enumerate(batch):
                found[i] = self._sum_up(labels[row, :sizes[row]], self.letters[at[i]])
        return found

    def _sum_up(self, labels: np.ndarray, letters: np.ndarray) -> tuple:
        names = self.model.languages
        share = np.bincount(labels, letters, len(names))
        best = int(share.argmax())
        first = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
        runs = np.diff(np.append(first, len(labels)))
        return (names[best], float(share[best] / share.sum()),
                [(names[labels[f]], int(n)) for f, n in zip(first, runs)])


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> pa.Table | list:
    """Letter triples (lang, gram, n) of labelled rows that are not held out.

    Only text and non-null lang are learned from, of each language about ``rows`` rows
    at most; a rarer language is learned from all its rows. What reaches the driver and
    the tasks is the model: a row for each triple of each language. Without any labelled
    row it is empty.
    """
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        ~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    parts = 1_000_000_000
    limits = labelled.groupBy("lang").agg(
        F.least(F.lit(parts), F.ceil(F.lit(float(parts) * rows) / F.count(F.lit(1)))).alias("limit"))
    sample = (labelled.join(F.broadcast(limits), "lang")  # a row for each language, as in the model
              .where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) < F.col("limit")))
    learned = (sample.select("lang", "text").mapInArrow(_triples, "lang string, gram string, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toArrow())
    return learned if len(learned) else []


LABELLED = ("key {key}, lang_pred string, score double, "
            "spans array<struct<lang:string,words:long>>")


def _labeller(name: str, triples: pa.Table | list[tuple[str, str, int]]) -> Labeller:
    """The worker's labeller of a model."""
    return worker_cache(("language", name), lambda: Labeller(LetterModel(triples)))


def _text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    yield from slices(pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False))


def label_languages(docs: DataFrame, triples: pa.Table | list[tuple[str, str, int]], key: str = "doc_id",
                    spans: bool = True) -> DataFrame:
    """(key, lang_pred, score, spans) of every row's whole text.

    Null texts and texts without letters are 'und' with score 0 and no spans; so
    is every text if nothing was learned. Spans count words with letters. Repeated
    rows and null keys stay; other columns are ignored; there is no shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(triples)  # of FIT_ROWS rows a language
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(name, model.value)
        run_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
        for batch in batches:
            texts = batch.column(1)
            for begin, end in _text_slices(texts):
                found = labeller.label(texts.slice(begin, end - begin).to_pylist())
                runs = [[{"lang": a, "words": n} for a, n in f[2]] if spans else None for f in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()), pa.array(runs, run_type)],
                    ["key", "lang_pred", "score", "spans"])

    return (docs.select(F.col(key).alias("key"), F.col("text"))
            .mapInArrow(run, LABELLED.format(key=kind)).withColumnRenamed("key", key))


def keep_labelled(docs: DataFrame, triples: pa.Table | list[tuple[str, str, int]],
                  least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs`` whose text has a language with at least ``least`` of its letters.

    Rejected are 'und' and texts of which no language has such a share. All
    columns stay; rows that repeat stay or go together.
    """
    model = docs.sparkSession.sparkContext.broadcast(triples)  # of FIT_ROWS rows a language
    name, at = uuid.uuid4().hex, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(name, model.value)
        for batch in batches:
            texts = batch.column(at)
            for begin, end in _text_slices(texts):
                found = labeller.label(texts.slice(begin, end - begin).to_pylist())
                yield batch.slice(begin, end - begin).filter(
                    pa.array([f[0] != UNKNOWN and f[1] >= least for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predicted_languages(docs: DataFrame) -> DataFrame:
    """Contract columns of the language query."""
    return label_languages(docs, fit(docs), spans=False).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
