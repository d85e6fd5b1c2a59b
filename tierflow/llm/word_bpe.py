"""Word-end BPE encoding by a depth-first walk over the prefixes of distinct words.

The encoding of a word is fixed by the last token of each of its prefixes: a
token ends the encoding of a prefix exactly if it stands beside the last token
of the rest without a merge across their border coming first. Distinct words
are walked in sorted order, which is the depth-first order of their trie; a
word keeps the last-token states of the prefix it shares with the word before,
so shared prefixes are computed once.

A text is cut at white space, which no token spans, and each distinct piece is
normalised and encoded once for all its occurrences in a worker.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
from tokenizers import Tokenizer

from tierflow.llm.common import worker_cache

WORD_END = "</w>"
NEVER = 1 << 40
# Pieces of these characters follow the pre-tokenizer's pattern in Python too;
# others go through the library.
PLAIN = regex.compile(r"[\x21-\x7eÀ-ɏ]+")
# Fixed value: the splitting pattern of the tokenizer file.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# str.split() also splits at these four, which are not white space in Unicode.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
SLICE_BYTES = 4 << 20  # text encoded at once
KEEP = 400_000  # distinct pieces a worker remembers
MEMO = 1_000_000  # token pairs a worker remembers


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes
    stand for themselves, the others for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Numbers(dict):
    """Numbers keys in the order they first come; ``fresh`` lists those not taken yet."""

    def __init__(self, items: Iterable[tuple[str, int]] = ()):
        super().__init__(items)
        self.fresh: list = []

    def __missing__(self, key: str | bytes) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number

    def take(self) -> list:
        """The keys that came since the last call."""
        fresh, self.fresh = self.fresh, []
        return fresh


class Borders(dict):
    """Whether two tokens, as first << 20 | second, stay apart when their texts meet."""

    def __init__(self, crosses: Callable[[int, int, int], bool]):
        super().__init__()
        self.crosses = crosses

    def __missing__(self, key: int) -> bool:
        if len(self) >= MEMO:
            self.clear()
        self[key] = known = not self.crosses(key >> 20, key & 0xFFFFF, NEVER)
        return known


class WordBpe:
    """Encoder of one tokenizer file (BPE with word ends, byte letters)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_str(json.dumps({**spec, "truncation": None, "padding": None}))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        model = spec["model"]
        self.names = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        self.tokens = np.array([self.names.get(i, "") for i in range(max(self.names) + 1)], object)
        self._read_vocabulary(model)
        self.lengths = np.zeros(0, np.int64)
        self.forget()

    def _read_vocabulary(self, model: dict) -> None:
        letters, vocab = byte_letters(), model["vocab"]
        self.plain, self.final, text = {}, {}, {}
        for token, i in vocab.items():
            ends = token.endswith(WORD_END)
            raw = bytes(letters[c] for c in (token[:-len(WORD_END)] if ends else token))
            text[token] = raw
            (self.final if ends else self.plain)[raw] = i
        self.rank, self.right, self.left = {}, {}, {}
        for i in vocab.values():
            self.right[i] = self.left[i] = [(i, NEVER)]
        reachable = {i for t, i in vocab.items() if len(text[t]) == 1}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            first, second = vocab[a], vocab[b]
            whole = vocab[a + b]
            self.rank[first, second] = rank
            if first in reachable and second in reachable and not self._crosses(
                    first, second, rank):
                reachable.add(whole)
            self.right[whole] = [(t, min(c, rank)) for t, c in self.right[second]] + [(whole, NEVER)]
            self.left[whole] = [(t, min(c, rank)) for t, c in self.left[first]] + [(whole, NEVER)]
        self.plain = {k: i for k, i in self.plain.items() if i in reachable}
        self.final = {k: i for k, i in self.final.items() if i in reachable}
        self.longest = max(map(len, self.plain)), max(map(len, self.final))
        self.memo = Borders(self._crosses)

    def _crosses(self, first: int, second: int, before: int) -> bool:
        """Whether a merge across the border comes before both sides are whole.

        A side's outer token lasts until the merge that takes it up. Of equal
        merges the left one comes first.
        """
        rank = self.rank
        for a, until_a in self.right[first]:
            for b, until_b in self.left[second]:
                m = rank.get((a, b))
                if m is not None and m < before and m < until_a and m <= until_b:
                    return True
        return False

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """(word, ids) of distinct non-empty words given in sorted order.

        ``last[d]`` is the last token of the prefix of d bytes, ``size[d]`` its bytes.
        """
        plain, final, beside = self.plain.get, self.final.get, self.memo.__getitem__
        longest, longest_final = self.longest
        last, size, before = [0], [0], b""
        for word in words:
            end = len(word)
            known = min(len(last), end) - 1
            shared = 0
            while shared < known and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for d in range(shared + 1, end):
                # Exactly one start is right. Most likely the last token goes on,
                # or the byte stands alone.
                start = d - 1 - size[d - 1]
                token = plain(word[start:d])
                if token is None or start and not beside(last[start] << 20 | token):
                    start = d - 1
                    token = plain(word[start:d])
                    if token is None or start and not beside(last[start] << 20 | token):
                        for start in range(max(0, d - longest), d - 1):
                            token = plain(word[start:d])
                            if token is not None and (
                                    not start or beside(last[start] << 20 | token)):
                                break
                        else:
                            raise ValueError(f"no encoding of {word!r}")
                last.append(token)
                size.append(d - start)
            start = end - 1 - size[end - 1]
            token = final(word[start:])
            if token is None or start and not beside(last[start] << 20 | token):
                for start in (end - 1, *range(max(0, end - longest_final), end - 1)):
                    token = final(word[start:])
                    if token is not None and (not start or beside(last[start] << 20 | token)):
                        break
                else:
                    raise ValueError(f"no encoding of {word!r}")
            ids = [token]
            while start:
                ids.append(last[start])
                start -= size[start]
            ids.reverse()
            before = word
            yield word, ids

    def words_of(self, piece: str) -> list[bytes | int]:
        """The words of a piece without white space; special tokens as their ids."""
        last = piece[-1]
        body = piece if last.isalpha() else piece[:-1]
        # Letters below U+0250 are composed, lower alone, and one word for the pattern.
        lower = body.lower()
        if lower.isalpha() and max(lower) < "ɐ" and (body is piece or last in ",.;:!?"):
            return [lower.encode()] if body is piece else [lower.encode(), last.encode()]
        if PLAIN.fullmatch(piece) and "<|" not in piece:
            lower = unicodedata.normalize("NFC", piece).lower()
            return [w.encode() for w in WORDS.findall(lower)]
        return self._with_special(piece)

    def _with_special(self, piece: str) -> list[bytes | int]:
        found: list[bytes | int] = []
        letters = byte_letters()
        for part in self.cut.split(piece):
            if part in self.special:
                found.append(self.special[part])
            elif part:
                split = self.library.pre_tokenizer.pre_tokenize_str(
                    self.library.normalizer.normalize_str(part))
                found += [bytes(letters[c] for c in w) for w, _ in split]
        return found

    def forget(self) -> None:
        """Drop the remembered pieces, but for those that came often."""
        often = np.zeros(0, np.int64)
        if len(self.lengths):
            often = np.flatnonzero(self.uses >= 8)
            if len(often) > KEEP // 4:
                often = np.sort(often[np.argsort(self.uses[often])[-KEEP // 4:]])
            pieces = list(self.index)
            kept = [pieces[i] for i in often]
            ids = take_ranges(self.flat, self.starts[often], self.lengths[often])
            self.index = Numbers((p, i) for i, p in enumerate(kept))
            self.flat, self.lengths = ids, self.lengths[often]
            self.starts = np.cumsum(self.lengths) - self.lengths
        else:
            self.index, self.flat = Numbers(), np.zeros(0, np.uint32)
            self.starts = np.zeros(0, np.int64)
        self.uses = np.zeros(len(self.lengths), np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces: one walk over the distinct words of all of them."""
        parts = [self.words_of(p) for p in pieces]
        ids = dict(self.walk(sorted({w for part in parts for w in part if w.__class__ is bytes})))
        flat: list[int] = []
        lengths = []
        for part in parts:
            held = len(flat)
            for w in part:
                if w.__class__ is bytes:
                    flat += ids[w]
                else:
                    flat.append(w)
            lengths.append(len(flat) - held)
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])
        self.lengths = np.concatenate([self.lengths, np.array(lengths, np.int64)])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        # Many small lists and no cycles: the collector would only walk them.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > KEEP:
            self.forget()
        index = self.index
        at: list[np.ndarray] = []
        for text in texts:
            text = text or ""
            pieces = SPACES.split(text) if SEPARATORS.search(text) else text.split()
            if SEPARATORS.search(text):
                pieces = [p for p in pieces if p]
            at.append(np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces)))
        new = index.take()
        if new:
            self._learn(new)
        every = np.concatenate(at) if at else np.zeros(0, np.int64)
        self.uses += np.bincount(every, minlength=len(self.uses))
        ids = take_ranges(self.flat, self.starts[every], self.lengths[every])
        sizes = np.array([self.lengths[x].sum() for x in at], np.int64)
        return ids, sizes

    def decode(self, ids: np.ndarray) -> str:
        """The text the library decodes the ids to: without a decoder the tokens
        joined by spaces."""
        return " ".join(self.tokens[ids])


def take_ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[s:s+n] of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    step = np.ones(total, np.int64)
    ends = np.cumsum(lengths)
    full = lengths > 0
    first = (ends - lengths)[full]
    starts, sizes = starts[full], lengths[full]
    step[first[0]] = starts[0]
    step[first[1:]] = starts[1:] - starts[:-1] - sizes[:-1] + 1
    return flat[np.cumsum(step)]


def slices(sizes: Iterable, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``; a larger row stays whole."""
    begin, held, i = 0, 0, -1
    for i, size in enumerate(map(int, sizes)):
        if i > begin and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin <= i:
        yield begin, i + 1


def encoder(path: str) -> WordBpe:
    """The worker's encoder of a tokenizer file."""
    return worker_cache(("bpe", path), lambda: WordBpe(path))
