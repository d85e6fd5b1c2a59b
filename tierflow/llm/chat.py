"""Chat formatting by columnar byte assembly (operator 8), and reading it back.

A turn becomes header, escaped text and footer by its role::

    system     <<SYS>>text<</SYS>>
    user       [INST] text [/INST]
    assistant  <s>text</s>                              (text under the loss mask)
    other      <<ROLE>>role<<TEXT>>text<</ROLE>>

Inside texts and role names a backslash is doubled and every mark gets a
backslash after its first character, so no mark of a text survives and the
change can be undone: of two backslashes one stays, a single one goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of the template.
HEADERS = {"system": "<<SYS>>", "user": "[INST] ", "assistant": "<s>"}
FOOTERS = {"system": "<</SYS>>", "user": " [/INST]", "assistant": "</s>"}
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", *OTHER)
TURN = regex.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|<<ROLE>>(?P<role>.*?)<<TEXT>>(?P<other>.*?)<</ROLE>>", regex.DOTALL)
BREAK = regex.compile(r"\\(\\?)")

LONG_BYTES = 1 << 16  # texts from here on are copied one by one
FORMATTED = ("conv_id {key}, n_turns long, formatted string, formatted_chars long, "
             "loss_spans array<struct<start:long,end:long>>")


def escape(texts: pa.Array) -> pa.Array:
    """Texts without marks; undone by ``unescape``."""
    texts = pc.replace_substring(texts, "\\", "\\\\")
    for mark in MARKS:
        texts = pc.replace_substring(texts, mark, mark[0] + "\\" + mark[1:])
    return texts


def unescape(text: str) -> str:
    """The text before ``escape``."""
    return BREAK.sub(r"\1", text) if "\\" in text else text


def assemble(segments: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Row by row the bytes of all columns after one another, in one buffer.

    Returns the buffer and the offsets of [row, column] cells, with the end of
    the last. Lengths give offsets by a cumulative sum; the bytes of short cells
    are scattered by computed indices, long ones copied whole.
    """
    rows, columns = len(segments[0]), len(segments)
    lengths = np.empty((rows, columns), np.int64)
    for c, column in enumerate(segments):
        lengths[:, c] = pc.binary_length(column).to_numpy(zero_copy_only=False)
    offsets = np.zeros(rows * columns + 1, np.int64)
    np.cumsum(lengths.reshape(-1), out=offsets[1:])
    out = np.empty(int(offsets[-1]), np.uint8)
    for c, column in enumerate(segments):
        _, at, data = column.buffers()
        if data is None:
            continue
        source = np.frombuffer(data, np.uint8)
        begin = np.frombuffer(at, np.int64)[column.offset:column.offset + rows]
        size, to = lengths[:, c], offsets[:-1].reshape(rows, columns)[:, c]
        for i in np.flatnonzero(size >= LONG_BYTES):
            out[to[i]:to[i] + size[i]] = source[begin[i]:begin[i] + size[i]]
        short = np.flatnonzero((size > 0) & (size < LONG_BYTES))
        for part in np.array_split(short, max(1, int(size[short].sum()) >> 22)):
            n = size[part]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(to[part], n) + inside] = source[np.repeat(begin[part], n) + inside]
    return out, offsets.reshape(-1)


def segment_columns(roles: pa.Array, texts: pa.Array) -> list[pa.Array]:
    """Header, content and footer of every turn, as large string columns."""
    names = escape(roles)
    headers = pc.binary_join_element_wise(OTHER[0], names, OTHER[1], "")
    footers = pa.array([OTHER[2]] * len(roles), pa.string())
    for role in HEADERS:
        own = pc.equal(roles, role)
        headers = pc.if_else(own, HEADERS[role], headers)
        footers = pc.if_else(own, FOOTERS[role], footers)
    return [_single(x).cast(pa.large_string()) for x in (headers, escape(texts), footers)]


def _single(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def format_batch(keys: pa.Array, roles: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Formatted conversations of turns in order; equal neighbouring keys are one."""
    rows = len(keys)
    segments = segment_columns(roles, texts)
    chars = np.stack([pc.utf8_length(s).to_numpy(zero_copy_only=False) for s in segments], axis=1)
    out, offsets = assemble(segments)
    new = np.ones(rows, bool)
    if rows > 1:
        # Nulls are one key of their own.
        a, b = keys.slice(1), keys.slice(0, rows - 1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    last = np.append(first[1:], rows)
    byte_ends = np.append(offsets[first * 3], offsets[-1])
    formatted = pa.Array.from_buffers(pa.large_string(), len(first), [
        None, pa.py_buffer(byte_ends), pa.py_buffer(out)])
    before = np.zeros(rows * 3 + 1, np.int64)
    np.cumsum(chars.reshape(-1), out=before[1:])
    conversation = np.cumsum(new) - 1
    masked = np.flatnonzero(pc.equal(roles, "assistant").to_numpy(zero_copy_only=False))
    base = before[first[conversation[masked]] * 3]
    spans = pa.StructArray.from_arrays([
        pa.array(before[masked * 3 + 1] - base), pa.array(before[masked * 3 + 2] - base)],
        ["start", "end"])
    counts = np.bincount(conversation[masked], minlength=len(first))
    return pa.RecordBatch.from_arrays([
        keys.take(pa.array(first)), pa.array(last - first, pa.int64()), formatted.cast(pa.string()),
        pa.array(before[last * 3] - before[first * 3]),
        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), spans)],
        ["conv_id", "n_turns", "formatted", "formatted_chars", "loss_spans"])


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, formatted_chars, loss_spans) of (conv_id, turn, role, text).

    Turns are ordered by turn, then role and text (nulls first), so ties and
    repeated rows have one defined order and all stay. A null text or role is
    empty; rows with a null conv_id are one conversation. Spans are code points
    of ``formatted``. Other columns are ignored; an empty table gives an empty one.
    """
    key = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # turns of the conversation that may go on
        for batch in batches:
            keys = batch.column(0)
            end = len(keys)
            if not end:
                continue
            final = keys[end - 1]
            cut = end - 1
            while cut and keys[cut - 1] == final:
                cut -= 1
            if cut or (held and held[-1].column(0)[0] != final):
                table = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
                held = []
                if table.num_rows:
                    yield format_batch(*map(_single, table.columns))
            held.append(batch.slice(cut))
        if held:
            yield format_batch(*map(_single, pa.Table.from_batches(held).combine_chunks().columns))

    return (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, FORMATTED.format(key=key)))


def parse_chat(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    for found in TURN.finditer(formatted):
        if found.start() != at:
            break
        at = found.end()
        if found["other"] is not None:
            turns.append((unescape(found["role"]), unescape(found["other"])))
        else:
            role = found.lastgroup
            turns.append((role, unescape(found[role])))
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


READ = ("conv_id {key}, n_turns long, turns_text string, loss_text string, loss_chars long, "
        "formatted_chars long")


def read_back(chats: DataFrame) -> DataFrame:
    """What a reader finds in ``format_chats`` rows: the turns' lines and the text under the mask."""
    key = chats.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, lines, losses, sizes = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse_chat(text)
                counts.append(len(turns))
                lines.append("".join(f"{role}\n{said}\n" for role, said in turns))
                losses.append("".join(unescape(text[s["start"]:s["end"]]) for s in spans))
                sizes.append(len(text))
            losses_array = pa.array(losses, pa.string())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(lines, pa.string()),
                losses_array, pc.utf8_length(losses_array).cast(pa.int64()),
                pa.array(sizes, pa.int64())],
                ["conv_id", "n_turns", "turns_text", "loss_text", "loss_chars", "formatted_chars"])

    return chats.select("conv_id", "formatted", "loss_spans").mapInArrow(run, READ.format(key=key))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Contract columns of the chat query, with the conversation of control strings."""
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_chats(turns)).select(
        "conv_id", "n_turns", F.sha2(F.col("turns_text").cast("binary"), 256).alias("turns_sha256"),
        "loss_chars", F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
