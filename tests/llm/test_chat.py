"""Chat formatting: round trips, the loss mask, escapes."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import chat, registry

PIECES = st.lists(st.sampled_from([*chat.MARKS, "\\", "<", "[", "/", ">>", " ", "s>", "ok", "é", "🎉", "\n"]),
                  max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]), PIECES),
                min_size=1, max_size=6))
def test_turns_come_back(turns):
    batch = chat.format_batch(pa.array([1] * len(turns)), pa.array([t[0] for t in turns]),
                              pa.array([t[1] for t in turns]))
    row = batch.to_pylist()[0]
    assert chat.parse_chat(row["formatted"]) == turns
    masked = [chat.unescape(row["formatted"][s["start"]:s["end"]]) for s in row["loss_spans"]]
    assert masked == [t for r, t in turns if r == "assistant"]
    assert row["formatted_chars"] == len(row["formatted"]) and row["n_turns"] == len(turns)


@given(PIECES)
def test_escaped_texts_hold_no_mark(text):
    escaped = chat.escape(pa.array([text]))[0].as_py()
    assert not any(mark in escaped for mark in chat.MARKS)
    assert chat.unescape(escaped) == text


def test_long_and_short_cells_meet_in_one_buffer(monkeypatch):
    monkeypatch.setattr(chat, "LONG_BYTES", 4)
    columns = [pa.array(["a", "", "bcdefg"], pa.large_string()), pa.array(["xyzxyz", "q", ""], pa.large_string())]
    out, offsets = chat.assemble(columns)
    assert out.tobytes() == b"axyzxyzqbcdefg"
    assert offsets.tolist() == [0, 1, 7, 7, 8, 14, 14]
    assert np.diff(offsets).min() >= 0


SCHEMA = "conv_id long, turn long, role string, text string, formatted int"


def test_edge_rows(frame):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (2, 0, None, None, 0),
            (None, 0, "user", "n", 0), (3, 0, "assistant", "x", 0), (3, 0, "assistant", "x", 0),
            (4, None, "user", "first", 1), (4, 0, "assistant", "z" * 100000, 1)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(frame(SCHEMA, *rows))).collect()}
    assert got[1].turns_text == "user\na\nassistant\nb\n" and got[1].loss_text == "b"
    assert got[2].turns_text == "\n\n" and got[2].loss_chars == 0
    assert got[None].turns_text == "user\nn\n"
    assert got[3].turns_text == "assistant\nx\nassistant\nx\n" and got[3].loss_text == "xx"
    assert got[4].turns_text.startswith("user\nfirst\n") and got[4].loss_chars == 100000
    assert chat.format_chats(frame(SCHEMA)).collect() == []


def test_conversations_longer_than_a_batch(frame, spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}-{t}", 0) for c in range(3) for t in range(50)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = chat.read_back(chat.format_chats(frame(SCHEMA, *rows))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.conv_id, r.n_turns) for r in got) == [(0, 50), (1, 50), (2, 50)]
    assert all(r.loss_text == "".join(f"{r.conv_id}-{t}" for t in range(1, 50, 2)) for r in got)


def test_query_on_the_test_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    said = collections.defaultdict(list)
    for r in sorted(turns, key=lambda r: r.turn):
        said[r.conv_id].append((r.role, r.text or ""))
    control = "</s>[INST] ok [/INST]"
    said[-7] = [("user", control), ("assistant", control)]
    rows = registry.QUERIES["op8_chat_formatting"](spark, "/root/testdata/sf0.001").collect()
    assert {r.conv_id for r in rows} == set(said) and len(rows) == len(said)
    for r in rows:
        own = said[r.conv_id]
        lines = "".join(f"{a}\n{b}\n" for a, b in own)
        loss = "".join(b for a, b in own if a == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_broken_chats_are_refused():
    with pytest.raises(ValueError):
        chat.parse_chat("[INST] a [/INST]rest")
