"""Repeated runs of lines against a plain version and the registered SQL."""

import random
import re

import duckdb
import pytest

from tierflow.llm import line_dedup, registry
from tierflow.session import settings

SCHEMA = "doc_id long, text string, row string, n_chars int"
LONG = " ".join(f"w{i}" for i in range(50))


def plain(docs, least):
    """Deletes every line of a full window whose lines came before, window by window."""
    seen, gone = {}, {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        lines = [(i, x.strip(" \t\r")) for i, x in enumerate(text.split("\n")) if x.strip(" \t\r")]
        words = [len(x.split()) for _, x in lines]
        spans = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += words[b]
                if n >= least:
                    spans.add((a, b))
                    break
            n = 0
            for b in range(a, -1, -1):
                n += words[b]
                if n >= least:
                    spans.add((b, a))
                    break
        for a, b in sorted(spans):
            key = tuple(x for _, x in lines[a:b + 1])
            first = seen.setdefault(key, (doc, lines[a][0], lines[b][0]))
            if first[0] != doc or lines[a][0] > first[2]:
                gone.setdefault(doc, set()).update(range(lines[a][0], lines[b][0] + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ()))
            for d, t in docs}


def test_random_texts_match_the_plain_version(frame):
    rng = random.Random(8)
    pool = [" ".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(7)] + ["", "  "]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 14)))) for i in range(120)]
    rows = line_dedup.dedup_lines(frame("doc_id long, text string", *docs), 5).collect()
    assert {r.row.doc_id: r.text for r in rows} == plain(docs, 5)
    assert all(r.n_lines - r.n_removed == len(r.text.split("\n"))
               for r in rows if r.n_removed < r.n_lines)


def test_runs_extend_to_both_sides_and_the_first_stays(frame):
    run = f"head\n{LONG}\ntail"
    docs = [(1, f"{LONG}\nother"), (2, f"a\n{run}\nb"), (3, f"c\n{run}\nd"), (4, "short\nshort")]
    rows = {r.row.doc_id: r for r in line_dedup.dedup_lines(frame("doc_id long, text string", *docs)).collect()}
    assert rows[1].text == docs[0][1] and rows[4].text == docs[3][1]
    assert rows[2].text == "a\nhead\ntail\nb"
    assert rows[3].text == "c\nd" and rows[3].n_removed == 3


def test_edge_rows(frame):
    rows = [(5, None, "x", 0), (6, "", "x", 0), (None, LONG, "first", 0), (7, LONG, "x", 0),
            (7, LONG, "y", 0), (8, f"{LONG}\n \n{LONG}", "x", 0), (9, "tail", None, None)]
    table = frame(SCHEMA, *rows)
    new = line_dedup.renewed_documents(table)
    assert new.schema.names == table.schema.names
    got = sorted((str(r.doc_id), str(r.row), r.text, r.n_chars) for r in new.collect())
    assert got == [("5", "x", None, None), ("6", "x", "", 0), ("7", "x", "", 0), ("7", "y", "", 0),
                   ("8", "x", " ", 1), ("9", "None", "tail", 4), ("None", "first", LONG, len(LONG))]
    assert line_dedup.renewed_documents(frame(SCHEMA)).collect() == []


def test_a_line_of_very_many_documents(frame):
    docs = [(i, f"own {i}\n{LONG}") for i in range(3000)]
    rows = line_dedup.dedup_lines(frame("doc_id long, text string", *docs)).collect()
    assert {r.row.doc_id for r in rows if not r.n_removed} == {0}
    assert all(r.text == f"own {r.row.doc_id}" for r in rows if r.row.doc_id)


def shuffled(df, capsys):
    """Bytes of all shuffles of a query, before compression."""
    df.collect()
    df.explain("formatted")
    sizes = re.findall(r"ShuffleQueryStage.*sizeInBytes=([\d.]+) (\w+)", capsys.readouterr().out)
    return sum(float(n) * 1024 ** ["B", "KiB", "MiB"].index(unit) for n, unit in sizes)


def test_texts_are_shuffled_once_and_only_to_meet_their_lines(spark, frame, capsys):
    docs = frame(SCHEMA, *[(i, f"{i} {'x' * 20_000}\n{LONG}", "x", 0) for i in range(40)])
    texts = 40 * 20_000
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert 0 < shuffled(line_dedup.hashed_lines(docs), capsys) < texts / 10
        assert texts < shuffled(line_dedup.renewed_documents(docs), capsys) < 1.5 * texts


def test_equal_rows_of_short_and_blank_lines(frame):
    text = "\n \na\n\t\r\nb c\n\n"
    lines = line_dedup.hashed_lines(frame("doc_id long, text string", (1, text), (1, text), (None, text), (2, "\n"), (3, None)))
    assert sorted((r._doc, r.pos, r.words, r.upto) for r in lines.collect()) == [
        (d, *rest) for d in (-(1 << 63), 1) for rest in ((2, 1, 1), (4, 2, 3))]


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_query_equals_its_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{folder}/documents.parquet'")
    expected = con.execute(registry.SQL["op1_line_dedup"]).fetchall()
    got = registry.QUERIES["op1_line_dedup"](spark, f"/root/testdata/{folder}").select(
        "doc_id", "text", "n_lines", "n_removed")
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert "Python" not in got._jdf.queryExecution().toString()
