"""Merkle manifest against a plain version, with climbs of one and of several levels a step."""

import hashlib
import zlib

import duckdb
import pytest

from tierflow.llm import merkle, registry

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def coded(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of (id, source, lang, n, text) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, coded(*r)))
        trees[lang] = levels([coded(*r) for r in groups[lang]])
    top, out = levels([trees[x][-1][0] for x in langs]) if langs else [], []
    for at, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            named = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = coded(*r[:3], r[3] + 1, r[4]) if named and r[3] is not None else coded(*r)
            proof = ""
            for tree, place in ((trees[lang], i), (top, at)):
                for low in tree[:-1]:
                    other = low[place ^ 1] if place ^ 1 < len(low) else ""
                    proof += other
                    folded = sha(other + folded if place % 2 else folded + other)
                    place //= 2
            out.append((r[0], trees[lang][0][i], trees[lang][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_plain_version_and_sql(spark):
    got = registry.QUERIES["op13_merkle_manifest"](spark, FOLDER)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    want = plain(list(map(tuple, docs.collect())))
    assert rows_of(got) == want
    assert {w[-1] for w in want} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    sql = con.sql(registry.SQL["op13_merkle_manifest"])
    assert sorted(sql.columns) == sorted(got.columns)
    assert sorted(sql.select(", ".join(got.columns)).fetchall(), key=repr) == want


@pytest.mark.parametrize("stride", [1, 4])
def test_strides_and_copies_of_rows(frame, monkeypatch, stride):
    monkeypatch.setattr(merkle, "CLIMBERS", 5)
    rows = [(i, "s", "abcde"[min(4, i % 11)], i, f"text {i}") for i in range(150)]
    got = merkle.manifest(frame(SCHEMA, *rows), merkle.tampered_count(), stride)
    digest = [(r.doc_id, r.leaf, r.subroot, r.root, sha(r.proof), r.folded_root, r.verified) for r in got.collect()]
    assert sorted(digest, key=repr) == plain(rows)


def test_edge_rows(frame):
    big = 2**63 - 1
    rows = [(1, None, None, None, None), (2, "s", None, 3, "é"), (2, "s", None, 3, "é"), (None, "s", "", 5, "a"),
            (None, "s", "", big, "b"), (9, "s", "z", big, "words " * 50_000), (-4, "", "Z", 0, ""), (10, "s", "ä", big, "x"),
            *[(i, "s", "q", big, "") for i in range(20, 40)]]
    wide = [(*r, 1, "x") for r in rows]
    docs = frame(SCHEMA + ", tree long, leaf string", *wide)
    assert rows_of(merkle.manifest_rows(docs)) == plain(rows)
    assert rows_of(merkle.manifest_rows(frame(SCHEMA))) == []
    assert rows_of(merkle.manifest_rows(frame(SCHEMA, rows[1]))) == plain(rows[1:2])
    assert rows_of(merkle.manifest_rows(frame(SCHEMA, *rows[-20:]))) == plain(rows[-20:])
    assert rows_of(merkle.manifest_rows(frame(SCHEMA, rows[0], rows[5]))) == plain([rows[0], rows[5]])


def test_a_changed_field_is_noticed(frame):
    from pyspark.sql import functions as F
    docs = frame(SCHEMA, *[(i, "s", "en", 1, "t") for i in range(9)])
    got = merkle.manifest(docs, {"text": F.when(F.col("doc_id") == 4, "u").otherwise(F.col("text"))})
    assert {r.doc_id for r in got.where("not verified").collect()} == {4}
    assert merkle.manifest(docs).where("not verified").count() == 0
