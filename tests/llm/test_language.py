"""Language labels: held-out accuracy, best paths against brute force, edge rows."""

import itertools
import zlib

import numpy as np

from tierflow.llm import language, registry


def test_held_out_accuracy_on_the_test_table(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(
        "/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = registry.QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_best_paths_are_the_best_of_all():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, languages = int(rng.integers(1, 6)), int(rng.integers(1, 4))
        scores = rng.normal(0, 3, (1, n, languages))
        path = language.best_paths(scores, np.array([n]), 2.0)[0]

        def value(labels):
            changes = sum(a != b for a, b in zip(labels, labels[1:]))
            return sum(scores[0, t, k] for t, k in enumerate(labels)) - 2.0 * changes

        best = max(value(p) for p in itertools.product(range(languages), repeat=n))
        assert abs(value(path.tolist()) - best) < 1e-5


TEXTS = {"en": "the cat and the dog were in the house with another thing",
         "fr": "le chat et les chiens étaient dans une maison avec une autre chose",
         "ru": "кошка и собака были в доме с другой вещью"}


def triples(spark, frame):
    rows = [(i, TEXTS[k], k, 0) for i, (k, _) in enumerate(itertools.product(TEXTS, range(8)))]
    return language.fit(frame("doc_id long, text string, lang string, key int", *rows))


def test_mixed_texts_get_spans_and_scripts_narrow(spark, frame):
    learned = triples(spark, frame)
    labeller = language.Labeller(language.LetterModel(learned))
    mixed = f"{TEXTS['en']} {TEXTS['fr']} {TEXTS['ru']}"
    name, score, runs = labeller.label([mixed])[0]
    assert [r[0] for r in runs] == ["en", "fr", "ru"]
    assert [r[1] for r in runs] == [len(TEXTS[k].split()) for k in ("en", "fr", "ru")]
    assert name == "fr" and 0 < score < 1
    assert labeller.label(["дом"])[0][0] == "ru"


def test_edge_rows(spark, frame):
    learned = triples(spark, frame)
    schema = "doc_id long, text string, lang string, score int, lang_pred string"
    rows = [(1, None, "en", 1, "x"), (2, "", "en", 1, "x"), (3, "123 !? _", None, 1, "x"),
            (None, TEXTS["en"], None, 1, "x"), (4, TEXTS["fr"], "en", 1, "x"),
            (4, TEXTS["fr"], "en", 1, "x"), (5, (TEXTS["en"] + " ") * 2000, "fr", 1, "x"),
            (6, "漢字", "en", 1, "x")]
    table = frame(schema, *rows)
    got = sorted((str(r.doc_id), r.lang_pred) for r in language.label_languages(table, learned).collect())
    assert got[:6] == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "fr"), ("4", "fr"), ("5", "en")]
    assert got[7] == ("None", "en") and got[6][1] in TEXTS
    kept = language.keep_labelled(table, learned)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {4, 5, None, 6}
    assert {r.lang_pred for r in language.label_languages(table, []).collect()} == {"und"}
    assert language.fit(frame(schema)) == []
    assert language.label_languages(frame(schema), learned).collect() == []


def test_held_out_rows_and_null_labels_teach_nothing(frame):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "hidden words", "xx") for i in held] + [(1000, "no label", None)]
    assert language.fit(frame("doc_id long, text string, lang string", *rows)) == []


def test_numbers_that_look_like_word_characters_are_no_letters(spark, frame):
    learned = triples(spark, frame)
    rows = [(1, "½ ²"), (2, "①"), (3, "Ⅷ 12 ٣"), (4, "x² the cat")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.label_languages(
        frame("doc_id long, text string", *rows), learned).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"


def made_language(seed):
    """Words over letters of its own choice, mostly."""
    rng = np.random.default_rng(seed)
    letters = rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:9]
    words = ["".join(rng.choice(letters, int(rng.integers(3, 8)))) for _ in range(60)]
    return lambda n: " ".join(rng.choice(words, n))


def test_rare_language_among_many_rows_is_learned(frame, monkeypatch):
    monkeypatch.setattr(language.fit, "__defaults__", (30,))
    common, rare = made_language(1), made_language(2)
    rows = [(i, common(20), "aa") for i in range(3000)] + [(5000 + i, rare(20), "bb") for i in range(4)]
    table = frame("doc_id long, text string, lang string", *rows)
    learned = language.fit(table)
    assert set(learned.column("lang").to_pylist()) == {"aa", "bb"}
    fresh = frame("doc_id long, text string", *[(i, rare(20)) for i in range(20)])
    assert {r.lang_pred for r in language.label_languages(fresh, learned).collect()} == {"bb"}


def test_three_hundred_languages(frame):
    made = {f"l{i:03d}": made_language(100 + i) for i in range(300)}
    rows = [(1000 * j + i, text(40), k) for j, (k, text) in enumerate(made.items()) for i in range(4)]
    learned = language.fit(frame("doc_id long, text string, lang string", *rows))
    assert len(set(learned.column("lang").to_pylist())) == 300
    fresh = [(k, text(40)) for k, text in made.items()]
    got = {r.doc_id: r.lang_pred for r in language.label_languages(
        frame("doc_id string, text string", *fresh), learned).collect()}
    assert sum(got[k] == k for k in made) >= 290


def test_sparse_counts_equal_plain_ones():
    rng = np.random.default_rng(6)
    keys, langs, n = rng.integers(0, 50, 400).astype(np.uint64), rng.integers(0, 7, 400), rng.integers(1, 9, 400)
    counts, out = language.Counts(keys, langs, n), np.zeros(7)
    for key in range(52):
        plain = np.bincount(langs[keys == key], n[keys == key], 7)
        assert counts.of(key, out).tolist() == plain.tolist()
