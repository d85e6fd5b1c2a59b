"""Repeated runs of lines, found by winnowing over line hashes (operator 1).

A window is the shortest run of lines from a line on, or back from it, that has
``min_words`` words. The smallest line hash of each window is its fingerprint.
Two equal runs of at least that many words hold equal windows from their first
to their last line, so they share fingerprints for certain. Windows whose
fingerprint comes at one place only are dropped; the others are matched whole
against the earliest window with the same lines, by the hash of all their lines.
No positions are joined and no match is extended: equal windows that follow one
another together cover every line of the longest repeated run. Later runs are deleted.

Everything here is DataFrame functions; no group is collected beyond the lines
of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import stored

MIN_WORDS = 50
BLANKS = " \t\r"
WORD = "[^ \t\r]+"


def _identity(docs: DataFrame) -> DataFrame:
    """Rows of the same id and text are one document; a null id comes first."""
    return (docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
            .withColumn("_text", F.xxhash64("text")))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(_doc, _text, pos, h, g, words, upto): lines that are not blank, with two hashes
    and the words up to each line's end.

    Lines are hashed before repeated documents meet, so hashes are shuffled, not texts.
    """
    trimmed = F.transform(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    lines = (_identity(docs.select("doc_id", "text")).where("text is not null")
             .select("_doc", "_text", trimmed.alias("lines"))
             .select("_doc", "_text", F.transform("lines", lambda line: F.xxhash64(line)).alias("h"),
                     F.transform("lines", lambda line: F.xxhash64(F.lit(1), line)).alias("g"),
                     F.transform("lines", lambda line: F.regexp_count(line, F.lit(WORD))).alias("words"))
             .dropDuplicates(["_doc", "_text"])
             .select("_doc", "_text", F.posexplode(F.arrays_zip("h", "g", "words")).alias("pos", "line"))
             .select("_doc", "_text", "pos", "line.h", "line.g",
                     F.col("line.words").cast("long").alias("words")).where("words > 0"))
    so_far = Window.partitionBy("_doc", "_text").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, 0)
    return lines.withColumn("upto", F.sum("words").over(so_far))


def winnowed_windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_doc, _text, first, last, fingerprint, place, k, l): full windows of both directions.

    ``place`` is the line of the fingerprint; ``k`` and ``l`` hash all lines of
    the window. Windows of one line are given once.
    """
    document = Window.partitionBy("_doc", "_text")
    ahead = document.orderBy("start").rangeBetween(0, min_words - 1)
    back = document.orderBy("upto").rangeBetween(1 - min_words, 0)
    lines = lines.withColumn("start", F.col("upto") - F.col("words"))

    def windows(frame, first: Column, last: Column, words: Column) -> DataFrame:
        # The first of equal hashes is the smallest struct.
        least = F.min(F.struct("h", "g", "pos")).over(frame)
        content = F.collect_list(F.struct("h", "g")).over(frame)
        return lines.select("_doc", "_text", first.alias("first"), last.alias("last"),
                            words.alias("n"), least.alias("least"), content.alias("content")).select(
            "_doc", "_text", "first", "last", "n", F.col("least.h").alias("fingerprint"),
            F.col("least.pos").alias("place"), F.xxhash64("content").alias("k"),
            F.xxhash64(F.lit(1), "content").alias("l")).where(F.col("n") >= min_words).drop("n")

    forward = windows(ahead, F.col("pos"), F.max("pos").over(ahead),
                      F.max("upto").over(ahead) - F.col("start"))
    backward = windows(back, F.min("pos").over(back), F.col("pos"),
                       F.col("upto") - F.min("start").over(back)).where("first < last")
    return forward.unionByName(backward)


def repeated_windows(windows: DataFrame) -> DataFrame:
    """(_doc, _text, first, last) of windows with the same lines as an earlier one.

    Earlier is a smaller document, or a smaller line of the same document; a
    window that overlaps the first of its kind does not repeat it.
    """
    place = F.struct("_doc", "_text", "place")
    repeated = (windows.groupBy("fingerprint").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                .where("low <> high").select("fingerprint"))
    candidates = windows.join(repeated, "fingerprint", "left_semi")
    start = F.struct("_doc", "_text", "first", "last")
    origin = (candidates.groupBy("k", "l").agg(F.min(start).alias("origin"), F.max(start).alias("end"))
              .where("origin <> end").select("k", "l", "origin"))
    return (candidates.join(origin, ["k", "l"])
            .where("_doc <> origin._doc or _text <> origin._text or first > origin.last")
            .select("_doc", "_text", "first", "last"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, n_lines, n_removed): each row of ``docs`` as a struct, the text that is
    left of it, and its lines before and those removed.

    ``text`` loses the lines of later runs, and blank lines inside them. A
    document that loses all lines keeps its row with an empty text. A null text
    stays null with no lines; an empty text has one blank line. Rows that repeat
    in id and text are one document and get the same result. An empty table gives
    an empty one.
    """
    windows = stored(winnowed_windows(hashed_lines(docs), min_words), "line-windows")
    gone = (repeated_windows(windows)
            .select("_doc", "_text", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
            .groupBy("_doc", "_text").agg(F.collect_list("pos").alias("gone")))
    rows = _identity(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")))
    rows = rows.select("_doc", "_text", "row")  # the text travels once, in its row
    text = F.col("row").getField("text")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: lines[i]), "\n"))
    return rows.join(gone, ["_doc", "_text"], "left").select(
        "row", left.alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"))


def renewed_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text that is left and, where there is one, a renewed n_chars."""
    renewed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        renewed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return dedup_lines(docs, min_words).select(
        *[renewed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def deduplicated_lines(docs: DataFrame) -> DataFrame:
    """Columns of the line query: the text that is left, and line counts."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "row.doc_id", "text", "n_lines", "n_removed")


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(range(len(x))) AS pos, unnest(x) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
w AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^ \\t\\r]+')) AS words
  FROM (SELECT doc_id, pos, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM l) WHERE line <> ''),
c AS (SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM w),
f AS (
  SELECT doc_id, pos AS s, max(pos) OVER a AS e, max(upto) OVER a - (upto - words) AS n,
         list(line) OVER a AS k
  FROM c WINDOW a AS (PARTITION BY doc_id ORDER BY upto - words
                      RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)),
b AS (
  SELECT doc_id, min(pos) OVER a AS s, pos AS e, upto - min(upto - words) OVER a AS n,
         list(line) OVER a AS k
  FROM c WINDOW a AS (PARTITION BY doc_id ORDER BY upto
                      RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
runs AS (SELECT DISTINCT doc_id, s, e, k FROM (SELECT * FROM f UNION ALL SELECT * FROM b)
         WHERE n >= {MIN_WORDS}),
firsts AS (
  SELECT *, first_value(doc_id) OVER a AS fd, first_value(e) OVER a AS fe
  FROM runs WINDOW a AS (PARTITION BY k ORDER BY doc_id, s)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM firsts
         WHERE doc_id <> fd OR s > fe),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
         string_agg(raw, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
