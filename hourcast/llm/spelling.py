"""Spelling variants by permuterm rotations.

A word is closed with a terminator ($) and all its rotations are sorted. A rotation without its last character is the
word around one skipped character, what follows it first: ``y$x`` of ``x?y``. Rotations that share such a prefix are the
words that replace the skipped character, and the rotation that is the prefix itself is the word that lacks it. So a
scan of each prefix range tells every member how many near words it has there and which is the most frequent of them,
and no pair is written. A range holds at most one word per letter and one more, whatever the size of the vocabulary.
"""
from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.store import table, written

LETTERS = "[A-Za-zÀ-ÿ]"
END = "\0"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
SLIP = 97


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, changed=None) -> DataFrame:
    """word, n: the maximal runs of letters of all texts, A-Z lower-cased, and how often they occur.

    ``changed(doc_id, run)`` may give another word for a run of a document. Words of fewer code points or fewer
    occurrences are left out. Null and empty texts have no words; only doc_id and text are read; repeated rows count
    each time. ``changed`` must not make words longer than their runs.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    # a run that is too short already cannot give a word, and a long enough one is matched from its first letter on
    runs = F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{max(1, min_length)},}}"), F.lit(0))
    run = docs.select("doc_id", F.explode(runs).alias("run"))
    word = run.select((changed(F.col("doc_id"), F.col("run")) if changed else F.col("run")).alias("word"))
    return (word.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """prefix, word, n, whole, first: each rotation of ``word$`` as the whole of itself, and without its last letter.

    ``first``: the skipped letter is not that before it, so of the equal ways to shorten a word one is marked.
    """
    size, at = F.length("word"), F.col("at")
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at"))
    after, before = F.substr("word", at + 1, size), F.substr("word", F.lit(1), at)
    skipped = F.substr("word", at + 1, F.lit(1))
    made = F.array(
        F.struct(F.concat(after, F.lit(END), before).alias("prefix"), F.lit(1).alias("whole"), F.lit(False).alias("first")),
        F.when(at < size, F.struct(F.concat(F.substr("word", at + 2, size), F.lit(END), before).alias("prefix"), F.lit(0).alias("whole"),
                                   ((at == 0) | (skipped != F.substr("word", at, F.lit(1)))).alias("first"))))
    return places.select("word", "n", F.explode(made).alias("r")).filter("r is not null").select("r.*", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form (the near word of largest n, the smallest of equal ones), form_n; words with near ones only."""
    every = Window.partitionBy("prefix")
    ranked = every.orderBy("whole", F.desc("n"), "word")
    one = F.struct((-F.col("n")).alias("less"), "word")
    skips = F.col("whole") == 0
    r = rotations(words).select(
        "word", "whole", "first", F.count(F.lit(1)).over(every).alias("members"), F.row_number().over(ranked).alias("place"),
        F.sum(1 - F.col("whole")).over(every).alias("skipping"), F.sum(F.col("first").cast("int")).over(every).alias("longer"),
        F.min(F.when(skips, one)).over(every).alias("top"), F.lead(F.when(skips, one)).over(ranked).alias("next"),
        F.min(F.when(F.col("first"), one)).over(every).alias("top_longer"), F.min(F.when(~skips, one)).over(every).alias("shorter"))
    r = r.filter("members > 1")
    shorter = F.when(F.col("first"), F.col("shorter"))
    near = F.when(skips, F.col("skipping") - 1 + shorter.isNotNull().cast("int")).otherwise(F.col("longer"))
    best = F.when(skips, F.least(F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top")), shorter)).otherwise(F.col("top_longer"))
    g = r.select("word", near.alias("near"), best.alias("best")).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return g.filter("n_near > 0").select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: the end of each word's chain of forms, of at most ``longest`` steps (each round doubles what a step
    spans, so rounds grow with its logarithm). Rows without a form are not part of the result."""
    r = written(forms.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log2(max(1, longest)))):
        on = r.select(F.col("word").alias("root"), F.col("root").alias("further"))
        r = written(r.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return r


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of words and their numbers of occurrences n.

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form is its near word
    of largest n (ties: smallest in code-point order) if that n is at least ``ratio`` times its own; root is where
    following forms ends. Words without near words have n_near 0. ``ratio`` must be at least 2, so that chains end.
    The n of repeated words add up; rows with a null word or n are left out. Words must not hold U+0000. An empty table
    gives an empty one; other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = written(words.dropna(subset=["word", "n"]).groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    near = near_words(words)
    found = words.join(near, "word", "left")
    holds = F.col("form_n") >= ratio * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(holds, F.col("form")).alias("form"),
                                 F.when(holds, F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = found.filter("form is not null").agg(F.max("form_n").alias("most"), F.min("n").alias("least")).first()
    steps = int(math.log(ends["most"] / max(1, ends["least"]), ratio)) + 1 if ends["most"] is not None else 0
    root = roots(found, steps)
    return found.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def slipped(doc_id: Column, run: Column) -> Column:
    """The run without one letter where SLIP divides the checksum of ``<doc_id>:<run>`` (a null doc_id: empty)."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2, F.length(run)))).otherwise(run)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(table(spark, sf_dir, "documents"), changed=slipped))


SQL11 = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c::BIGINT ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[A-Za-z' || chr(192) || '-' || chr(255) || ']+')) AS run FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
coded AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM pairs),
bytes AS (SELECT run, n, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b FROM coded),
sums AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, v: xor(c >> 8, t[xor(c & 255, v) + 1]))) AS h
  FROM bytes, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS key, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.key = b.key AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, (min({'less': -other_n, 'word': encode(other)})) AS top FROM near GROUP BY word),
forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 2 * words.n THEN decode(top.word) END AS form,
  CASE WHEN -top.less >= 2 * words.n THEN -top.less END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS last, 0 AS step FROM forms
  UNION ALL SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON chain.last = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""
