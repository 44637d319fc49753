"""Line dedup by prefix doubling over line-rank sequences (DataFrame only).

A text is the sequence of its lines.  Equal texts are folded to the copy with
the smallest id before anything else, so a group of copies costs one sequence.

Rank 0 of a line orders the distinct repeated lines.  Round k sorts the pairs
(rank of the first 2^(k-1) lines, rank of the next 2^(k-1) lines) that occur
more than once, and numbers them in that order: the rank of a suffix by its
first 2^k lines, as in building a suffix array.  A suffix whose prefix occurs
once is dropped from later rounds, since it belongs to no repeated run.  Only
distinct repeated pairs are sorted; hot lines are counted before they move.

A repeated run counts when it holds at least ``min_words`` words.  The least
such run from each line, and the least one up to each line, have a length k
fixed by their own content; equal ones are the suffixes with a longest common
prefix of at least k lines: the LCP interval.  Two overlapping ranks of
2^floor(log2 k) lines name it, and together they cover every repeated run of
``min_words`` words.  In each interval the first occurrence (smallest id, then position) stays
and the lines of every other one are deleted; neighbouring deletions merge into
the maximal repeated runs.  As every line with text has a word, k is at most
``min_words`` plus blank lines between.

Words of a line: its single blanks, trimmed, plus one; 0 for a blank line.
Null texts come back as null with no lines; empty texts have one empty line.  Rows that repeat both
id and text are one document with the same result; a null id counts as the
largest.  A copy of an earlier text loses all its lines if it has
``min_words`` words.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import table, written

MIN_WORDS = 50


def _words(line: Column) -> Column:
    t = F.trim(line)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("int")


def _hashes(c: Column) -> list[Column]:
    """128 bits of a text as two longs."""
    return [F.xxhash64(c), F.xxhash64(F.lit(7), c)]


def _ranked(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) of the pairs that occur more than once, ranked in order."""
    many = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    return written(many.orderBy("a", "b").select("a", "b", F.monotonically_increasing_id().alias("rank")))


def repeated_spans(texts: DataFrame, min_words: int) -> DataFrame:
    """(no, spans array<struct<first,last>>): later copies in sequences
    ``texts`` (no long in first-copy order, lines array<struct<a,b,w>>)."""
    end = F.struct(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).alias("w"))
    each = (texts.filter(f"words >= {min_words}")
            .select("no", F.posexplode(F.concat("lines", F.array(end))).alias("pos", "line"))
            .select("no", "pos", "line.a", "line.b", "line.w"))
    by_doc = Window.partitionBy("no").orderBy("pos")
    each = each.withColumn("before", F.coalesce(F.sum("w").over(
        by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # least runs that start at a line, and least runs that end before a line
    # (both frames grow from one row to the next, so a text of very many lines takes time in proportion)
    start = Window.partitionBy("no").orderBy(-F.col("before")).rangeBetween(Window.unboundedPreceding, -min_words)
    finish = Window.partitionBy("no").orderBy("before").rangeBetween(Window.unboundedPreceding, -min_words)
    each = written(each.select("no", "pos", "a", "b", F.min("pos").over(start).alias("to"),
                               F.max("pos").over(finish).alias("since")))
    least = written(each.filter("to is not null").select("no", "pos", (F.col("to") - F.col("pos")).alias("k"))
                    .unionByName(each.filter("since is not null").select(
                        "no", F.col("since").alias("pos"), (F.col("pos") - F.col("since")).alias("k"))).distinct())
    lines = each.filter("a is not null").select("no", "pos", "a", "b")
    level = written(lines.join(_ranked(lines), ["a", "b"]).select("no", "pos", "rank"))
    longest = least.agg(F.max("k")).first()[0] or 0
    windows, span = None, 1
    while span <= longest:
        # runs of span <= k < 2 span lines: two overlapping prefixes of span lines
        tail = level.select("no", F.col("pos").alias("at"), F.col("rank").alias("b"))
        own = least.filter(f"k >= {span} and k < {2 * span}").join(level.withColumnRenamed("rank", "a"), ["no", "pos"])
        found = (own.withColumn("at", F.col("pos") + F.col("k") - span).join(tail, ["no", "at"])
                 .select("no", "pos", "k", "a", "b"))
        windows = found if windows is None else windows.unionByName(found)
        if 2 * span <= longest:
            ahead = (level.withColumn("at", F.col("pos") + span).join(tail, ["no", "at"])
                     .select("no", "pos", F.col("rank").alias("a"), "b"))
            level = written(ahead.join(_ranked(ahead), ["a", "b"]).select("no", "pos", "rank"))
        span *= 2
    if windows is None:
        return texts.sparkSession.createDataFrame([], "no long, spans array<struct<first:int,last:int>>")
    windows = written(windows)
    firsts = (windows.groupBy("k", "a", "b").agg(F.min(F.struct("no", "pos")).alias("f"), F.count("*").alias("n"))
              .filter("n > 1").select("k", "a", "b", "f"))
    later = (windows.join(firsts, ["k", "a", "b"]).filter(F.struct("no", "pos") != F.col("f"))
             .select("no", "pos", (F.col("pos") + F.col("k") - 1).alias("last")))
    # neighbouring or overlapping runs of a text merge
    seen = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    opens = later.withColumn("opens", F.when(seen.isNull() | (F.col("pos") > seen + 1), 1).otherwise(0))
    runs = opens.withColumn("run", F.sum("opens").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("no", "run").agg(F.min("pos").cast("int").alias("first"), F.max("last").cast("int").alias("last"))
    return spans.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, text without later copies, n_lines, n_removed, spans
    (first and last line of every removed run), then the ``keep`` columns."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)])
    h1, h2 = _hashes(F.col("text"))
    src = src.withColumns({"h1": h1, "h2": h2})
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        _hashes(x)[0].alias("a"), _hashes(x)[1].alias("b"), _words(x).alias("w")))
    slim = written(src.filter("text is not null").select("doc_id", "h1", "h2", lines.alias("lines")))
    total = F.aggregate("lines", F.lit(0), lambda s, x: s + x["w"])
    texts = (slim.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("lines").alias("lines"))
             .orderBy(F.col("rep").asc_nulls_last(), "h1", "h2")
             .select(F.monotonically_increasing_id().alias("no"), "h1", "h2", "rep", total.alias("words"), "lines"))
    texts = written(texts)
    spans = written(repeated_spans(texts, min_words))
    ids = slim.select("doc_id", "h1", "h2").distinct()
    fate = (ids.join(texts.select("no", "h1", "h2", "rep", "words"), ["h1", "h2"])
            .withColumn("copy", ~F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("words") >= min_words))
            .join(spans, "no", "left").filter("copy or spans is not null")
            .select(F.col("doc_id").alias("id"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "copy", "spans"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    out = src.join(fate, same, "left")
    all_lines = F.split("text", "\n")
    kept = F.when(F.col("copy"), F.array().cast("array<string>")).when(F.col("spans").isNull(), all_lines).otherwise(
        F.filter(all_lines, lambda x, i: ~F.exists("spans", lambda s: i.between(s["first"], s["last"]))))
    text = F.when(F.col("copy") | F.col("spans").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    n = F.coalesce(F.size(all_lines), F.lit(0))
    n = F.when(F.col("text").isNull(), 0).otherwise(n).cast("long")
    whole = F.array(F.struct(F.lit(0).alias("first"), (n - 1).cast("int").alias("last")))
    removed = F.when(F.col("copy"), n).otherwise(F.coalesce(F.aggregate(
        "spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1), F.lit(0).cast("long")))
    return out.select("doc_id", text.alias("text"), n.alias("n_lines"), removed.alias("n_removed"),
                      F.when(F.col("copy"), whole).otherwise(F.col("spans")).alias("spans"),
                      *[F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)])


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "text", "n_lines", "n_removed")


SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
w AS (SELECT *, sum(CASE WHEN trim(line, ' ') = '' THEN 0
                   ELSE length(trim(line, ' ')) - length(replace(trim(line, ' '), ' ', '')) + 1 END)
             OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l),
s AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY doc_id ORDER BY i), 0) AS before FROM w),
r AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM s a JOIN s b
      ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto >= a.before + {MIN_WORDS} GROUP BY a.doc_id, a.i
      UNION
      SELECT b.doc_id, max(a.i) AS i, b.i AS j FROM s a JOIN s b
      ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto >= a.before + {MIN_WORDS} GROUP BY b.doc_id, b.i),
k AS (SELECT r.doc_id, r.i, r.j, list_slice(d.ls, r.i, r.j) AS run FROM r JOIN d USING (doc_id)),
n AS (SELECT doc_id, i, j, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS copy FROM k),
x AS (SELECT DISTINCT n.doc_id, l.i FROM n JOIN l ON n.doc_id = l.doc_id AND l.i BETWEEN n.i AND n.j WHERE copy > 1),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text FROM l ANTI JOIN x
         ON l.doc_id = x.doc_id AND l.i = x.i GROUP BY l.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""
