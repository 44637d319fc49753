"""Spelling variants by composition of finite-state machines.

The words of a vocabulary that differ by exactly one inserted, deleted or
replaced code point are the pairs accepted by V o E o V, where V is the
minimised acceptor of the vocabulary and E the transducer that copies, makes
one edit and copies on.  Until the edit both copies of V are in the same state,
so a pair is found at the state where its words first differ: position p, the
length of their common prefix.  This first difference is the one place where a
pair counts, which makes every pair appear once.

Partition by initial state.  For a shorter length l and an interval [lo, hi) of
edit positions, the words of length l and l + 1 that agree on the first lo code
points and on the last l - hi start their composition in one state: they are
one group, and only what lies between (the middle) is composed.  A word joins
the two halves [0, l // 2) and [l // 2, l) for l = its length and for l = its
length - 1, four groups in all; the last interval also holds the edit at the
end.  Groups of more than ``GROUP_ROWS`` words or ``GROUP_CHARS`` characters
are not gathered: their rows go on to the two halves of their interval, until
it is one position wide, where a group holds at most the alphabet's worth of
words (squared for the longer ones).  Group sizes come from a partial and final
count, so a prefix shared by a third of all words meets no single task.

In a group two acceptors (length l and l + 1) share one register of minimal
states, so that equal states have equal futures.  After the edit both sides
must read the same rest: the rests two states share are enumerated once for a
pair of states.

Groups are streams of sorted rows in a task; only one is held at a time.

Defined results.  Null and empty texts have no runs; a null id counts as empty
text in the hash.  Repeated rows count as often as they come.  An empty table
gives no words.  Words of any length are taken whole.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import UPPER, table, written

GROUP_ROWS, GROUP_CHARS = 20_000, 4_000_000
DEEP = 400  # beyond this word length rests are walked with a stack and not kept
LETTERS = r"A-Za-zÀ-ÿ"  # fixed by the contract of the query
MISSPELT, LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 97, 5, 3, 2


class Acceptor:
    """Minimal acyclic acceptors of several sorted word lists in one register.

    State 0 accepts the empty rest only; a state is (final, arcs)."""

    def __init__(self):
        self.final, self.arcs, self.register = [], [], {}
        self.shared: dict[tuple[int, int], list[str]] = {}
        self.rests: dict[int, list[str]] = {}
        self.longest = 0

    def _state(self, final: bool, arcs: tuple) -> int:
        key = (final, arcs)
        got = self.register.get(key)
        if got is None:
            got = self.register[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(dict(arcs))
        return got

    def add(self, words: list[str]) -> int:
        """The start state for these sorted distinct words: words are added in
        order, and the branch that a new word leaves is made minimal."""
        path = [[False, []]]  # open states of the last word: final, arcs
        chars: list[str] = []

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1].append((chars.pop(), self._state(final, tuple(arcs))))
        for w in words:
            self.longest = max(self.longest, len(w))
            same = 0
            while same < len(chars) and same < len(w) and chars[same] == w[same]:
                same += 1
            close(same)
            for c in w[same:]:
                chars.append(c)
                path.append([False, []])
            path[-1][0] = True
        close(0)
        return self._state(path[0][0], tuple(path[0][1]))

    def rest(self, s: int) -> list[str]:
        """All words accepted from a state."""
        got = self.rests.get(s)
        if got is None:
            got = [""] if self.final[s] else []
            for c, t in self.arcs[s].items():
                got += [c + r for r in self.rest(t)]
            self.rests[s] = got
        return got

    def common(self, s: int, t: int) -> list[str]:
        """All words accepted from both states."""
        if self.longest > DEEP:
            return self._walked(s, t)
        if s == t:
            return self.rest(s)
        key = (s, t) if s < t else (t, s)
        got = self.shared.get(key)
        if got is None:
            got = [""] if self.final[s] and self.final[t] else []
            a, b = self.arcs[s], self.arcs[t]
            for c in (a if len(a) <= len(b) else b):
                if c in a and c in b:
                    got += [c + r for r in self.common(a[c], b[c])]
            self.shared[key] = got
        return got

    def _walked(self, s: int, t: int) -> list[str]:
        got, todo = [], [("", s, t)]
        while todo:
            x, s, t = todo.pop()
            if self.final[s] and self.final[t]:
                got.append(x)
            a, b = self.arcs[s], self.arcs[t]
            todo += [(x + c, a[c], b[c]) for c in a if c in b]
        return got


def near_middles(short: list[str], long: list[str], positions: int, at_end: bool):
    """Pairs (u, v) of middles that first differ at one of the first
    ``positions`` places (or, with ``at_end``, behind u): u, v of ``short`` by
    a replacement, or u of ``short`` and v of ``long`` by an insertion.  Both
    lists are sorted and distinct."""
    if not short or len(short) + len(long) < 2:
        return
    if len(short) == 1 and len(long) == 1:
        (u,), (v,) = short, long
        p = next((k for k, (a, b) in enumerate(zip(u, v)) if a != b), len(u))
        if u[p:] == v[p + 1:] and (p < positions or at_end):
            yield u, v
        return
    m = Acceptor()
    todo = [("", m.add(short), m.add(long) if long else None)]
    while todo:
        x, s, r = todo.pop()
        arcs, wide = m.arcs[s], m.arcs[r] if r is not None else {}
        edits = len(x) < positions
        if edits and len(arcs) > 1:  # replaced
            steps = list(arcs.items())
            for k, (a, sa) in enumerate(steps):
                for b, sb in steps[k + 1:]:
                    for rest in m.common(sa, sb):
                        yield x + a + rest, x + b + rest
        for b, rb in wide.items():  # inserted before a different character, or behind the last
            after = m.arcs[rb]
            if edits:
                for a, sa in arcs.items():
                    if a != b and a in after:
                        for rest in m.common(sa, after[a]):
                            yield x + a + rest, x + b + a + rest
            if m.final[s] and m.final[rb] and (edits or at_end):
                yield x, x + b
        if len(x) + 1 < positions or (at_end and len(x) < positions):
            for c, t in arcs.items():
                todo.append((x + c, t, wide.get(c)))


GROUP = ["l", "lo", "hi", "prefix", "suffix"]


def _streamed(batches):
    """Rows (l, lo, hi, prefix, suffix, size, middle, n) sorted by group ->
    both directions of every near pair."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))
    out: list[tuple[str, str, int]] = []

    def batch():
        got = pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
                                          pa.array([o[2] for o in out], pa.int64())], ["word", "near", "near_n"])
        out.clear()
        return got
    for (l, lo, hi, prefix, suffix), members in groupby(rows(), key=lambda r: r[:5]):
        short, long, n = [], [], {}
        for r in members:
            (short if r[5] == l else long).append(r[6])
            n[r[6]] = r[7]
        for u, v in near_middles(short, long, hi - lo, hi == l):
            a, b = prefix + u + suffix, prefix + v + suffix
            out.append((a, b, n[v]))
            out.append((b, a, n[u]))
            if len(out) >= 20_000:
                yield batch()
    if out:
        yield batch()


def _middles(rows: DataFrame, intervals: Column) -> DataFrame:
    """Rows (word, n, size, l) -> one row per interval (lo, hi) of edit
    positions, with what the group shares and the middle."""
    rows = rows.select("word", "n", "size", "l", F.explode(intervals).alias("i")).select("*", "i.lo", "i.hi")
    back = F.col("l") - F.col("hi")
    return rows.select(
        "l", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("prefix"),
        F.substring("word", F.col("size") - back + 1, back).alias("suffix"), "size",
        F.substring("word", F.col("lo") + 1, F.col("size") - back - F.col("lo")).alias("middle"), "n", "word")


def near_pairs(vocabulary: DataFrame, group_rows: int = GROUP_ROWS, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(word, near, near_n): both directions of every pair of near words of
    ``vocabulary`` (word string, n long; distinct words)."""
    size = F.length("word")
    words = vocabulary.select("word", "n", size.alias("size"), F.explode(F.array(size, size - 1)).alias("l")).filter("l > 0")

    def halves(lo, hi):
        mid = F.floor((lo + hi) / 2).cast("int")
        return F.filter(F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi"))),
                        lambda i: i["lo"] < i["hi"])
    open_rows = written(_middles(words, halves(F.lit(0), F.col("l"))))
    found = None
    while True:
        big = written(open_rows.groupBy(*GROUP).agg(F.count("*").alias("rows"), F.sum("size").alias("chars"))
                      .filter((F.col("rows") > group_rows) | (F.col("chars") > group_chars)).filter("hi - lo > 1").select(*GROUP))
        split = bool(big.take(1))
        small = open_rows.join(big, GROUP, "left_anti") if split else open_rows
        got = (small.drop("word").repartition(*GROUP).sortWithinPartitions(*GROUP, "middle")
               .select(*GROUP, "size", "middle", "n").mapInArrow(_streamed, "word string, near string, near_n long"))
        found = got if found is None else found.unionByName(got)
        if not split:
            return found
        rest = open_rows.join(big, GROUP, "left_semi")
        open_rows = written(_middles(rest.select("word", "n", "size", "l", halves(F.col("lo"), F.col("hi")).alias("parts")),
                                     F.col("parts")))


def spelling_forms(vocabulary: DataFrame, factor: int = FORM_FACTOR, group_rows: int = GROUP_ROWS,
                   group_chars: int = GROUP_CHARS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word: its form is the
    near word of largest n (ties: the smallest) if that is at least ``factor``
    times its own; root follows the forms to the last."""
    vocabulary = vocabulary.select("word", "n")
    best = (near_pairs(vocabulary, group_rows, group_chars).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    worth = F.col("best.less") <= -factor * F.col("n")
    words = written(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(worth, F.col("best.near")).alias("form"), F.when(worth, -F.col("best.less")).alias("form_n")))
    # forms grow in n, so chains end; each round doubles the steps taken
    steps = words.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = written(steps)
        far = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("next"), "further")
        if not joined.filter("further is not null").take(1):
            break
        steps = joined.select("word", F.col("next").alias("root"))
    return words.join(steps, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def word_counts(docs: DataFrame, misspelt: int = MISSPELT, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the runs of letters of every whole text, A-Z lowered, where a
    hash of id and run names one in ``misspelt`` to lose one code point."""
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, UPPER.lower())
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(lowered, f"[^{LETTERS}]+")).alias("run")).filter("run <> ''")
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    words = (runs.select("run", h.alias("h")).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
             .select(F.when(F.col("h") % misspelt == 0, F.expr("concat(substring(run, 1, at), substring(run, at + 2))"))
                     .otherwise(F.col("run")).alias("word")))
    return (words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def op13_spelling(spark, sf_dir) -> DataFrame:
    vocabulary = written(word_counts(table(spark, sf_dir, "documents", "doc_id", "text")))
    return spelling_forms(vocabulary).select("word", "form", "root", "n", "n_near", "form_n")
