"""Quality rules: text statistics and a decision list learned from labels, in
DataFrame expressions only.

Statistics are row-local SQL expressions over whole texts (no shuffle). The
decision list is learned by sequential covering over labelled statistics: a rule
is a conjunction of threshold conditions, grown by information gain on two thirds
of the labelled rows, pruned on the other third, kept if it is precise there; the
rows it covers are set aside and the next rule is grown. Every growing step is one
aggregation (counts per feature and threshold bucket). The list is applied as an
ordered ``CASE WHEN`` expression.

The labelled rows used to fit are bounded: about ``SAMPLE`` rows, taken by a hash of
the key. The list is short by design, to stay readable: at most ``MAX_RULES`` rules of at most
``MAX_CONDITIONS`` conditions each, which bounds the fit's jobs; both cut what is learned, not what is judged.
Statistics and verdicts cover all rows, whole texts of any length; a null text counts as an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import checkpoint_root

SAMPLE = 20_000  # bound of the labelled rows used to fit
CUTS = 32  # thresholds per feature and class
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_COVER = 3  # labelled rows a condition must cover while growing
MIN_PRECISION = 0.9  # of a rule, on the rows it was not grown on
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (bound to a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(hashes: Column, width: int) -> Column:
    """Words in windows of ``width`` words that occur twice or more, from the words' hashes."""
    def covered(at: Column) -> Column:  # start positions, ascending: each adds what the next leaves free
        step = F.transform(at, lambda p, i: F.least(F.lit(width), F.get(at, i + 1) - p))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def of_sorted(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["p"])), covered)

    def of_windows(w: Column) -> Column:
        pairs = F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(F.sort_array(pairs), of_sorted))

    windows = F.transform(F.slice(hashes, 1, F.size(hashes) - (width - 1)),
                          lambda _, i: F.xxhash64(F.slice(hashes, i + 1, width)))
    return F.when(F.size(hashes) < width, F.lit(0)).otherwise(let(windows, of_windows))


def statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the statistics of each whole text (null: an empty text).

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word, equal to an earlier line), ``n_repeat_words``
    (words in 5-word windows found twice or more), ``n_adjacent`` (words equal to
    the word before), ``n_upper`` (capital letters). Columns of the same names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_adjacent", "n_upper"]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(t, WHITE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(h: Column) -> Column:
        adjacent = F.size(F.filter(h, lambda x, i: F.coalesce(F.get(h, i - 1) == x, F.lit(False))))
        return F.struct(F.size(h).cast("bigint").alias("n"), _repeat_words(h, 5).cast("bigint").alias("r"),
                        adjacent.cast("bigint").alias("a"))

    def removed(chars: str) -> Column:
        return (F.length(t) - F.length(F.translate(t, chars, ""))).cast("bigint")

    own = "__s" + "_" * max(map(len, docs.columns))  # no column of docs is called that
    # A generated row, not a projected one: filters on it are not pushed below, and no
    # optimizer rule computes the statistics again per use.
    of = docs.withColumn(own, F.explode(F.array(F.struct(
        let(F.transform(words, lambda w: F.xxhash64(w)), of_words).alias("w"),
        (F.length(t).cast("bigint") - removed(" \t\n\x0b\x0c\r")).alias("c"),
        removed(SYMBOLS).alias("s"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("d"),
        F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("bigint").alias("u")))))
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in [prefix + n for n in names]]
    field = {"n_words": "w.n", "word_chars": "c", "n_symbols": "s", "n_dup_lines": "d", "n_repeat_words": "w.r",
             "n_adjacent": "w.a", "n_upper": "u"}
    return of.select(*keep, *[F.col(f"`{own}`.{field[n]}").alias(prefix + n) for n in names])


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 10) | (100 * r > 20 * n)


def features(prefix: str = "") -> dict[str, Column]:
    """What conditions look at: shares that do not depend on a text's length."""
    c = {n: F.col(prefix + n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "n_adjacent", "n_upper")}
    n, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    return {"symbol_share": c["n_symbols"] / chars, "adjacent_share": c["n_adjacent"] / n, "upper_share": c["n_upper"] / chars,
            "repeat_share": c["n_repeat_words"] / n, "dup_lines_per_word": c["n_dup_lines"] / n, "word_length": c["word_chars"] / n}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        x, t = of[self.feature], F.lit(self.threshold)
        return x >= t if self.above else x < t


Rule = tuple  # of conditions, all of which hold


def _holds(rule: Rule, of: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(of)
    return out


def learn(labelled: DataFrame, label: str, names: list[str]) -> list[Rule]:
    """A decision list for rows with ``label`` = 0, from feature columns ``names``.

    ``labelled`` also has ``grow`` (boolean): rows to grow on; the others prune.
    """
    of = {n: F.col(n) for n in names}
    at = [(i + 0.5) / CUTS for i in range(CUTS)]
    quantiles = labelled.groupBy(label).agg(*[F.percentile(n, F.array(*map(F.lit, [0.0, *at, 1.0]))).alias(n) for n in names]).collect()
    if len(quantiles) < 2:
        return []
    # Thresholds between the two classes' quantiles, so that a cut lies off the values themselves.
    cuts = {}
    for n in names:
        v = sorted({x for r in quantiles for x in r[n] if x is not None})
        cuts[n] = sorted({(a + b) / 2 for a, b in zip(v, v[1:])})
    names = [n for n in names if cuts[n]]
    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(t)) for t in cuts[name]]), lambda t: t <= F.col(name)))

    binned = labelled.select("*", F.array(*[F.struct(F.lit(n).alias("f"), bin_of(n).alias("b")) for n in names]).alias("bins")) \
        .checkpoint()
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < MAX_RULES:
        rule = _grow(binned.where(left & F.col("grow")), label, cuts, of)
        if not rule:
            break
        # Prune: the shortest beginning of the rule with the best balance on the other rows.
        counts = binned.where(left & ~F.col("grow")).agg(*[x for k in range(1, len(rule) + 1) for h in [_holds(rule[:k], of)] for x in (
            F.count_if(h & (F.col(label) == 0)).alias(f"p{k}"), F.count_if(h & (F.col(label) != 0)).alias(f"n{k}"))]).first()
        worth = [((p - n) / (p + n) if p + n else -1.0, -k) for k in range(1, len(rule) + 1)
                 for p, n in [(counts[f"p{k}"], counts[f"n{k}"])]]
        k = -max(worth)[1]
        p, n = counts[f"p{k}"], counts[f"n{k}"]
        if p == 0 or p / (p + n) < MIN_PRECISION:
            break
        rules.append(rule[:k])
        left = left & ~_holds(rule[:k], of)
    return rules


def _grow(rows: DataFrame, label: str, cuts: dict[str, list[float]], of: dict[str, Column]) -> Rule:
    """Add the condition of the largest information gain until no good row is covered."""
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        got = (rows.where(_holds(rule, of)).select((F.col(label) == 0).alias("bad"), F.explode("bins").alias("x"))
               .groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect())
        if not got:
            return rule
        first = got[0]["f"]
        p0, n0 = (sum(r[k] for r in got if r["f"] == first) for k in ("p", "n"))
        if p0 == 0 or n0 == 0:
            return rule
        best = None
        for f in sorted({r["f"] for r in got}):
            p, n = [0] * (len(cuts[f]) + 1), [0] * (len(cuts[f]) + 1)
            for r in got:
                if r["f"] == f:
                    p[r["b"]], n[r["b"]] = r["p"], r["n"]
            below_p = below_n = 0
            for i, t in enumerate(cuts[f]):
                below_p, below_n = below_p + p[i], below_n + n[i]
                for above, a, b in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                    if a < MIN_COVER or a + b == p0 + n0:
                        continue
                    gain = a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0)))
                    if gain > 0 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, Condition(f, above, t))
        if best is None or (rule and best[1] in rule):
            return rule
        rule = (*rule, best[1])
    return rule


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> list[Rule]:
    """A decision list from labelled documents that pass the base rules.

    About ``sample`` labelled keys are taken by a hash of the key (a bounded table,
    broadcast to the documents). A key with several labels counts as its lowest;
    null keys and labels are left out. No label of one of the kinds: no rule.
    """
    checkpoint_root(docs.sparkSession)
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("k")).agg(F.min(F.col(label)).cast("int").alias("label")))
    n = known.count()
    u = F.shiftrightunsigned(F.xxhash64("k"), 34) / float(1 << 30)
    chosen = known.where(u < min(1.0, sample / n) if n else F.lit(False)).checkpoint()
    if chosen.count() > 2 * sample + 1000:  # a hash sample stays near its expectation
        raise ValueError("the labelled sample is larger than its bound")
    mine = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")
    of = features()
    rows = (statistics(mine).where(~base_failed())
            .select("label", (F.pmod(F.xxhash64("k", F.lit("grow")), F.lit(3)) < 2).alias("grow"), *[c.alias(n) for n, c in of.items()])
            .checkpoint())
    return learn(rows, "label", list(of))


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The number (from 1) of the first rule that holds, or 0."""
    of, out = features(prefix), None
    for i, r in enumerate(rules, 1):
        out = F.when(_holds(r, of), i) if out is None else out.when(_holds(r, of), i)
    return out.otherwise(0) if out is not None else F.lit(0)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` plus the statistics, ``base_failed``, ``rule`` (the first learned rule
    that holds, 0: none) and ``kept``. A null or empty text fails the base rules.
    Repeated rows give repeated results; columns of the new names are replaced."""
    s = statistics(docs, text)
    s = s.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return s.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the list, with their columns as they are."""
    own = "__q_" + "_" * max(map(len, docs.columns))  # no column of docs starts like that
    s = statistics(docs, text, own).where(~base_failed(own) & (verdict(rules, own) == 0))
    return s.select(*[F.col(f"`{c}`") for c in docs.columns])
