"""Entities in clinical notes.

The notebooks ran a pretrained tagger note by note on the driver. Here the same
tables come out of distributed jobs:

* ``entity_spans``  -> (note, chunk, entity, start, end), token offsets, end exclusive
* ``note_entities`` -> one row per (note, chunk) holding the label of its last
                       mention and the position of its first
* ``entity_doc_freq`` -> (Drug, Frequency): notes per chunk, kept when >= 6,
                       most frequent first, ties in order of first appearance

The built-in extractor is a lexicon matcher: notes are tokenised by a regular
expression inside the JVM, runs of tokens are joined to a ``(term, entity)``
lexicon of terms of any number of tokens, and optional rules tag what the lexicon
does not know.
A caller-supplied model runs instead through ``extract_with_model``
(``mapInPandas``: one model load per task, Arrow batches of notes).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.joins import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, join_small,
                                      measured, stored)
from carelake.operators.parallel import spread
from carelake.session import ship_package

# The seven entity classes of the clinical tagger, in its order.
ENTITY_CLASSES = ["DRUG", "DOSAGE", "STRENGTH", "ROUTE", "FREQUENCY", "DURATION", "FORM"]

# Runs of letters and digits; a decimal point may stand between digits ("2.5mg").
TOKEN_PATTERN = "[A-Za-z0-9]+(?:[.][0-9]+[A-Za-z0-9]*)?"

SPAN_SCHEMA = "chunk string, entity string, start int, end int"


def _token_array(text, pattern: str = TOKEN_PATTERN):
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), F.lower)


def tokens(notes: DataFrame, key: str = "doc_id", text: str = "text",
           pattern: str = TOKEN_PATTERN) -> DataFrame:
    """One row per token: ``(key, pos, token)``; ``token`` is lower-cased after
    matching, ``pos`` counts tokens from 0. Whole texts are tokenised."""
    return (notes.select(key, F.posexplode(_token_array(F.col(text), pattern)).alias("pos", "token"))
            .select(key, F.col("pos").cast("int").alias("pos"), "token"))


def lexicon_from_text(texts: DataFrame, text: str = "text", min_len: int = 6, pairs: bool = False) -> DataFrame:
    """A ``(term, entity)`` lexicon: the distinct tokens of ``min_len``+ characters of
    a text column and, with ``pairs``, the pairs of such tokens that follow each
    other; the class is picked by the term's length (length mod 7)."""
    classes = F.array(*[F.lit(c) for c in ENTITY_CLASSES])
    t = _token_array(F.col(text))
    words = texts.select(F.explode(t).alias("term")).where(F.length("term") >= min_len)
    if pairs:
        both = texts.select(t.alias("t")).select(F.explode(F.transform("t", lambda x, i: F.struct(
            x.alias("a"), F.get("t", i + 1).alias("b")))).alias("p"))
        both = both.where((F.length("p.a") >= min_len) & (F.length("p.b") >= min_len))
        words = words.unionAll(both.select(F.concat_ws(" ", "p.a", "p.b").alias("term")))
    return words.distinct().select("term", F.element_at(classes, (F.length("term") % len(ENTITY_CLASSES) + 1).cast("int"))
                                   .alias("entity"))


def rule_words(rx: str) -> int:
    """Number of tokens a rule's expression spans: its spaces plus one."""
    return rx.count(" ") + 1


def entity_spans(notes: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text",
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 rules: dict[str, str] | None = None) -> DataFrame:
    """Matches in every note: ``(key, chunk, entity, start, end)``.

    Terms of the lexicon may span several tokens (``twice daily``). ``rules``
    (``{entity: regex}``, in order) tag what the lexicon does not know: a regex
    matches one lower-cased token as a whole or, with spaces in it, as many tokens
    (``{"STRENGTH": "[0-9.]+ ?mg", "DURATION": "[0-9]+ days"}``).

    Where matches overlap, the longest wins, then the earliest; equal spans go to the lexicon, then to
    the first rule (``_settled``). Notes are read and cut once: a token carries its lexicon match and its
    rule matches together. The lexicon is evaluated once and joined on the whole term: a token brings one run of
    tokens per length that terms and rules have, however many terms begin with it. It is joined as a
    broadcast when its size is proven small, else as a shuffle join with skewed
    partitions split. Each row is a note of its own, whatever its key. With single-token terms
    and no rules nothing can overlap and there is no shuffle (also on a stream of notes).
    """
    lex = stored(lexicon.select(_token_array(F.col("term")).alias("words"), "entity").where(F.size("words") > 0)
                 .select(F.array_join("words", " ").alias("chunk"), F.size("words").alias("n"), "entity", F.lit(True).alias("known")))
    sizes = sorted({r["n"] for r in lex.select("n").distinct().collect()} | {rule_words(r) for r in (rules or {}).values()}) or [1]
    alone = sizes == [1] and not rules
    note = [] if alone else [F.monotonically_increasing_id().alias(_NOTE)]
    t = _token_array(F.col(text))
    cut = spread(notes.select(key, text)).select(key, *note, t.alias("t"))
    names = [c for c in cut.columns if c != "t"]
    at = [*names, "start"]
    if sizes == [1]:
        runs = cut.select(*names, F.posexplode("t").alias("start", "chunk")).select(*at, "chunk", F.lit(1).alias("n"))
    else:
        grams = cut.select(*names, F.posexplode(F.transform("t", lambda x, i: F.slice("t", i + 1, sizes[-1]))).alias("start", "gram"))
        runs = (grams.select(*at, F.explode(F.array(*[F.when(F.size("gram") >= k, F.struct(
                    (F.concat_ws(" ", F.slice("gram", 1, k)) if k > 1 else F.col("gram")[0]).alias("chunk"), F.lit(k).alias("n"))) for k in sizes])).alias("x"))
                .where(F.col("x").isNotNull()).select(*at, "x.chunk", "x.n"))
    joined = join_small(runs, lex.drop("n"), "chunk", "left" if rules else "inner", max_rows=max_broadcast_rows, check="stored")
    known = F.col("known").isNotNull()
    found = [F.when(known, F.struct("entity", F.lit(0).alias("prio")))]
    for i, (label, rx) in enumerate((rules or {}).items(), 1):
        tagged = (F.col("n") == rule_words(rx)) & F.col("chunk").rlike(f"^(?:{rx})$")
        known = known | tagged
        found.append(F.when(tagged, F.struct(F.lit(label).alias("entity"), F.lit(i).alias("prio"))))
    hits = (joined.where(known).select(*at, "chunk", "n", F.explode(F.array_compact(F.array(*found))).alias("x"))
            .select(*names, "chunk", "x.entity", F.col("start").cast("int").alias("start"),
                    (F.col("start") + F.col("n")).cast("int").alias("end"), "x.prio"))
    return (hits.drop("prio") if alone else _settled(hits)).select(key, "chunk", "entity", "start", "end")


_NOTE = "__note"


def _settled(hits: DataFrame) -> DataFrame:
    """The matches that stand: longest first, then the earliest, the lowest ``prio``, the first label.

    Matches are shuffled by note and sorted in the order of choice; a match stands if none of
    its tokens is taken. As no match before it is shorter, its first and its last token
    tell. One pass, whose state is one byte per token of the note at hand: linear in the
    matches, however many overlap, and no note's matches are gathered.
    """
    ship_package(hits.sparkSession)
    columns = [c for c in hits.columns if c != _NOTE]
    rows = (hits.repartition(_NOTE).sortWithinPartitions(_NOTE, (F.col("start") - F.col("end")), "start", "prio", "entity")
            .select(*columns, _NOTE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, taken = None, bytearray()
        for b in batches:
            stands = []
            for note, start, end in zip(*(b.column(c).to_pylist() for c in (_NOTE, "start", "end"))):
                if note != here:
                    here, taken = note, bytearray()
                if len(taken) < end:
                    taken.extend(bytes(max(end, 2 * len(taken)) - len(taken)))
                free = not taken[start] and not taken[end - 1]
                if free:
                    taken[start:end] = b"\1" * (end - start)
                stands.append(free)
            yield b.filter(pa.array(stands, pa.bool_())).select(columns)

    return rows.mapInArrow(run, hits.select(*columns).schema)


def note_entities(spans: DataFrame, key: str = "doc_id", labels: list[str] | None = ENTITY_CLASSES) -> DataFrame:
    """One row per (note, chunk): the label of the chunk's last mention (a later
    mention overwrites an earlier one) and the token position of its first.

    With a closed label set (``labels``, default the seven classes), the label
    travels as its small integer code, so every aggregation buffer is fixed
    width and Spark runs a hash aggregate with map-side partial results (a
    chunk repeated many times in a huge note is combined before the shuffle).
    ``labels=None`` accepts any label text (sort-based aggregation).
    """
    if labels is None:
        return (spans.groupBy(key, "chunk")
                .agg(F.max_by("entity", "start").alias("entity"), F.min("start").alias("first_start")))
    codes = F.array(*[F.lit(x) for x in labels])
    pos = F.array_position(codes, F.col("entity")).cast("int")
    code = F.when(pos > 0, pos).otherwise(F.raise_error(F.concat(
        F.lit("entity label outside the declared label set: "), F.coalesce(F.col("entity"), F.lit("NULL")),
        F.lit(" (pass labels=None)"))))
    coded = spans.select(key, "chunk", "start", code.cast("int").alias("code"))
    out = (coded.groupBy(key, "chunk")
           .agg(F.max_by("code", "start").alias("code"), F.min("start").alias("first_start")))
    return out.select(key, "chunk", F.element_at(codes, F.col("code")).alias("entity"), "first_start")


def entity_doc_freq(entities: DataFrame, key: str = "doc_id", entity: str = "DRUG",
                    min_notes: int = 6, name: str = "Drug", count_name: str = "Frequency") -> DataFrame:
    """Number of notes that mention each chunk of one class, kept when at least
    ``min_notes``; sorted by that number descending, ties by first appearance
    (note order, then position in the note).

    ``(note, chunk)`` is unique here, so the first appearance is the note with
    the smallest key and the position in it: ``min`` and ``min_by`` over
    fixed-width values, which keeps the aggregation hash based.
    """
    return (entities.where(F.col("entity") == entity)
            .groupBy("chunk")
            .agg(F.count(F.lit(1)).alias(count_name),
                 F.min(key).alias("__first_note"),
                 F.min_by("first_start", key).alias("__first_start"))
            .where(F.col(count_name) >= min_notes)
            .orderBy(F.desc(count_name), "__first_note", "__first_start")
            .select(F.col("chunk").alias(name), F.col(count_name), F.col("__first_note").alias("first_note"),
                    F.col("__first_start").alias("first_start")))


# --- caller-supplied model -------------------------------------------------------------

BATCH_BYTES = str(64 * 1024 * 1024)

Extractor = Callable[[str], list[tuple[str, str, int, int]]]


def extract_with_model(notes: DataFrame, load_model: Callable[[], Extractor], key: str = "doc_id",
                       text: str = "text", key_type: str | None = None) -> DataFrame:
    """Run a model over every note: ``(key, chunk, entity, start, end)``.

    ``load_model`` is called once per task (not per note, not on the driver) and
    returns a function from a note's text to its spans. Notes reach Python in
    Arrow batches of ``BATCH_BYTES`` at most, so long notes do not make a batch unbounded.
    """
    key_type = key_type or notes.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, {SPAN_SCHEMA}"
    ship_package(notes.sparkSession)
    # Batches are cut by bytes as well as rows, whatever session the caller made.
    notes.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in batches:
            rows = []
            for k, t in zip(pdf[key].tolist(), pdf[text].tolist()):
                if t is None:
                    continue
                rows.extend((k, c, e, s, x) for c, e, s, x in model(t))
            yield pd.DataFrame(rows, columns=[key, "chunk", "entity", "start", "end"]).astype(
                {"start": "int32", "end": "int32"})

    return spread(notes.select(key, text)).mapInPandas(run, schema)


class LexiconModel:
    """A small stand-in model: lexicon lookup over regex tokens, with the same results
    as ``entity_spans``.

    The lexicon (as a real model its weights) is collected after its size is
    measured against a bound, and reaches the workers as a broadcast; a larger
    one belongs in ``entity_spans``. Each note is handled within its own row.
    """

    def __init__(self, lexicon: DataFrame, rules: dict[str, str] | None = None, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES):
        rows, size = measured(lexicon.select("term", "entity"))
        if rows > max_rows or size > max_bytes:
            raise ValueError(f"a lexicon of {rows} rows and {size} bytes is too large for every worker: use entity_spans")
        terms = sorted((r["term"], r["entity"]) for r in lexicon.select("term", "entity").where("term IS NOT NULL").collect())
        self.terms = lexicon.sparkSession.sparkContext.broadcast(terms)
        self.rules = list((rules or {}).items())

    def __call__(self) -> Extractor:
        import re

        rx = re.compile(TOKEN_PATTERN)

        def split(text: str) -> list[str]:
            return [m.group(0).lower() for m in rx.finditer(text)]

        by_first: dict[str, list[tuple[list[str], str]]] = {}
        for term, entity in self.terms.value:
            if words := split(term):
                by_first.setdefault(words[0], []).append((words, entity))
        rules = [(rule_words(r), re.compile(r), label, i) for i, (label, r) in enumerate(self.rules, 1)]

        def extract(text: str) -> list[tuple[str, str, int, int]]:
            toks = split(text)
            found = []
            for i, w in enumerate(toks):
                found += [(-len(words), i, 0, entity) for words, entity in by_first.get(w, ()) if toks[i:i + len(words)] == words]
                found += [(-k, i, prio, label) for k, r, label, prio in rules
                          if i + k <= len(toks) and r.fullmatch(" ".join(toks[i:i + k]))]
            taken, keep = bytearray(len(toks)), []
            for size, i, _, entity in sorted(found):
                if not any(taken[i:i - size]):
                    taken[i:i - size] = b"\1" * -size
                    keep.append((" ".join(toks[i:i - size]), entity, i, i - size))
            return keep

        return extract
