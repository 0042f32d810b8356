"""License scan by ordered signature rules, in DataFrame functions only.

A text is lower-cased and reduced to its words.  Documents without any of a
few root words are passed by; in the others each rule whose keyword occurs is
matched, and every place becomes an interval.  An interval that lies inside
another of the same or a higher priority is suppressed; the labels of the
others remain.  All work on a document happens in its own row: no shuffle.

The base phrases are looked for on their own, so their labels always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import read_table
from matchlake.llm.license_rules import CONFIDENCE, NAME, TAG, Rule, rules

# The phrases that always give their label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
           "cc by nc": "cc-by-nc"}

# A text without any of these holds no phrase and matches no rule (tested).
ROOTS = ("licen", "spdx", "gpl", "bsd", "fdl", "mpl", "eclipse", "mozilla", "cddl", "creative",
         "cc", "attribution", "domain", "reserved", "confidential", "prohibited", "permission",
         "redistribution", "advertising", "restriction", "warranty", "ofl", "consortium",
         "vimdoc", "copyleft", "copyright", "eupl", "bsl", "wtfpl")

_WORDS = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
_GAPS = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"


def word_line(text: Column) -> Column:
    """The words of a text in lower case with one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), _GAPS, " "))


def whole(pattern: str) -> str:
    """The pattern between word borders of a word line."""
    return f"(?<![^ ])(?:{pattern})(?![^ ])"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _rule_table(table: list[Rule]) -> Column:
    return F.array(*(F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                              F.lit(r.keyword).alias("keyword"),
                              F.lit(whole(r.pattern)).alias("pattern")) for r in table))


CHUNK = 256  # places added up in one step


def _places(line: Column, rule: Column) -> Column:
    """Intervals of one rule: lengths of the parts between and of the matches, summed up.

    Appending to an array copies it, so places are summed within chunks, then the
    chunks are shifted: the work grows with the number of places, not its square.
    """
    between = F.split(line, rule["pattern"], -1)
    found = F.regexp_extract_all(line, rule["pattern"], F.lit(0))
    sizes = F.zip_with(found, F.slice(between, 1, F.size(found)),
                       lambda m, b: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")))
    start = F.struct(F.lit(0).alias("at"),
                     F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        return F.struct(end.alias("at"), F.array_append(
            acc["out"], F.struct(begin.alias("start"), end.alias("end"))).alias("out"))

    def shifted(chunks: Column) -> Column:
        ends = F.aggregate(
            chunks, F.expr("cast(array(0) as array<int>)"),
            lambda acc, c: F.array_append(acc, F.element_at(acc, -1) + c["at"]))
        return F.flatten(F.zip_with(
            chunks, F.slice(ends, 1, F.size(chunks)), lambda c, by: F.transform(
                c["out"], lambda p: F.struct(
                    (p["start"] + by).alias("start"), (-(p["end"] + by)).alias("back"),
                    (-rule["priority"]).alias("rank"), rule["label"].alias("label")))))

    def chunked(all_sizes: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_sizes), F.lit(1)), F.lit(CHUNK))
        return F.transform(firsts, lambda i: F.aggregate(
            F.slice(all_sizes, i, F.lit(CHUNK)), start, add))

    # An array of one, so that the lambda's variable is computed once and used twice.
    chunks = F.transform(F.array(sizes), chunked)
    return F.element_at(F.transform(chunks, shifted), 1)


def _survivors(places: Column) -> Column:
    """Labels and best priority of the intervals that lie in no other of their priority or above.

    Sorted by start, longest and strongest first, an interval lies in an earlier
    one exactly if the largest end so far, among those of its priority or above,
    reaches its own end: one pass with one end per priority.
    """
    levels = range(NAME, TAG + 1)
    start = F.struct(*(F.lit(-1).alias(f"e{p}") for p in levels), F.lit(0).alias("best"),
                     F.expr("cast(array() as array<string>)").alias("labels"))

    def step(acc: Column, x: Column) -> Column:
        end, priority = -x["back"], -x["rank"]
        reached = F.coalesce(*(F.when(priority == p, acc[f"e{p}"]) for p in levels))
        free = reached < end
        return F.struct(
            *(F.when(priority >= p, F.greatest(acc[f"e{p}"], end)).otherwise(acc[f"e{p}"])
              .alias(f"e{p}") for p in levels),
            F.when(free, F.greatest(acc["best"], priority)).otherwise(acc["best"]).alias("best"),
            F.when(free, F.array_union(acc["labels"], F.array(x["label"])))
            .otherwise(acc["labels"]).alias("labels"))

    return F.aggregate(F.array_sort(places), start, step,
                       lambda acc: F.struct(acc["best"].alias("best"),
                                            acc["labels"].alias("labels")))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None,
         table: list[Rule] | None = None) -> DataFrame:
    """License detections of every row of (doc_id, text).

    Returns doc_id, n_words, n_base (places of the phrases), first_word and
    last_word (their smallest and largest start, in words from 0, else null),
    base_labels and labels (distinct, sorted, comma-joined; '' if none) and
    score (confidence of the strongest detection, 0 without one).  Null texts
    count as empty, repeated rows repeat, an empty table gives no rows, columns
    beside doc_id and text are ignored.
    """
    phrases = PHRASES if phrases is None else phrases
    table = rules() if table is None else table
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    low = df.select("doc_id", F.regexp_count("text", F.lit(_WORDS)).cast("long").alias("n_words"),
                    F.lower("text").alias("low"))
    marked = F.lit(False)
    for root in ROOTS:
        marked = marked | F.contains(F.col("low"), F.lit(root))
    lines = low.select("doc_id", "n_words",
                       F.when(marked, word_line(F.col("low"))).otherwise("").alias("line"))

    line = F.col("line")
    hits = {p: whole(p) for p in phrases}
    per = [F.when(F.contains(line, F.lit(p)),
                  F.regexp_count(line, F.lit(f"(?<![^ ])(?={p}(?![^ ]))"))).otherwise(0)
           .cast("long") for p in phrases]
    counted = lines.select("doc_id", "n_words", "line", F.array(*per).alias("per"))
    first, last, names = [], [], []
    for k, p in enumerate(phrases):
        found = F.col("per")[k] > 0
        at = F.regexp_instr(line, F.lit(hits[p])) - 1
        # (?s): the word line keeps U+0085, U+2028 and U+2029, where '.' would stop
        before = F.regexp_extract(line, f"(?s)^(.*(?<![^ ])){p}(?![^ ])", 1)
        first.append(F.when(found, _spaces(F.substring(line, F.lit(1), at))))
        last.append(F.when(found, _spaces(before)))
        names.append(F.when(found, F.lit(phrases[p])))
    base = counted.select(
        "doc_id", "n_words", "line",
        F.aggregate("per", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_base"),
        F.array_min(F.array(*first)).alias("first_word"),
        F.array_max(F.array(*last)).alias("last_word"),
        F.array_distinct(F.array_compact(F.array(*names))).alias("base"))

    hit = F.filter(_rule_table(table),
                   lambda r: F.contains(line, r["keyword"]) & F.rlike(line, r["pattern"]))
    places = F.flatten(F.transform(hit, lambda r: _places(line, r)))
    found = base.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base",
        F.when(line != "", _survivors(places)).alias("own"))
    own = F.coalesce(F.col("own.labels"), F.expr("cast(array() as array<string>)"))
    confidence = F.lit(0.0)
    for p, c in CONFIDENCE.items():
        confidence = F.when(F.col("own.best") == p, F.lit(c)).otherwise(confidence)
    score = F.greatest(confidence, F.when(F.col("n_base") > 0, F.lit(0.9)).otherwise(F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        score.alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
