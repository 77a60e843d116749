"""Quality rules: a threshold table compiled into one Spark projection.

Each rule is a row ``(name, measure, least, most)``; a measure is a native
column expression over the measured counts.  The table compiles into a single
projection without user functions: the counts are computed once per row from
the whole text, the rules read them, and no row leaves its partition.

Defined results: a null text has no words and fails; an empty text likewise;
repeated rows get equal verdicts; an empty table gives an empty result; input
columns pass through untouched (the measures live in one struct column, which
replaces an input column of the same name).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import words_expr

SYMBOLS = "#*$%&|<>"
WINDOW = 3

# frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are an from or have not "
    "der die das und den von zu ist ein eine im für auf mit sich des dem nicht er es in als "
    "le la les de des et un une du que en est pour dans qui par sur au pas il plus "
    "el los las del y en que se por con para su al lo una como más"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str          # SQL over the fields of the measure struct
    least: float | None = None
    most: float | None = None

    def passes(self) -> Column:
        """True when the measure lies in the closed range."""
        value = F.expr(self.measure)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (value >= F.lit(self.least))
        if self.most is not None:
            ok = ok & (value <= F.lit(self.most))
        return F.coalesce(ok, F.lit(False))


# the threshold table; ratios are per word or per line with a word
RULES = (
    Rule("too_few_words", "n_words", least=50),
    Rule("repeated_windows", "100 * n_repeat_words - 50 * n_words", most=0),
    Rule("word_length", "word_chars / greatest(n_words, 1)", least=2.0, most=15.0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.1),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.01),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5),
)
# the rules that make up ``base_failed``
BASE = ("too_few_words", "repeated_windows")


def measure(df: DataFrame, text: str = "text", out: str = "quality_measures",
            stop_words=tuple(STOP_WORDS)) -> DataFrame:
    """Add a struct of counts over the whole text to every row."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = df.select(*[F.col(f"`{c}`") for c in keep], body.alias("_qm_text"))
    base = base.withColumn("_qm_words", words_expr(F.col("_qm_text")))
    w, n = F.col("_qm_words"), F.size("_qm_words")
    forms = sorted({f for x in stop_words for f in (x, x.capitalize(), x.upper())})
    hashes = F.transform(F.slice(w, 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
                         lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    base = base.withColumn("_qm_hashes", hashes)
    h = F.col("_qm_hashes")
    # (hash, position) of every window, sorted, so that equal windows are neighbours;
    # a text whose windows are all different has none to look for
    base = base.withColumn("_qm_sorted", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_qm_sorted")
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.when(i > 0, F.get(s, i - 1)["h"]) == x["h"], F.lit(False)))
    positions = F.sort_array(F.transform(twice, lambda x: x["i"]))
    # words covered by at least one repeated window: each window adds what the previous one left open
    covered = F.aggregate(
        positions, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")))["n"]
    lines = F.filter(F.split("_qm_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn("_qm_lines", lines)
    chars = F.length("_qm_text")
    out_struct = F.struct(
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (chars - F.length(F.translate("_qm_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("_qm_lines").cast("bigint").alias("n_lines"),
        (F.size("_qm_lines") - F.size(F.array_distinct("_qm_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(*forms))).cast("bigint").alias("n_stop_words"),
    )
    # the row number, always at hand, keeps the optimizer from copying the measures into
    # every rule and filter that reads them
    once = F.when(F.monotonically_increasing_id() >= 0, out_struct)
    return base.select(*[F.col(f"`{c}`") for c in keep], once.alias(out))


def verdicts(df: DataFrame, rules=RULES, base=BASE, measures: str = "quality_measures") -> DataFrame:
    """One row of verdicts per input row: measures, failed rule names, base_failed, kept."""
    flat = df.select("*", f"`{measures}`.*") if measures in df.columns else df
    failed = F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    base_failed = F.lit(False)
    for r in rules:
        if r.name in base:
            base_failed = base_failed | ~r.passes()
    kept = F.lit(True)
    for r in rules:
        kept = kept & r.passes()
    return flat.select("*", failed.alias("failed_rules"), base_failed.alias("base_failed"), kept.alias("kept"))


def assess(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Measures and verdicts per row, keyed by ``key``."""
    return verdicts(measure(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), text).drop(text), rules)


def keep_good(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Only the rows that pass every rule, with their own columns."""
    # input columns by position, so that none clashes with a measure
    rows = df.select(*[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(df.columns)])
    m = measure(rows, f"_in_{df.columns.index(text)}", out="_qm")
    passed = F.lit(True)
    for r in rules:
        passed = passed & r.passes()
    verdict = m.select(*rows.columns, "_qm.*").where(passed)
    return verdict.select(*[F.col(f"_in_{i}").alias(c) for i, c in enumerate(df.columns)])
