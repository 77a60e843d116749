"""License scan: ordered signature rules over whole texts, in DataFrame functions only.

A text is normalised to its words joined by single spaces.  A prefilter keeps the words that any
rule needs (one hash lookup per word); a rule's regex runs only on texts that hold its required
words.  Matches are marked in the normalised text, so that one split gives the word number
of all of a rule's matches in linear time.

Overlaps: rules have a priority (their kind) and an order.  A detection falls if another one whose
interval contains its own has a higher priority, or the same one and is longer (of equal
intervals the earlier rule's stands), or if its interval contains one of a higher priority.  Partly
overlapping detections both stand.  Two sweeps over the sorted detections decide this, with
one running bound per priority, in blocks so that no list is copied per detection.

Defined results: a null, empty or blank text has no words and no detections; repeated rows
give repeated rows; a null key is kept; a text of any length is one row, scanned whole; an empty
table gives no rows; columns other than key and text are not read.  Only A-Z are matched in lower
case: the Kelvin sign, which lower-cases to an ASCII letter, is no letter of a rule.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import let, once
from starling.llm.license_rules import ALWAYS, KINDS, RULES, Rule

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"      # no word holds it
KELVIN, SMALL_KRA = "\u212a", "\u0138"      # a sign that lower-cases to k, and a letter that is no k
BLOCK = 256        # detections per block of a sweep
RULE = "struct<label:string,kind:int,rule:int,pattern:string,needs:array<array<string>>>"
HIT = "struct<first:int,end:int,kind:int,rule:int,label:string,stands:boolean>"


def rule_table(rules: tuple[Rule, ...]) -> Column:
    """The rules as a constant array, folded once by the optimizer."""
    kinds = list(KINDS)
    rows = [{"label": r.label, "kind": kinds.index(r.kind), "rule": i,
             "pattern": f"(?<= )({r.pattern})(?= )", "needs": r.required} for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), f"array<{RULE}>")


def matches(norm: Column, rule: Column) -> Column:
    """Detections of one rule in a normalised text, with the numbers of their words."""
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))

    def place(texts):
        words = F.split(F.regexp_replace(norm, rule["pattern"], F.lit(MARK + "$1")), " ")
        # the text starts with a space: word i is the part i + 1
        starts = F.filter(F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i - 1)),
                          lambda i: i.isNotNull())
        return F.zip_with(starts, texts, lambda s, t: F.struct(
            s.alias("first"), (s + F.size(F.split(t, " "))).alias("end"), rule["kind"].alias("kind"),
            rule["rule"].alias("rule"), rule["label"].alias("label"), F.lit(True).alias("stands")))

    return let(found, lambda texts: F.when(F.size(texts) > 0, place(texts)).otherwise(F.array().cast(f"array<{HIT}>")))


def sweep(hits: Column, start: int, falls: Callable, follow: Callable) -> Column:
    """``hits`` in their order with ``stands`` cleared where ``falls(bounds, hit)``.

    ``bounds`` has a number per kind, ``start`` at first, then ``follow(bounds, hit)``.
    """
    none = F.array().cast(f"array<{HIT}>")
    bounds = F.array(*[F.lit(start) for _ in KINDS])

    def judged(b, x):
        stands = x["stands"] & ~falls(b, x)
        return F.struct(*[x[c].alias(c) for c in ("first", "end", "kind", "rule", "label")], stands.alias("stands"))

    def step(a, x):
        return F.struct(follow(a["b"], x).alias("b"), F.concat(a["out"], F.array(judged(a["b"], x))).alias("out"))

    def blocks(all_hits):
        def block(a, k):
            inner = F.aggregate(F.slice(all_hits, k * BLOCK + 1, F.lit(BLOCK)),
                                F.struct(a["b"].alias("b"), none.alias("out")), step)
            return let(inner, lambda one: F.struct(one["b"].alias("b"), F.concat(a["out"], F.array(one["out"])).alias("out")))
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_hits) - 1) / BLOCK).cast("int"))
        nothing = F.struct(bounds.alias("b"), F.array().cast(f"array<array<{HIT}>>").alias("out"))
        return F.flatten(F.aggregate(numbers, nothing, block)["out"])

    return let(hits, lambda h: F.when(F.size(h) > 0, blocks(h)).otherwise(none))


def sorted_by(hits: Column, *keys: Callable) -> Column:
    ranked = F.transform(hits, lambda h: F.struct(*[k(h).alias(f"k{i}") for i, k in enumerate(keys)], h.alias("h")))
    return F.transform(F.sort_array(ranked), lambda x: x["h"])


def resolve(hits: Column) -> Column:
    """Detections in order of their place, with ``stands`` telling which ones stand."""
    first, end = (lambda h: h["first"]), (lambda h: h["end"])
    kind, rule = (lambda h: h["kind"]), (lambda h: h["rule"])
    # inner ones come first; per kind the greatest start among detections of a higher priority
    inner = sweep(sorted_by(hits, end, lambda h: -h["first"], kind, rule), -1,
                  lambda b, x: F.get(b, x["kind"]) >= x["first"],
                  lambda b, x: F.transform(b, lambda v, i: F.when(i > x["kind"], F.greatest(v, x["first"])).otherwise(v)))
    # outer ones come first; per kind the greatest end among detections of its or a higher priority
    return sweep(sorted_by(inner, first, lambda h: -h["end"], kind, rule), -1,
                 lambda b, x: F.get(b, x["kind"]) >= x["end"],
                 lambda b, x: F.transform(b, lambda v, i: F.when(i >= x["kind"], F.greatest(v, x["end"])).otherwise(v)))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, n_words, detections) of every row.

    A detection has its first word, the word after its last, its kind's place in ``KINDS``, its
    rule's place in ``rules``, its label, and whether it stands; all are given, in order of place.
    """
    needed = sorted({w for r in rules for one in r.required for w in one})
    lowered = F.lower(F.replace(F.coalesce(F.col("t"), F.lit("")), F.lit(KELVIN), F.lit(SMALL_KRA)))
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    rows = once(rows, "words", F.array_remove(F.split(lowered, SEPARATORS), ""))
    keys = F.array_intersect("words", F.split(F.lit(" ".join(needed)), " "))
    rows = once(rows.select("k", "words", keys.alias("keys")), "given", F.struct(
        F.size("words").cast("long").alias("n"), "keys",
        F.when(F.size("keys") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))).alias("norm")))
    rows = rows.select("k", F.col("given.n").alias("n"), F.col("given.keys").alias("keys"), F.col("given.norm").alias("norm"))
    tried = F.filter(rule_table(rules), lambda r: F.forall(r["needs"], lambda s: F.arrays_overlap(s, F.col("keys"))))
    found = F.flatten(F.transform(tried, lambda r: matches(F.col("norm"), r)))
    rows = once(rows, "hits", F.when(F.size("keys") > 0, found).otherwise(F.array().cast(f"array<{HIT}>")))
    name = key if key not in ("n_words", "detections") else "_key"
    return rows.select(F.col("k").alias(name), F.col("n").alias("n_words"), resolve(F.col("hits")).alias("detections"))


def labels(detections: Column) -> Column:
    """Labels of the given detections, distinct and sorted, as one text."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda h: h["label"]))), ",")


# columns for the places of a kind: their number, the first and the last one's first word, their labels
PLACES = {"base": ("n_base", "first_word", "last_word", "base_labels")}
# of the registered query: its contract's phrases, and then the base phrases
QUERY_PLACES = {"contract": PLACES["base"], "base": ("n_phrases", "first_phrase", "last_phrase", "phrase_labels")}


def report(found: DataFrame, places: dict[str, tuple[str, ...]] = PLACES) -> DataFrame:
    """Counts, places and labels of the first kind of ``places``, all labels, a score, then the other kinds' columns.

    The score is the greatest trust put in a detection that stands, 0 if there is none.
    """
    numbers = {kind: i for i, kind in enumerate(KINDS)}
    told = F.filter("detections", lambda h: h["stands"] | h["kind"].isin([numbers[k] for k in ALWAYS]))
    trust = F.array(*[F.lit(float(v)) for v in KINDS.values()])
    rest = [c for c in found.columns if c not in ("n_words", "detections")]

    def of(kind):
        return F.filter("detections", lambda h: h["kind"] == numbers[kind]).alias(kind)

    lists = F.struct(*map(of, places), told.alias("told"))
    found = once(found.select(*rest, "n_words", lists.alias("d")), "d", F.col("d"))

    def columns(kind):
        hits = F.col(f"d.{kind}")
        starts = F.transform(hits, lambda h: h["first"].cast("long"))
        values = (F.size(hits).cast("long"), F.array_min(starts), F.array_max(starts), labels(hits))
        return [v.alias(n) for v, n in zip(values, places[kind])]

    first, *others = places
    return found.select(
        *rest, "n_words", *columns(first), labels(F.col("d.told")).alias("labels"),
        F.coalesce(F.array_max(F.transform("d.told", lambda h: F.get(trust, h["kind"]))), F.lit(0.0)).alias("score"),
        *[c for kind in others for c in columns(kind)])
