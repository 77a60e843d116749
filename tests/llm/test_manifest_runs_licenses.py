"""Merkle manifest, periodic runs and license scan against brute force, and their queries."""

import hashlib
import os
import random
import re
import tempfile
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starling.llm import licenses, merkle, queries, runs
from starling.llm.common import lower_ascii, prepare
from starling.llm.license_rules import KINDS, RULES, required_words
from starling.llm.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL

# other columns carry the names that the operators use themselves
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, g int, k string, t string, node string, "
          "load string, path string, rank int, total int, block int, part int, at int, runs string, n_words int, "
          "detections string, words string, keys string, given string, hits string, norm string, row int, info int")
TEXTS = [None, "", " \t\n", "one", "a b a b a b a b", "x " * 5000, "The MIT License", "straße ÄÖ K İ mit license",
         "Licensed under the Apache License, Version 2.0, and the mit-license.\nSPDX-License-Identifier: GPL-3.0-or-later",
         "cc by nc sa 4 0 the mit license all rights reserved", "the mit license " * 3000 + "end",
         "to be or not to be or not to be or not to be or not to be", "Kelvin cc\x01by\x00nc"]


def prepared(spark, rows):
    prepare(spark)
    full = [(i, t, lang, None if i == 3 else "s", None if t is None else len(t), 1, "k", "t", "n", "l", "p", 1, 1, 1, 1, 1,
             "r", 1, "d", "w", "k", "g", "h", "n", 1, 1) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(TEXTS)]
    rows += [(3, "one", None), (3, "one", None), (None, "no id", "en"), (None, None, None), (7, "another text", "de")]
    rows += [(100 + i, f"Row {i} of many", "es") for i in range(150)]
    return prepared(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- Merkle manifest -------------------------------------------------------------------
def brute_leaf(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for s in range(0, len(nodes), 8):
            run = nodes[s:s + 8]
            for j in range(len(run)):
                for i in under[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(sha("".join(run)))
            held.append(sum(under[s:s + 8], []))
        nodes, under = above, held
    return nodes[0], paths


def brute_manifest(rows, alter):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    parts = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r, r["text"])))
        parts.append((own, *brute_tree([brute_leaf(r, r["text"]) for r in own])))
    root, tops = brute_tree([p[1] for p in parts])
    out = []
    for (own, subroot, paths), top in zip(parts, tops):
        for r, path in zip(own, paths):
            path = path + top
            h = brute_leaf(r, alter(r))
            for left, right in path:
                h = sha(left + h + right)
            out.append((r["doc_id"], brute_leaf(r, r["text"]), subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def told(found):
    folded = merkle.fold(F.col("altered_leaf"), F.col("path"))
    rows = found.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))), folded,
                        folded == F.col("root")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("digits", [1, 2, 3])   # 1: tiers of 8 leaves each
def test_manifest_equals_brute_force(odd, digits):
    changed = F.when(F.col("doc_id") % 3 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))

    def alter(r):
        lower = r["doc_id"] is not None and r["doc_id"] % 3 == 0 and r["text"] is not None
        return re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]) if lower else r["text"]

    got = told(merkle.manifest(odd, COLUMNS, digits=digits, altered={"text": changed}))
    assert got == brute_manifest([r.asDict() for r in odd.collect()], alter)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_row_no_row_and_unchanged_rows(spark, odd, none):
    one = prepared(spark, [(5, "Text", None)])
    got = told(merkle.manifest(one, COLUMNS))
    assert got[0][1] == got[0][2] == got[0][3] == got[0][5] and got[0][4] == sha("") and got[0][6]
    assert merkle.manifest(none, COLUMNS).collect() == []
    assert all(r[-1] for r in told(merkle.manifest(odd, COLUMNS)))
    with pytest.raises(ValueError):
        merkle.manifest(odd, [])


def test_many_copies_of_one_row_lie_in_several_partitions(spark):
    rows = prepared(spark, [(1, "same", "en")] * 300)
    assert told(merkle.manifest(rows, COLUMNS, digits=1)) == brute_manifest([r.asDict() for r in rows.collect()], lambda r: r["text"])
    leaves = rows.select(F.col("lang").alias("g"), "doc_id", F.monotonically_increasing_id().alias("row"))
    numbered, most = merkle.number(leaves, ["doc_id", "row"])
    assert most == 300 and sorted(r["rank"] for r in numbered.collect()) == list(range(300))


# ---- periodic runs ----------------------------------------------------------------------
def brute_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(least, times * q) and i > first:
                at = (first - q, i - first + q)
                found[at] = min(q, found.get(at, q))
            i += i == first
    return sorted((s, n, q) for (s, n), q in found.items())


def test_find_runs_equals_brute_force():
    rng, total = random.Random(5), 0
    for _ in range(8000):
        words = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(0, 70))]
        if words and rng.random() < 0.6:
            p, s = rng.randint(1, 9), rng.randrange(len(words))
            words[s:] = (words[s:s + p] * 80)[:len(words) - s]
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = 9
        for least, times in ((6, 4), (4, 3)):
            got = runs.find_runs(words, least, times)
            assert got == brute_runs(words, least, times), words
            total += len(got)
    assert total > 3000
    with pytest.raises(ValueError):
        runs.find_runs([], times=2)


def test_find_runs_of_very_repetitive_texts():
    assert runs.find_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    short, long = "ab", "a"
    while len(short) < 20_000:
        long, short = short, short + long
    assert runs.find_runs(short) == []         # no stretch of a Fibonacci word repeats four times
    words = [f"w{i % 997}" for i in range(100_000)]
    assert runs.find_runs(words) == [(0, 100_000, 997)]


def test_detect_edge_cases(odd, none):
    got = {(r["doc_id"], r["n_words"]): r for r in runs.detect(odd).collect()}
    assert got[(0, 0)]["runs"] == [] and got[(0, 0)]["collapsed"] == ""
    assert [tuple(x) for x in got[(4, 8)]["runs"]] == [(0, 8, 2)] and got[(4, 8)]["collapsed"] == "a b"
    assert got[(5, 5000)]["collapsed"] == "x"
    assert got[(10, 9001)]["collapsed"] == "the mit license end"
    assert (None, 0) in got and (None, 2) in got
    assert runs.detect(odd).count() == odd.count() and runs.detect(none).collect() == []


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    old, n = list(words), len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else old[a + (i - a) % p] for i, w in enumerate(old)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda x: (x[0], x[2])))
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_op12_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    checked = [expected_runs(r["doc_id"], r["text"]) for r in docs if len(r["text"] or "") < 20_000]
    assert len(got) == len(docs) and all(got[e[0]] == e for e in checked) and any(e[1] for e in checked)


# ---- license scan --------------------------------------------------------------------------
def brute_scan(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    norm, kinds = " " + " ".join(words) + " ", list(KINDS)
    hits = []
    for i, r in enumerate(RULES):          # no prefilter
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm):
            first = norm.count(" ", 0, m.start()) - 1
            hits.append((first, first + m[0].count(" ") + 1, kinds.index(r.kind), i, r.label))

    def falls(a, b):
        contained = b[0] <= a[0] and b[1] >= a[1]
        outranked = b[2] < a[2] or (b[2] == a[2] and (b[1] - b[0] > a[1] - a[0] or b[3] < a[3]))
        return (contained and outranked) or (b[0] >= a[0] and b[1] <= a[1] and b[2] < a[2])

    stands = {a for a in hits if not any(falls(a, b) for b in hits if b != a)} if len(hits) < 2000 else None
    return len(words), hits, stands


def test_scan_equals_brute_force(spark):
    rng = random.Random(3)
    bits = ["the mit license", "apache license version 2", "licensed under the", "gnu general public license", "version 3",
            "or later", "cc by nc", "cc by nc sa 4 0", "all rights reserved", "spdx license identifier", "gpl 2 0", "public domain",
            "bsd 3 clause license", "released under the mozilla public licence", "creative commons attribution noncommercial",
            "the and of", "word", "licence", "share alike", "lgplv2 1", "dual licensed under the x"]
    rows = [(i, ", ".join(rng.choice(bits) for _ in range(rng.randint(0, 40))), "en") for i in range(300)]
    found = licenses.scan(prepared(spark, rows)).collect()
    want = {i: brute_scan(t) for i, t, _ in rows}
    for r in found:
        n, hits, stands = want[r["doc_id"]]
        got = {(h["first"], h["end"], h["kind"], h["rule"], h["label"]) for h in r["detections"]}
        assert r["n_words"] == n and got == set(hits)
        assert {(h["first"], h["end"], h["kind"], h["rule"], h["label"]) for h in r["detections"] if h["stands"]} == stands
    assert sum(len(w[1]) - len(w[2]) for w in want.values()) > 500


def test_scan_edge_cases(odd, none):
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.report(licenses.scan(odd)).collect()}
    assert [tuple(got[(0, 0)])[1:], tuple(got[(2, 0)])[1:]] == [(0, 0, None, None, "", "", 0.0)] * 2
    assert got[(6, 3)]["base_labels"] == got[(6, 3)]["labels"] == "mit"
    assert got[(8, 20)]["labels"] == "apache-2,gpl-3-later,mit"
    assert got[(9, 12)]["base_labels"] == "cc-by-nc,mit"
    assert got[(9, 12)]["labels"] == "cc-by-nc,cc-by-nc-sa,mit,rights-reserved"
    many = got[(10, 9001)]
    assert (many["n_base"], many["first_word"], many["last_word"]) == (3000, 0, 8997)
    assert got[(12, 4)]["base_labels"] == "cc-by-nc"
    assert licenses.scan(odd).count() == odd.count() and licenses.report(licenses.scan(none)).collect() == []


def test_rules_are_many_and_gated_by_words_they_need():
    assert len(RULES) > 300 and len({(r.kind, r.pattern) for r in RULES}) == len(RULES)
    assert all(r.required for r in RULES)
    assert required_words("gpl (?:version |v )?2") == (("gpl",),)
    assert required_words("share ?alike licen[sc]e") == (("licence", "license"),)
    assert required_words("(?:red|blue) open(?:ed)? (?:free code|x) hat") == (("blue", "red"), ("hat",))


def base_places(text):
    """n_words, n_base, first_word, last_word, base_labels as the query's contract defines them."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    hits = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i:i + p.count(" ") + 1] == p.split()]
    starts = [i for i, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in hits})))


def test_op13_query_reports_the_phrases_of_its_contract(spark):
    texts = [None, "", "The MIT License", "It is under the MIT License.", "UNDER-THE-MIT-LICENSE, under the mit license",
             "under the the mit license", "CC-BY-NC 4.0 or Apache License, Version 2.0", "under the m\u0130t license",
             "x under the MIT \u212aicense under the mit licenses under the mit license cc by nc"]
    folder = tempfile.mkdtemp(prefix="licenses-")
    prepared(spark, [(i, t, "en") for i, t in enumerate(texts)]).write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:6] for r in queries.op13_license_rules(spark, folder).collect()}
    assert got == {i: base_places(t) for i, t in enumerate(texts)}


def test_op13_query_does_the_whole_scan(spark):
    # the scan's own phrases too, not only the contract's: places, labels and score of "the mit license" without "under"
    texts = [None, "The MIT License", "under the MIT License", "see the mit license, the mit license or cc by nc",
             "the MIT license, cc by nc sa 4 0, all rights reserved", "permission granted as in the mit license file"]
    folder = tempfile.mkdtemp(prefix="licenses-")
    prepared(spark, [(i, t, "en") for i, t in enumerate(texts)]).write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_license_rules(spark, folder)
    names = ["n_phrases", "first_phrase", "last_phrase", "phrase_labels", "labels", "score"]
    whole = licenses.report(licenses.scan(prepared(spark, [(i, t, "en") for i, t in enumerate(texts)])))
    want = {r["doc_id"]: tuple(r)[2:] for r in whole.collect()}
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in got.collect()} == want
    assert want[1] == (1, 0, 0, "mit", "mit", 1.0) and want[3] == (3, 1, 8, "cc-by-nc,mit", "cc-by-nc,mit", 1.0)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, 'documents.parquet')}')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    want = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, want.fetchall()))
