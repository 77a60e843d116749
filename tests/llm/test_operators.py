"""The LLM operators against brute force, on a small table of odd documents."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starling.llm import (anchors, bitplanes, brown, chains, extshuffle, graphparts, pivots, rankarray, softmix,
                          thresholds)
from starling.llm.common import TOKENIZER, prepare, scratch

SCHEMA = ("doc_id long, text string, lang string, spans int, fp string, k string, t string, token_ids int, "
          "size string, shard string, n_words int, kept string, rid int, bucket int")
WORDS = "the of and to in Uber straße naïve don't it's x 42 a1 end. (so) α Σας été".split()


def odd_texts():
    rng = random.Random(11)
    plain = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 90))) for _ in range(14)]
    return [None, "", " \t\n", "one", "Two words", *plain, plain[0], plain[0], plain[1] + " extra",
            "the same line\nthe same line\nother line\n" * 20, "w" * 5000, "long " * 6000,
            "mail a.b@c-d.org, +1 (202) 555-0100 4111 1111 1111 1111 10.0.0.255 x@y http://u.example/p.",
            "<|endoftext|> İstanbul ﬁ é  wide\u0085space <|ENDOFTEXT|>", "### *** $$$ |||" * 30]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "en", i, "x", "y", "z", 1, "s", "h", 0, "no", 5, 6) for i, t in enumerate(odd_texts())]
    rows += [(3, "one", *rows[0][2:]), (None, "no id here", *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_bit_planes_round_trip(spark, docs, empty):
    tok = Tokenizer.from_file(TOKENIZER)
    want = sorted(((i is not None, i or 0), tok.encode(t, add_special_tokens=False).ids + [1]) for i, t in texts(docs))
    for planes in ("byte", "bit"):
        folder = scratch(spark, "t")
        got = bitplanes.read_ids(bitplanes.write_ids(docs, folder, planes=planes, block=64), folder, True)
        got = sorted(got.collect(), key=lambda r: r["start"])
        assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["token_ids"]) for r in got) == want
        start = 0
        for r in got:
            assert (r["start"], r["n_tokens"]) == (start, len(r["token_ids"]))
            assert r["ids_crc32"] == zlib.crc32(np.array(r["token_ids"], "<u4").tobytes())
            start += r["n_tokens"]
        ids = [r["doc_id"] for r in got]
        assert ids[0] is None and ids[1:] == sorted(ids[1:])
    folder = scratch(spark, "t")
    assert bitplanes.read_ids(bitplanes.write_ids(empty, folder), folder).count() == 0


@pytest.mark.parametrize("bucket_rows", [brown.BUCKET_ROWS, 40])
def test_brown_base_and_normalisation(spark, docs, empty, monkeypatch, bucket_rows):
    monkeypatch.setattr(brown, "BUCKET_ROWS", bucket_rows)   # 40: many buckets
    got = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r
           for r in brown.score(docs, share=40, k=4, rounds=3).collect()}
    count = collections.Counter()
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in texts(docs)}
    cut = [(i, t.encode().lower().split() + [None]) for i, t in texts(docs)]
    for i, w in cut:
        if not held[i]:
            count.update(w)
    total, kinds = sum(count.values()), len(count)
    for i, w in cut:
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        r = got[(i, len(w), round(base, 6))]
        assert r["held_out"] == held[i] and r["train_tokens"] == total
        assert r["n_known"] == sum(count[x] > 0 for x in w) and r["score"] < 0
    assert brown.score(empty).count() == 0


def test_adjacency_rows_hold_every_neighbour_once(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 40)
    monkeypatch.setattr(brown, "BUCKET_ROWS", 300)
    rng = random.Random(4)
    given = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30))).encode() for _ in range(120)]
    words = sorted({w for t in given for w in brown.words_of(t)})[:9]
    ids = brown.Ids(words)
    want = collections.Counter()
    for t in given:
        own = [ids.end, *(ids[w] for w in brown.words_of(t)), ids.end]
        want.update(zip(own, own[1:]))
    total = sum(want.values())
    frame = spark.createDataFrame([(bytearray(t),) for t in given], "t binary").repartition(3)
    after, before = {}, {}
    for r in brown.adjacency(frame, words, total).collect():
        for name, out in (("after", after), ("before", before)):
            near, n = brown.unpack(r[name])
            assert len(near) == len(set(near.tolist()))
            out |= {(r["w"], i) if name == "after" else (i, r["w"]): c for i, c in zip(near.tolist(), n.tolist())}
    assert after == before == dict(want)


def test_exchange_gain_is_exact():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 4, (12, 12)).astype(float)
    of = rng.integers(0, 4, 12)

    def matrix(of):
        n = np.zeros((4, 4))
        np.add.at(n, (of[:, None].repeat(12, 1), of[None, :].repeat(12, 0)), pairs)
        return n

    for w in range(12):
        own = pairs[w, w]
        after = np.bincount(of, weights=pairs[w], minlength=4)
        before = np.bincount(of, weights=pairs[:, w], minlength=4)
        after[of[w]] -= own
        before[of[w]] -= own
        b, gain = brown.best_class(of[w], after, before, own, matrix(of), 4)
        values = []
        for c in range(4):
            moved = of.copy()
            moved[w] = c
            values.append(brown.likelihood(matrix(moved)))
        assert gain == pytest.approx(max(values) - values[of[w]], abs=1e-6)


def test_exchange_of_many_words_equals_that_of_one():
    rng = np.random.default_rng(1)
    words, k = 60, 9
    for _ in range(10):
        pairs = rng.integers(0, 3, (words, words)) * (rng.random((words, words)) < 0.08).astype(float)
        of = rng.integers(0, k - 1, words)
        of[-3:] = k - 1
        n = np.zeros((k, k))
        np.add.at(n, (of[:, None].repeat(words, 1), of[None, :].repeat(words, 0)), pairs)
        own = pairs.diagonal()
        sides = [np.stack([np.bincount(of, row, k) for row in m]) for m in (pairs, pairs.T)]
        for side in sides:
            side[np.arange(words), of] -= own
        for movable in (4, k - 1):
            w = np.flatnonzero(of < k - 1)
            entries = [(*np.nonzero(side[w]), side[w][np.nonzero(side[w])]) for side in sides]
            got = brown.best_classes(of[w], *entries, own[w], n, movable)
            for i, v in enumerate(w):
                if of[v] < movable:
                    assert got[i] == brown.best_class(of[v], sides[0][v], sides[1][v], own[v], n, movable)[0]


@pytest.mark.parametrize("bucket_rows, block", [(brown.BUCKET_ROWS, brown.BLOCK_TOKENS), (300, 200)])
def test_brown_moves_every_training_word(spark, monkeypatch, bucket_rows, block):
    # many buckets of the tail and many blocks, or one of each
    monkeypatch.setattr(brown, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(brown, "BLOCK_TOKENS", block)
    rng = random.Random(7)
    kinds = [[f"{kind}{i}{end}" for i in range(40) for end in "xyz"] for kind in ("noun", "verb", "name")]
    rows = [(i, " ".join(rng.choice(kinds[j % 3]) if j % 5 else rng.choice(["of", "the"]) for j in range(rng.randint(0, 40))))
            for i in range(150)]
    rows += [(200, None), (201, ""), (None, "noun1x verb1x"), (202, "Noun1x noun1x noun1x"), (202, "Noun1x noun1x noun1x"),
             (203, "never seen")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = brown.documents(frame, "doc_id", "text")
    model = brown.fit(docs, share=8, k=4, rounds=4)
    of = dict(zip(model.words, model.classes.tolist()))
    count = collections.Counter(dict(zip(model.words, model.counts.tolist())))
    keyed = {}
    told = {r["bucket"]: brown.expand(bytes(r["after"]))[0] for r in model.sent.where("src = -1").collect()}
    for r in model.tail.collect():
        steps, n = brown.expand(bytes(r["keys"]))
        keyed |= dict(zip(np.cumsum(steps, dtype=np.uint64).tolist(), zip(told[r["bucket"]].tolist(), n.tolist())))
    assert 2 <= len(of) < 16 and len(keyed) > 300 and (len(told) > 10) == (bucket_rows == 300)

    end, size = b"", 4 + brown.RARE + 1
    cut = [(i, [end, *brown.words_of((t or "").encode()), end]) for i, t in rows]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows}
    train = collections.Counter(w for i, words in cut for w in words[1:] if not held[i])
    for w in {w for _, words in cut for w in words} - {end} - set(of):
        of[w], count[w] = keyed[brown.key_of(w)]
    of[end], count[end] = size - 1, train[end]
    assert {w: n for w, n in count.items() if n} == dict(train)
    # a learned class for every word of the training texts but the few whose best one is where they begin
    learned = [of[w] < 4 for w in train if w != end]
    assert sum(learned) > 0.9 * len(learned)
    assert model.history[-1] > max(model.history[:5]) and model.history == sorted(model.history)

    moves = np.zeros((size, size))
    for i, words in cut:
        for a, b in zip(words, words[1:]):
            moves[of[a], of[b]] += not held[i]
    assert (moves == model.moves).all() and model.history[-1] == pytest.approx(brown.likelihood(moves))
    monkeypatch.setattr(brown, "fit", lambda *_: model)
    kinds_in = collections.Counter(of[w] for w in train)
    mass = moves.sum(axis=0)
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["score"], 6)) for r in
                              brown.score(frame, share=8, k=4, rounds=4).collect())
    want = collections.Counter()
    for i, words in cut:
        p = sum(math.log10((moves[of[a], of[b]] + 0.5) / (moves[of[a]].sum() + 0.5 * size)
                           * (count[b] + 0.1) / (mass[of[b]] + 0.1 * (kinds_in[of[b]] + 1))) for a, b in zip(words, words[1:]))
        want[i, len(words) - 1, sum(train[w] > 0 for w in words[1:]), round(p, 6)] += 1
    assert got == want


def test_chain_learns_and_stays_whole(spark, empty):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad, toxic = i % 4 == 0, i % 8 < 2
        words = [rng.choice("alpha beta gamma delta".split()) for _ in range(20)]
        words += ["junk"] * bad + ["nasty"] * toxic
        rows.append((i, " ".join(words), int(bad), int(toxic)))
    frame = spark.createDataFrame(rows + [(900, None, None, 1)], "doc_id long, text string, bad int, toxic int")
    chain = chains.train(frame.select("doc_id", "text"), frame.where("doc_id % 2 = 0 or doc_id % 8 = 1")
                         .select("doc_id", "bad", "toxic"), ["bad", "toxic"])
    assert len(chain[1].earlier) == 1
    p = {r["doc_id"]: r["p"] for r in chains.score(frame, chain).collect()}
    assert len(p) == 401
    right = sum((p[i][1] > 0.5) == bool(t) for i, _, _, t in rows if i % 2) / 200
    assert right > 0.95
    assert chains.score(empty, chain).count() == 0
    none = chains.train(frame, frame.where("false").select("doc_id", "bad", "toxic"), ["bad", "toxic"])
    assert all(r["p"][1] < 1e-9 for r in chains.score(frame, none).collect())


def test_rank_array_equals_the_library(spark, docs, empty):
    tok = Tokenizer.from_file(TOKENIZER)
    coded = rankarray.encode(docs, with_decoded=True)
    assert coded.columns == [c for c in docs.columns if c != "token_ids"] + ["token_ids", "decoded"]
    for r in coded.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids
        assert r["decoded"] == tok.decode(ids, skip_special_tokens=False)
    again = rankarray.decode(coded.withColumnRenamed("decoded", "was"))
    assert again.where("decoded <> was").count() == 0
    assert rankarray.encode(empty).count() == 0
    bpe = rankarray.encoder(open(TOKENIZER, "rb").read())
    piece = [bpe.inner[b] for b in b"thereinafterwardsomething" * 8]
    assert bpe.merge_short(list(piece)) == bpe.merge_long(list(piece))


def test_marks_and_case_equal_the_library():
    """Texts whose letters compose, lower or end in marks differently from their lower-case form."""
    tok = Tokenizer.from_file(TOKENIZER)
    bpe = rankarray.encoder(open(TOKENIZER, "rb").read())
    draw = random.Random(5)
    letters = "aAjJhHtTwWyYiI'S.,;:!?0 9\n_-|<>" + "".join(map(chr, (
        0x331, 0x338, 0x301, 0x308, 0x30C, 0x30A, 0x307, 0x345, 0xDF, 0xC4, 0x130, 0x131, 0x3A3, 0x3C2, 0x915, 0x93C,
        0x958, 0x1C5, 0x2B0, 0x4E2D, 0x85, 0xA0, 0x200B)))
    texts = ["<|startoftext|>J" + chr(0x30C), "abc." + chr(0x308), *(
        "".join(draw.choices(letters, k=draw.randint(1, 12))) for _ in range(5000))]
    for text in texts:
        assert bpe.encode(text) == tok.encode(text, add_special_tokens=False).ids, ascii(text)


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, limit=3):
    name = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for a in points:
            for b in points:
                if bin(a ^ b).count("1") <= limit and name[a] != name[b]:
                    name[a] = name[b] = min(name[a], name[b])
                    changed = True
    return name


def test_pivot_groups(spark, docs, empty):
    own = [(i, brute_fingerprint(t)) for i, t in texts(docs)]
    name = brute_components({f for _, f in own})
    first = {}
    for i, f in own:
        if i is not None:
            first[name[f]] = min(first.get(name[f], i), i)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in pivots.cluster(docs).collect()]
    assert sorted(got, key=repr) == sorted(((i, f, first.get(name[f])) for i, f in own), key=repr)
    kept = pivots.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(first.values())
    assert pivots.cluster(empty).count() == 0


def test_keep_one_tells_rows_with_one_id_apart(spark):
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(str(rng.randrange(10 ** 6)) for _ in range(40)) for _ in range(5))
    given = [(None, a, "x"), (None, b, "x"), (None, a, "y"), (None, c, "x"), (7, c, "x"), (1, d, "x"), (1, e, "x"),
             (1, e, "x"), (2, d, "x")]
    frame = spark.createDataFrame(given, "doc_id long, text string, k string").repartition(4)
    kept = [tuple(r) for r in pivots.keep_one(frame).collect()]
    assert sorted(r[:2] for r in kept if r[0] is not None) == sorted([(7, c), (1, d), (1, e)])
    assert sorted(r[1] for r in kept if r[0] is None) == sorted([a, b])
    again = [tuple(r) for r in pivots.keep_one(frame.repartition(1).orderBy(F.desc("k"))).collect()]
    assert sorted(kept, key=repr) == sorted(again, key=repr)


def test_large_group_is_cut_without_loss(monkeypatch):
    monkeypatch.setattr(pivots, "DIRECT", 16)
    rng = random.Random(2)
    points = sorted({rng.getrandbits(14) << 5 | 1 << 40 for _ in range(300)})
    roots = pivots.link_group(np.array(points, dtype=np.uint64), 3)
    want = brute_components(points)
    assert len({(r, want[p]) for p, r in zip(points, roots)}) == len(set(roots)) == len(set(want.values()))


def test_anchor_spans(spark, docs, empty):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
                "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, s):
        d = re.sub(r"[^0-9]", "", s)
        return {"email": True, "ip": all(int(x) <= 255 for x in s.split(".")) if kind == "ip" else True,
                "card": 14 <= len(d) <= 19 and anchors.luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    def brute(text):
        out = [(m.start(), m.end(), k) for k, p in patterns.items() for m in re.finditer(p, text) if valid(k, m[0])]
        return sorted(out, key=lambda s: (s[0], anchors.KINDS.index(s[2])))

    rng = random.Random(3)
    for letters in ("a1@.+- ()0é:/2", "0123456789 -.+"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert [s for s in anchors.find_spans(text) if s[2] in anchors.BASE_KINDS] == brute(text)
    found = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in anchors.detect(docs).collect()]
    assert sorted(found, key=repr) == sorted(((i, anchors.find_spans(t)) for i, t in texts(docs)), key=repr)
    clean = anchors.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    for r in anchors.detect(clean).collect():
        assert not [s for s in r["spans"] if s["kind"] in anchors.REDACTED]
    assert anchors.detect(empty).count() == 0
    assert anchors.redact_text("IBAN DE89 3704 0044 0532 0130 00, token = \"0123abcd99\"") == \
        "IBAN [ACCOUNT], token = \"[ACCOUNT]\""


def test_long_url_is_one_span():
    url = "https://u.example/" + "a" * 5000 + "?to=http://v.example/" + "b" * 9000
    assert [s for s in anchors.find_spans(f"see {url}, end") if s[2] == "url"] == [(4, 4 + len(url), "url")]


def test_external_shuffle_keeps_the_key_law(spark, docs, empty):
    done = extshuffle.write_shards(docs, scratch(spark, "t"), bucket_bytes=2000).collect()
    assert len(done) == docs.count()
    slots = collections.defaultdict(list)
    for r in done:
        slots[r["shard"]].append(r["slot"])
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(extshuffle.fisher_yates(50, 1).tolist()) == list(range(50))
    assert extshuffle.write_shards(empty, scratch(spark, "t")).count() == 0


def test_threshold_counts(spark, docs, empty):
    by_id = dict(texts(docs))
    for r in thresholds.assess(docs).collect():
        text = by_id[r["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {i + d for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"], r["n_symbols"]) == (
            len(words), sum(map(len, words)), len(covered), len(lines) - len(set(lines)),
            sum(text.count(c) for c in thresholds.SYMBOLS))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    kept = thresholds.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == thresholds.assess(docs).where("kept").count()
    assert thresholds.assess(empty).count() == 0


def test_soft_mix_meets_targets(spark, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(("a b c d", "e f g h", "i j k l")[i % 3].split()) for _ in range(30)), i % 3)
            for i in range(300)] + [(300, None, 0), (301, "", 1), (5, "a b", 2), (None, "e f", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, p int")
    labelled = frame.where("doc_id < 200").selectExpr("doc_id", "concat('d', p) as domain")
    model = softmix.fit_domains(frame, labelled, ["d0", "d1", "d2"])
    found = softmix.rates(frame, model, [0.5, 0.3, 0.2]).collect()
    assert len(found) == 304 and all(r["rate"] >= 0 for r in found)      # every row is a document of its own
    total = sum(r["n_tokens"] for r in found)
    for i, share in enumerate((0.5, 0.3, 0.2)):
        assert sum(r["rate"] * r["n_tokens"] * r["p"][i] for r in found) / total == pytest.approx(share, abs=1e-3)
        assert found[0]["reached"][i] == pytest.approx(found[0]["targets"][i], abs=softmix.TOLERANCE)
    mixed = softmix.mix(frame, model, [0.5, 0.3, 0.2])
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(r["copies"] for r in found)
    assert softmix.rates(empty.select("doc_id", "text"), model, [1, 1, 1]).count() == 0


def test_mixing_rates_rows_and_not_ids(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join([f"w{rng.randrange(200)}" for _ in range(30)] + ["scum", "idiot"] * bad)))
        labels.append((i, "toxic" if bad else "good"))
    shared = [(None, "scum idiot w1 w2 w3"), (None, "scum idiot w4"), *[(None, f"w{i} w{i + 1} w{i + 2}") for i in range(6)],
              (900, "scum idiot w8 w9"), (900, "w9 w10 w11"), (900, "w9 w10 w11")]
    frame = spark.createDataFrame(rows + shared, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as n_tokens", "2 as p", "3 as rate", "4 as copies", "5 as in_0", "6 as body")
    labelled = spark.createDataFrame(labels, "doc_id long, domain string")
    model = softmix.fit_words(frame, labelled, softmix.DOMAINS)
    kept = softmix.mix(frame, model, [1, 0], floor=lambda p: F.get(p, 1) < 0.9)
    assert kept.columns == frame.columns and kept.first()["rate"] == 3
    texts = {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert all((i, t) in texts for i, t in shared if "scum" not in t)
    found = {(r["doc_id"], r["n_tokens"]): r for r in softmix.rates(frame, model, [1, 0]).collect()}
    assert found[(900, 4)]["p"][1] > found[(900, 3)]["p"][1] + 0.3


def test_mixing_of_a_very_long_text(spark):
    rows = [(i, "good " * 5 if i % 2 else "bad " * 5) for i in range(100)] + [(100, "good " * 200_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = frame.where("doc_id < 100").selectExpr("doc_id", "if(doc_id % 2 = 1, 'good', 'poor') as domain")
    model = softmix.fit_domains(frame, labelled, ["good", "poor"])
    found = {r["doc_id"]: r for r in softmix.rates(frame, model, [1, 1]).collect()}
    assert found[100]["n_tokens"] == 200_000 and found[100]["p"][0] > 0.99
    # one text holds nearly all tokens: poor rows are raised until both domains weigh the same
    assert found[100]["reached"] == pytest.approx([0.5, 0.5], abs=softmix.TOLERANCE)


def test_mixing_keeps_what_is_not_clearly_toxic(spark, caplog):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        own = [f"w{rng.randrange(300)}" for _ in range(40)] + (["Scum", "idiot"] if bad else [])
        rows.append((i, " ".join(own), "x"))
        labels.append((i, "toxic" if bad else "good"))
    labels += [(i, "poor") for i in range(1000, 1200)]       # removed before: not in the documents
    rows += [(500, "", "x"), (501, None, "x"), (None, "w1 w2", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, k string")
    labelled = spark.createDataFrame(labels, "doc_id long, domain string")
    model = softmix.fit_words(frame, labelled, softmix.DOMAINS)
    assert model.domains == ("good", "toxic") and set(model.words) >= {"scum", "idiot"}
    assert model.prior == pytest.approx((351 / 402, 51 / 402))
    with caplog.at_level("INFO", logger=softmix.LOG.name):
        found = softmix.rates(frame, model, [0.999, 0.001], 0.5, floor=lambda p: F.get(p, 1) < 0.9).collect()
    assert "targets not met" in caplog.text and int(re.search(r"after (\d+) steps", caplog.text)[1]) < 20
    assert len(found) == 403
    for r in found:
        text = (dict((i, t) for i, t, _ in rows)[r["doc_id"]] or "").lower().split()
        logit = [math.log(model.prior[i]) + sum(model.weights[i][model.words.index(w)] for w in set(text)
                                                if w in model.words) / softmix.TEMPERATURE for i in range(2)]
        assert r["n_tokens"] == len(text)
        assert r["p"][1] == pytest.approx(1 / (1 + math.exp(logit[0] - logit[1])))
        assert r["copies"] >= 1 or r["p"][1] >= 0.9
    empty = spark.createDataFrame([], frame.schema)
    none = softmix.fit_words(empty, labelled, softmix.DOMAINS)
    assert none.domains == tuple(softmix.DOMAINS) and not none.words
    assert softmix.rates(empty, none, [1, 1, 1]).count() == 0
    assert softmix.rates(frame, none, [1, 1, 1]).count() == 403


def test_learned_partitions_recall(spark, empty):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1200, 16))
    x[100:400] = x[100]                                    # a hot vector: ties by the smaller id
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)]
    odd = [(5000, None, ""), (5020, [0.0] * 16, ""), (5040, [float("nan")] * 16, ""), (5060, [None] * 16, ""),
           (5080, [float("inf")] * 16, ""), (5100, [], "")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, k string")
    got = collections.defaultdict(list)
    for r in graphparts.search(frame, frame.where("vec_id % 20 = 0"), sample=512).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1200, 20))
    hits = 0
    for q, found in got.items():
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(f[2] == pytest.approx(s[f[1]], abs=1e-12) for f in found)
        hits += len({f[1] for f in found} & set(want.tolist()))
    assert hits / (20 * len(got)) >= 0.9
    few = graphparts.search(frame.where("vec_id < 3"), frame.where("vec_id = 0"))
    assert few.count() == 2
    none = spark.createDataFrame([], frame.schema)
    assert graphparts.search(none, none).count() == 0


def test_pipeline_stages_keep_clean_documents(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, sf)
    want = thresholds.assess(docs).where("kept").select("doc_id")
    assert sorted(r[0] for r in good.select("doc_id").collect()) == sorted(r[0] for r in want.collect())
    ids = [(r["doc_id"], hashlib.sha1((r["text"] or "").encode()).hexdigest()) for r in good.collect()]
    assert len(ids) == len(set(ids))
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} <= {i for i, _ in ids}
    assert out[0]["token_ids"] and F is not None


def test_library_encoder_equals_library_by_slices(monkeypatch):
    import random

    import pyarrow as pa
    with open(TOKENIZER, "rb") as f:
        coder = bitplanes.LibraryEncoder(f.read())
    rng = random.Random(11)
    signs = [*"abXYZİéüñßÅJHTWY.,;:!?%&*#$'<|>-_019 \t\n\x01\x1c\x85ıſΣς漢字", "̸", "̀", "̌",
             "　", "<|endoftext|>", "'s"]
    made = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(4000)]
    want = [e.ids for e in coder.tokenizer.encode_batch(made, add_special_tokens=False)]
    ids, counts = coder.encode_all(pa.array([t.encode() for t in made], pa.binary()), 1)
    assert ids.tolist() == [i for w in want for i in [*w, 1]] and counts.tolist() == [len(w) + 1 for w in want]
    # one text longer than a slice is coded in parts
    monkeypatch.setattr(bitplanes, "SLICE", 500)
    whole = " ".join(made)
    ids, counts = coder.encode_all(pa.array([whole.encode()]))
    assert ids.tolist() == coder.tokenizer.encode(whole, add_special_tokens=False).ids == ids[:counts[0]].tolist()
    # null, empty and broken texts
    ids, counts = coder.encode_all(pa.array([None, b"", b" \n"], pa.binary()), 1)
    assert ids.tolist() == [1, 1, 1] and counts.tolist() == [1, 1, 1]
    ids, _ = coder.encode_all(pa.array([b"\xff a\xc3"], pa.binary()))
    assert ids.tolist() == coder.tokenizer.encode("� a�", add_special_tokens=False).ids
