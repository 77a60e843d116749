"""The pipeline's stages against brute force, on odd rows and on the smallest tables."""

import collections

import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from starling.llm import chains, softmix, thresholds
from starling.llm.common import TOKENIZER, prepare, table
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = {"_qm": "a", "_qm_text": "b", "_pv_key": "c", "t_hash": "d", "in_0": "e", "_in_1": "f", "n_words": "g", "copies": "h"}
PLAIN = "the river of the valley is long and the people in it have a boat for that water with no sail or oar "


def words(text):
    return [w for w in text.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()]


def fingerprint(text):
    w = words(text or "")
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows):
    """Connected components of fingerprints at 3 bits or fewer, pair by pair."""
    fps = [fingerprint(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[find(i)] = find(j)
    out = collections.defaultdict(list)
    for i, r in enumerate(rows):
        out[find(i)].append(r)
    return list(out.values())


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    body = [PLAIN * 3 + f"number {i} and word {i * 7919 % 1000} or {i * 104729 % 997}" for i in range(6)]
    rows = [(1, body[0]), (2, body[0]), (2, body[1]), (None, body[2]), (None, body[3]), (None, body[3]), (3, None), (4, ""),
            (5, "short"), (6, "spam " * 4000), (7, PLAIN * 400), (8, "x" * 30_000)]
    return spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], SCHEMA)


def test_quality_stage_keeps_what_the_rules_pass(spark, odd):
    wide = odd.withColumns({c: F.lit(v) for c, v in CLASHES.items()})
    good = P.quality_rules(spark, wide, SF_SMALL)
    assert good.columns == wide.columns
    verdicts = thresholds.assess(odd).where("kept").count()
    assert good.count() == verdicts and {r["_qm"] for r in good.collect()} <= {"a"}


def test_near_duplicate_stage_keeps_one_of_each_group(spark, odd):
    wide = odd.withColumns({c: F.lit(v) for c, v in CLASHES.items()})
    kept = P.near_duplicates(spark, wide, SF_SMALL)
    assert kept.columns == wide.columns and {r["_pv_key"] for r in kept.collect()} == {"c"}
    texts = collections.Counter((r["doc_id"], r["text"]) for r in kept.collect())
    found = groups(odd.collect())
    assert sum(texts.values()) == len(found)
    for group in found:
        assert sum(texts[(r["doc_id"], r["text"])] for r in {(r["doc_id"], r["text"]): r for r in group}.values()) == 1
        ids = [r["doc_id"] for r in group if r["doc_id"] is not None]
        if ids:         # the smallest id, nulls last
            assert any((min(ids), r["text"]) in texts for r in group if r["doc_id"] == min(ids))


def test_stages_of_an_empty_table_are_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name
        if name != P.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_the_stages_by_brute_force(spark):
    docs = table(prepare(spark), SF_SMALL, "documents")
    good = P.quality_rules(spark, docs, SF_SMALL).collect()
    kept = thresholds.assess(docs).where("kept").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in good) == sorted(r[0] for r in kept)
    firsts = sorted(min(r["doc_id"] for r in g) for g in groups(good))
    single = P.near_duplicates(spark, spark.createDataFrame(good, docs.schema), SF_SMALL)
    assert sorted(r["doc_id"] for r in single.collect()) == firsts
    clean = P.personal_data(spark, single, SF_SMALL)
    assert clean.count() == len(firsts)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    # mixing: every document that is not clearly toxic stays, with its rate's copies
    labelled = softmix.domains_of(table(spark, SF_SMALL, "labels"))
    model = softmix.fit_words(clean, labelled, softmix.DOMAINS)
    mixed = collections.Counter(r["doc_id"] for r in P.source_mixing(spark, clean, SF_SMALL).select("doc_id").collect())
    toxic = model.domains.index("toxic") if "toxic" in model.domains else None
    for r in softmix.rates(clean, model, [1.0] * len(model.domains)).collect():
        if toxic is None or r["p"][toxic] < P.CLEARLY:
            assert mixed[r["doc_id"]] >= 1
    out = P.run(spark, SF_SMALL).collect()
    assert collections.Counter(r["doc_id"] for r in out) == mixed
    tok = Tokenizer.from_file(TOKENIZER)
    for r in out:
        ids = tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["token_ids"]) == ids and r["decoded"] == tok.decode(ids, skip_special_tokens=False)


def test_training_takes_one_text_per_id_and_any_id_type(spark):
    prepare(spark)
    rows = [(f"d{i}", "bad awful words here" if i % 2 else "good kind words there") for i in range(40)]
    rows += [("d1", f"copy {i}") for i in range(500)]          # one id of very many rows
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumns({"k": F.lit(1), "t": F.lit("x"), "y0": F.lit(5)})
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, toxic int")
    chain = chains.train(docs, labels, ["toxic"])
    got = {r["doc_id"]: r["p"][0] for r in chains.score(docs.where("text not like 'copy%'"), chain).collect()}
    assert got["d3"] > 0.5 > got["d2"]


def test_shards_of_rows_whose_columns_clash(spark, odd):
    from starling.llm import extshuffle
    from starling.llm.common import scratch
    wide = odd.withColumns({"_before": F.lit("x"), "_before_": F.lit("y")})
    done = extshuffle.write_shards(wide, scratch(spark, "t")).collect()
    assert len(done) == odd.count() and {(r["_before"], r["_before_"]) for r in done} == {("x", "y")}
    for shard in {r["shard"] for r in done}:
        assert sorted(r["slot"] for r in done if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in done)))
