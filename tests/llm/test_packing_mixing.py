import random

import numpy as np
import pytest

from corpusmill.llm import mixing as M
from corpusmill.llm import packing as P
from corpusmill.llm import tokens as K


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def unpack(patterns):
    return [[s for s, n in p for _ in range(n)] for p, times in patterns for _ in range(times)]


def fewest(sizes, cap):
    """Exact, by branch and bound."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= sizes[i] and rooms[j] not in rooms[:j]:
                place(i + 1, rooms[:j] + [rooms[j] - sizes[i]] + rooms[j + 1 :])
        place(i + 1, rooms + [cap - sizes[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(4)
    for _ in range(150):
        cap = rng.randint(8, 40)
        sizes = [rng.randint(1, cap) for _ in range(rng.randint(1, 11))]
        counts = {s: sizes.count(s) for s in sizes}
        fixed, rest = P.reduce(counts, cap)
        left = [s for s, n in rest.items() for _ in range(n)]
        bins = unpack(fixed)
        assert sorted([s for b in bins for s in b] + left) == sorted(sizes) and all(sum(b) <= cap for b in bins)
        assert len(bins) + fewest(left, cap) == fewest(sizes, cap)
        assert P.lower_bound(counts, cap) <= fewest(sizes, cap)


def test_solve_packs_everything_tightly():
    rng = random.Random(6)
    for cap in (16, 100, 512):
        sizes = [min(cap, max(1, int(rng.expovariate(6 / cap)))) for _ in range(3000)]
        counts = {s: sizes.count(s) for s in set(sizes)}
        bins = unpack(P.solve(counts, cap))
        assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= cap for b in bins)
        assert len(bins) <= P.lower_bound(counts, cap) + 2
    assert P.solve({}, 10) == [] and P.solve({10: 3}, 10) == [(((10, 1),), 3)]
    # multiplicities far beyond what could be listed
    many = P.solve({7: 10**12, 3: 10**12, 5: 3}, 10)
    assert sum(t for _, t in many) == 10**12 + 2


SPECS = "spec_id int, capacity_tokens int, lang string"


@pytest.mark.parametrize("blocks", [256, 1])
def test_pack_places_every_piece_once(spark, monkeypatch, blocks):
    monkeypatch.setattr(P, "BLOCKS", blocks)
    rng = random.Random(8)
    docs = [(i, rng.choice(["en", "EN ", "de", None]), rng.choice([0, 5, rng.randint(1, 60)])) for i in range(150)] + [(7, "en", 33), (None, "en", 4)]
    sized = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, lang string, n_tokens bigint, container string, piece int")
    specs = spark.createDataFrame([(1, 20, None), (2, 50, "En"), (3, None, None), (4, 0, None)], SPECS)
    got = P.pack(sized, specs, "doc_id").toPandas()
    assert set(got.spec_id) == {1, 2}
    for spec, cap, ok in ((1, 20, docs), (2, 50, [d for d in docs if (d[1] or "").strip().lower() == "en"])):
        own = got[got.spec_id == spec]
        assert own.groupby("container").n_tokens.sum().max() <= cap
        assert own.n_tokens.sum() == sum(d[2] for d in ok)
        assert len(own) == sum(max(1, -(-d[2] // cap)) for d in ok)
        assert set(own.container) == set(range(1, own.container.max() + 1))
        split = own[own.piece > 0].doc_id.dropna()
        assert set(split) <= {d[0] for d in ok if d[2] > cap}
    rep = {r["spec_id"]: r for r in P.report(P.pack(sized, specs, "doc_id"), specs).collect()}
    assert rep[1]["containers"] <= rep[1]["fewest"] + 2


def test_pack_empty(spark):
    sized = spark.createDataFrame([], "doc_id bigint, lang string, n_tokens bigint")
    assert P.pack(sized, spark.createDataFrame([(1, 20, None)], SPECS), "doc_id").count() == 0
    sized = spark.createDataFrame([(1, "en", 3)], "doc_id bigint, lang string, n_tokens bigint")
    assert P.pack(sized, spark.createDataFrame([], SPECS), "doc_id").count() == 0


def test_token_counts(spark):
    count = K.encoder(VOCABULARY)
    docs = spark.createDataFrame([(1, "Hello, world! " * 50, "z"), (2, "", "z"), (3, None, "z"), (4, "Grüße – 你好 <|endoftext|>", "z"), (5, "x" * 100_000, "z")], "doc_id bigint, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in K.with_tokens(docs, ["doc_id"], VOCABULARY).collect()}
    assert got[2] == got[3] == 0 and got[1] == count(["Hello, world! " * 50])[0] and got[4] > 5 and got[5] > 0
    tok = K.encoder("/opt/tokenizers/byte_bpe_50k.json")
    texts = ["Some text, with numbers 123.", "naïve café"]
    assert tok(texts) == count(texts)
    assert all(n > 0 for n in K.encoder("/opt/tokenizers/piece_bpe_32k.model")(texts))


MIX = "mix_id int, source string, target_permille int, max_repeats int, total_tokens_permille int"


def test_mix_meets_shares(spark):
    docs = [(i, ["big", "Big ", "small", None][i % 4] if i % 40 else "tiny", 50 + i % 7) for i in range(4000)]
    sized = spark.createDataFrame([(*d, "c") for d in docs], "doc_id bigint, source string, n_tokens bigint, rate string")
    targets = spark.createDataFrame([(1, "BIG", 400, 3, 500), (1, "small", 500, 3, 500), (1, "tiny", 100, 2, 500), (2, "gone", 1000, 9, 100), (3, None, 1000, None, 100)], MIX)
    rep = {(r["mix_id"], r["source"]): r for r in M.report(sized, targets, "doc_id").collect()}
    assert abs(rep[1, "big"]["tokens"] / rep[1, "big"]["wanted_tokens"] - 1) < 0.05
    assert abs(rep[1, "small"]["tokens"] / rep[1, "small"]["wanted_tokens"] - 1) < 0.05
    assert rep[1, "tiny"]["short"] and rep[1, "tiny"]["most_copies"] == 2 and rep[1, "tiny"]["tokens"] == 2 * rep[1, "tiny"]["source_tokens"]
    assert rep[2, "gone"]["tokens"] == 0 and rep[2, "gone"]["short"] and rep[3, None]["tokens"] == 0
    got = M.mix(sized, targets, "doc_id").toPandas()
    rate = rep[1, "small"]["rate"]
    copies = got[(got.mix_id == 1) & (got.source == "small")].copies
    assert set(copies) <= {int(np.floor(rate)), int(np.floor(rate)) + 1}
    assert got.equals(M.mix(sized, targets, "doc_id").toPandas()) or len(got) == M.mix(sized, targets, "doc_id").count()


def test_mix_empty(spark):
    sized = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([(1, "a", 1000, 3, 500)], MIX)
    assert M.mix(sized, targets, "doc_id").count() == 0 and M.report(sized, targets, "doc_id").first()["tokens"] == 0
    assert M.mix(spark.createDataFrame([(1, "a", 0)], "doc_id bigint, source string, n_tokens bigint"), targets, "doc_id").count() == 0
