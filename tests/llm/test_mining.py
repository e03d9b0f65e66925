"""Hard negatives, prefix trie and MinHash near duplicates: odd rows, cut paths, brute force."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from keyflow.llm import decontaminate, minhash, negatives, ngrams, preferences, tries
from tests.llm.test_llm import groups
from tools.compare import compare


def agrees(spark, tmp_path, name, rows, query, sql):
    """query and SQL over one table of rows give the same."""
    pq.write_table(rows, tmp_path / f"{name}.parquet")
    con = duckdb.connect()
    con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
    said, ok = compare(spark, con, name, query, sql, str(tmp_path))
    assert ok, said


def vectors(n=420, width=9, seed=4):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.05, 0.3) for _ in range(width)], rng.randrange(3)) for i in range(n)]
    rows += [(0, rows[0][1], rows[0][2]), (5, rows[5][1], rows[5][2]), (100, [0.5] * width, 1), (7, rows[8][1], 2)]  # repeated and second rows
    rows += [(1000 + i, rows[200][1], i % 2) for i in range(60)]  # ties
    rows += [(None, [0.1] * width, 1), (2000, None, 1), (2100, [0.1] * width, None), (2200, [0.1, None] + [0.1] * 7, 1), (2300, [float("nan")] * width, 1), (2400, [float("inf")] * width, 1)]
    rows += [(2500, [], 1), (2600, [0.4, 0.5], 1), (2700, [0.2] * (width + 4), 0), (-100, [0.1] * width, 2), (2800, [-0.2] * width, 1)]
    return pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32()), "score": pa.array([1] * len(rows))})


@pytest.mark.parametrize("how", [{}, {"block_rows": 16, "leaf": 2}, {"block_rows": 7, "leaf": 3, "limit": 0}])
def test_hard_negatives_on_odd_rows(spark, tmp_path, how):
    query = lambda s, d: negatives.mined(s.read.parquet(f"{d}/embeddings.parquet").repartition(3), **how)
    agrees(spark, tmp_path, "embeddings", vectors(), query, negatives.ORACLE)


def test_hard_negatives_of_nothing(spark, tmp_path):
    agrees(spark, tmp_path, "embeddings", vectors().slice(0, 0), lambda s, d: negatives.op11_hard_negatives(s, d), negatives.ORACLE)


def test_strassen_is_exact():
    rng = np.random.default_rng(3)
    for n, k, m in [(1, 1, 1), (5, 3, 7), (33, 17, 29), (64, 64, 64), (40, 1, 50), (9, 0, 9)]:
        for high in (300, 1 << 40):  # the second leaves the longs: equal modulo 2**64
            a, b = rng.integers(-high, high, (n, k)), rng.integers(-high, high, (k, m))
            assert (negatives.strassen(a, b, 2) == a @ b).all()


def test_windows_are_whole_numbers():
    p = np.array([0, 1, 7, 33, 1000, (1 << 62) + 12345, -5, -100])
    for percent in (30, 90):
        assert [int(x) for x in negatives._floor(p, percent)] == [int(x) * percent // 100 for x in p]
        assert [int(x) for x in negatives._ceil(p, percent)] == [-(-int(x) * percent // 100) for x in p]


def conversations(seed=9, n=90):
    """Families with long shared starts, whole copies, turnless ones, ties, nulls and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), n):
        turns = ["hi there", "again  hi"] + [f"word{rng.randrange(2)} x" for _ in range(rng.randrange(6))]
        rows += [(c, i if i != 1 else None, rng.choice(["user", "user", None]) if i > 2 else "user", x) for i, x in enumerate(turns[: rng.randrange(1, len(turns) + 1)])]
    rows += [(c, i, "user", f"turn {i}") for c in range(500, 640) for i in range(4)]  # copies
    rows += [(c, i, "bot", f"long {i}") for c in (700, 701) for i in range(300)] + [(701, 300, "bot", "　 last")]
    rows += [(801, 0, "a", None), (801, 0, None, "b"), (801, 0, "a", None), (None, 1, "a", "b"), (820, None, None, None), (821, None, "", "")]
    return pa.table({"conv_id": pa.array([r[0] for r in rows], pa.int64()), "turn": pa.array([r[1] for r in rows], pa.int64()), "role": pa.array([r[2] for r in rows], pa.string()), "text": pa.array([r[3] for r in rows], pa.string()), "key": pa.array([1] * len(rows)), "digest": pa.array(["x"] * len(rows))})


@pytest.mark.parametrize("chunk", [tries.CHUNK, 1, 7])
def test_trie_on_odd_rows(spark, tmp_path, chunk):
    agrees(spark, tmp_path, "conversations", conversations(), lambda s, d: tries.trie(s.read.parquet(f"{d}/conversations.parquet").repartition(5), chunk), tries.ORACLE)


def test_trie_of_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 3)
    agrees(spark, tmp_path, "conversations", conversations(5), lambda s, d: tries.trie(s.read.parquet(f"{d}/conversations.parquet")), tries.ORACLE)


def test_trie_of_nothing(spark, tmp_path):
    agrees(spark, tmp_path, "conversations", conversations().slice(0, 0), lambda s, d: tries.op12_prefix_trie(s, d), tries.ORACLE)


def test_branched_preferences(spark, tmp_path):
    """Every h from 0 to 3 has pairs, with prompts of h turns or more; marks inside texts end no turn."""
    table = conversations(11, 150)
    agrees(spark, tmp_path, "conversations", table, preferences.op6_preferences, preferences.ORACLE)
    got = preferences.op6_preferences(spark, str(tmp_path)).collect()
    assert {min(r["n_prompt_turns"], 3) for r in got} == {0, 1, 2, 3}
    df = spark.createDataFrame([(0, 0, "user", "a<|end|>\n<|assistant|>\nb"), (1, 0, "user", "<||")], "conv_id long, turn long, role string, text string")
    row = preferences.formatted(preferences.pairs(df)).first()
    assert row["chosen_text"] == "<|user|>\na<||end|>\n<||assistant|>\nb<|end|>\n" and row["rejected_text"] == "<|user|>\n<|||<|end|>\n"
    assert row["chosen_text"].count("<|end|>") == 1 and row["chosen_mask"] == "9:0,34:0"


def test_lcp():
    a = bytes(range(256)) * 80
    assert tries.lcp(a, a) == len(a) // 16 and tries.lcp(a, a[:100]) == 6 and tries.lcp(b"", a) == 0
    assert tries.lcp(a, a[:5000] + b"\xff" + a[5001:]) == (5000 // 16 if a[5000] != 255 else None)


def near(text, n, percent):
    """Plain sets of shingles, and their links by comparing all."""
    sets = {}
    for doc, words in text.items():
        words = words.encode().lower().split() if words else []
        sets[doc] = {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()
    ids = sorted(sets)
    return sets, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


def expected(text, n=3, percent=85):
    sets, links = near(text, n, percent)
    of = groups(list(text), links)
    return {d: (len(sets[d]), of[d], d == of[d]) for d in text}


def test_minhash_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.op13_minhash_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == expected({r["doc_id"]: r["text"] for r in docs.collect()})


def test_minhash_on_a_chain_and_a_large_group(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(150)]
    text = {}
    for i in range(40):  # each like the next, the ends not alike
        text[i] = " ".join(words)
        at = rng.randrange(len(words))
        words[at] = f"new{i}"
    base = [f"b{i}" for i in range(200)]
    for i in range(100, 300):
        own = list(base)
        own[i % 200] = f"own{i}"
        text[i] = " ".join(own)
    text |= {400: None, 401: "", 402: " \n", 403: "a b", 404: "A  b", 405: "a", 406: "x" * 60_000}
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in text.items()], "doc_id long, text string, node int, minima int").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["component_id"] == r["doc_id"]) for r in minhash.classes(df).collect()}
    assert got == expected(text)


@pytest.mark.parametrize("module", [minhash, ngrams])
def test_rows_without_ids_and_with_several_texts(spark, module):
    a, b = " ".join(f"a{i}" for i in range(300)), " ".join(f"b{i}" for i in range(300))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (None, a), (None, "q"), (4, a + " y"), (4, a + " y")]
    out = module.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    of = {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None}
    assert of[4] == of[2] and (of[2] == 1) != (of[3] == 1)  # one text of document 1 takes part, whole
    assert module.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_agreeing_bound():
    assert 100 < minhash.least_agreeing(85) < 136 and minhash.least_agreeing(100) == minhash.MINIMA


def test_decontamination_with_many_blocks(spark):
    """More blocks than memory addresses had been told apart by; parts of items in different blocks."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40).coalesce(1).cache()
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    show = lambda x: sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["hit_items"])) for r in x.withColumn("n_hit", decontaminate.n_hit()).collect())
    words = bench.select(decontaminate.F.sum(decontaminate.F.length("text"))).first()[0]
    few = words // 120
    assert len(list(decontaminate.blocks_of(bench, few))) >= 25
    assert show(decontaminate.annotate(docs, bench, block_words=few)) == show(decontaminate.annotate(docs, bench)) == show(decontaminate.annotate(docs, bench, part_words=20))


def test_decontamination_by_a_long_item(spark):
    n = 250_000
    text = " ".join(f"Q{i:x}" for i in range(n))
    bench = spark.createDataFrame([("long", text), (None, "a b"), (None, "c d")], "item_id string, text string")
    some = " ".join(f"q{i:x}" for i in range(99_990, 100_010))
    docs = spark.createDataFrame([(1, some), (2, "x a b y"), (3, "q1 q3 q5"), (4, f"a {some[:30]}")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["hit_items"]) for r in decontaminate.annotate(docs, bench).withColumn("n_hit", decontaminate.n_hit()).collect()}
    assert got == {1: (20, ["long"]), 2: (2, []), 3: (0, []), 4: (0, [])}
