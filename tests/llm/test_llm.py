"""Brute-force versions, round trips and odd inputs of the training-data operators."""

import gzip
import itertools
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from keyflow.llm import archives, decontaminate, graph, licenses, lines, ngrams, pieces, preferences, quality, registry, secrets, tokens
from tools.compare import compare

public_tokenizers = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x" * 50_000), (5, "a b c d e"), (5, "a b c d e"), (6, "one  two   three \n four <|endoftext|> ▁"), (7, "Zürich ﬁ① 日本 🎉 token = abcdef123"), (8, "a b c d e"), (None, "mit license")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"component": F.lit(1), "n_words": F.lit(2), "node": F.lit(3)})


@pytest.fixture
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_agrees_with_sql(spark, con, name):
    said, ok = compare(spark, con, name, registry.queries()[name], registry.oracle_sql()[name], DATA)
    assert ok, said


def groups(ids, links):
    top = {i: i for i in ids}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return {i: root(i) for i in ids}


def brute_ngrams(rows, n=4, percent=85):
    sets = {}
    for d, text in rows:
        w = (text or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    of = groups(sets, links)
    return sorted((d, len(s), of[d]) for d, s in sets.items())


def test_ngrams_against_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rng, base = random.Random(3), [f"w{i}" for i in range(120)]
    for i in range(60):  # a group of near copies, of which some are alike and some are not
        w = list(base)
        for _ in range(i % 6):
            w[rng.randrange(120)] = f"x{i}y{rng.random()}"
        rows.append((10_000 + i, " ".join(w)))
    rows += [(20_000 + i, "same words here") for i in range(40)] + [(30_000, None), (30_001, ""), (30_002, "  ")]
    got = sorted(tuple(r) for r in ngrams.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_ngrams(rows)


@pytest.mark.parametrize("percent", [60, 85])
def test_sets_that_meet_the_threshold_share_a_signature(percent):
    rng = np.random.default_rng(7)
    for size in [*range(1, 40), 63, 64, 127, 128, 300, 1023, 1024]:
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, size))
            cut = x[rng.permutation(size)[: rng.integers(-(-size * percent // 100), size + 1)]]
            y = np.unique(np.concatenate([cut, rng.integers(0, 1 << 63, rng.integers(0, size - len(cut) + 2))]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= percent * (len(x) + len(y) - common):
                assert np.intersect1d(ngrams.signatures(x, percent), ngrams.signatures(y, percent)).size


def test_ngrams_odd(odd, none):
    got = sorted((r[0] or 0, r[1], r[2] or 0) for r in ngrams.classes(odd).collect())
    assert len(got) == len(ODD) and (8, 2, 5) in got and (1, 0, 1) in got and (4, 1, 4) in got
    assert ngrams.classes(none).count() == 0


def alike(x: str, y: str) -> bool:
    """The definition of lines, with its own numbers."""
    def near(k):
        s, t = ({z[i : i + k] for i in range(len(z) - k + 1)} for z in (x, y))
        return bool(s and t) and 100 * len(s & t) >= lines.PERCENT * len(s | t)

    return x == y or near(lines.K) or (max(len(x), len(y)) <= lines.SHORT and near(lines.K_SHORT))


def edited(rng, text):
    """text with a character or a word changed, put in or left out."""
    if rng.random() < 0.6:
        at = rng.randrange(len(text))
        return text[:at] + rng.choice(["", "#", text[at] + "q"]) + text[at + 1 :]
    words = text.split(" ")
    words[rng.randrange(len(words))] = rng.choice(["omega", "pi"])
    return " ".join(words)


def test_lines_against_brute_force(spark):
    """Short and long lines, each with copies of one to three edits: links as by comparing all, but for what bands miss."""
    rng, rows = random.Random(5), []
    vocabulary = [rng.choice("bcdfgklmnprst") + "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(1, 8))) for _ in range(400)]
    for i in range(150):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 4, 5, 6, 8, 12, 16, 20, 30])))
        copies = [text]
        for _ in range(3):
            copies.append(edited(rng, copies[-1]))
        rows += [(10 * i + k, f"{c}\nshort\n\n  {c} \nunique {i} {k} {rng.random()}" if k == 0 else f"head {rng.random()}\n{c}") for k, c in enumerate(copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    all_ = [(d, i, x.strip()) for d, text in rows for i, x in enumerate(text.split("\n")) if x.strip()]
    links = [(a, b) for a, b in itertools.combinations(range(len(all_)), 2) if abs(len(all_[a][2]) - len(all_[b][2])) < 60 and alike(all_[a][2], all_[b][2])]
    members = defaultdict(list)
    for i, g in groups(range(len(all_)), links).items():
        members[g].append(all_[i][:2])
    want = {x for m in members.values() for x in sorted(m)[1:]}
    got = {tuple(r) for r in lines.duplicates(df).collect()}
    assert got <= want and len(want) > 500 and len(got) >= 0.985 * len(want), (len(got), len(want), sorted(got - want)[:3])


def test_lines_odd(odd, none):
    out = {r["doc_id"]: r["text"] for r in lines.deduplicated(odd).collect()}
    assert out[1] is None and out[2] == "" and out[5] == "a b c d e" and out[8] == ""
    assert lines.deduplicated(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    want = groups({x for p in links for x in p}, links)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in want.items() if i in got} and {i for i, c in want.items() if i != c} <= got.keys()


def test_token_files(spark, docs, odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = tokens.WordTokenizer(path).tokenizer
    for n, df in enumerate((docs.select("doc_id", "text"), odd.select("doc_id", "text"))):
        folder = f"file://{tmp_path}/{n}"
        tokens.store(df, path, folder)
        start, want = 0, []
        for r in sorted(df.collect(), key=lambda r: (r[0] is not None, r[0])):
            ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
            want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = sorted(map(tuple, tokens.read_store(spark, folder).collect()), key=lambda r: r[1])
        assert got == want
    tokens.store(none, path, f"file://{tmp_path}/none")


def test_rans_and_damage():
    ids = np.random.default_rng(0).zipf(1.3, 5000) % 1000
    for sample in (ids, np.full(2000, 7), np.array([5])):
        s, c = np.unique(sample, return_counts=True)
        f = tokens.Frequencies.of(list(zip(s.tolist(), c.tolist(), strict=True)))
        lanes, data = tokens.encode(sample.astype(np.int64), f)
        again = tokens.Frequencies.unpacked(f.packed())
        assert (tokens.decode(data, len(sample), lanes, again) == sample).all()
    block = bytearray(tokens.pack_block([(1, np.array([5, 5], "<u2").tobytes())], np.dtype("<u2"), f))
    block[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        tokens.unpack_block(bytes(block), 0, f)


def test_n_best_against_all_paths():
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))

    def every(text):
        found = [[] for _ in range(len(text) + 1)]
        found[0] = [(0.0, ())]
        for end, edges in enumerate(model.lattice(text)):
            for start, score, ids in edges:
                found[end] += [(s + score, i + ids) for s, i in found[start]]
        return sorted(found[-1], reverse=True)

    for text in ("hello", "a b", "the cat", "é①", "x\ny", "in  on"):
        ids, scores, how = model.encode(text)
        want = every(pieces.BLANK + text.replace(" ", pieces.BLANK))
        assert scores == [s for s, _ in want[: len(scores)]] and len(scores) == min(4, len(want))
        assert {tuple(model.path(text, h)) for h in how} <= {i for _, i in want}
        assert model.decode(ids.tolist()) == text
    for w in ("▁tionable", "▁onnt", "▁x"):
        _, score, loss = model.viterbi([w], len(w))
        best = model.best(w)
        assert score[0] == best[0][0] and (len(best) < 2 or loss[0] == best[0][0] - best[1][0])


def test_pieces_odd(odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    # the blank's own sign comes back as a blank
    assert all(r["decodes"] == (r["doc_id"] != 6) for r in pieces.encoded(odd, path).collect())
    assert pieces.encoded(none, path).count() == 0


def test_archive_versions_and_dates():
    for v in (1, 2):
        data = archives.arc_file(v, [("http://a/", "20200101000000", "text/html", b"HTTP/1.1 200 OK\r\n\r\nx\ny"), ("dns:a", "2020", "text/dns", b"")])
        assert [r[3] for r in archives.parse_arc(data)] == [b"HTTP/1.1 200 OK\r\n\r\nx\ny", b""]
    assert archives.warc_date("20200203040506") == "2020-02-03T04:05:06Z" and archives.warc_date("2020") == "2020-01-01T00:00:00Z" and archives.warc_date("x") == "1970-01-01T00:00:00Z"
    assert archives.warc_date("20201303040506") == "1970-01-01T00:00:00Z"
    assert archives.warc_kind("dns:a", b"") == "resource" and archives.warc_kind("ftp://a", b"HTTP/1.1 200 OK\r\n\r\n") == "response"
    one = archives.arc_file(1, [("http://a/b c", "20200101000000", "text/html", b"x")])
    assert [r[0] for r in archives.parse_arc(one)] == ["http://a/b c"]
    damaged = one + b"\nhttp://d/ 0.0.0.0 20200101000000 text/html many\nlost"
    assert [r[3] for r in archives.parse_arc(damaged)] == [b"x"] and list(archives.parse_arc(b"")) == []
    assert archives.unzipped(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab" and archives.unzipped(b"plain") == b"plain"


def test_archives_odd(spark, tmp_path):
    big = "y" * 200
    pages = spark.createDataFrame([(3, "http://a b", big), (2, None, big), (1, "u", None), (4, "u", "WARC/1.0\r\n\r\n"), (None, "u", big)], "page_id long, url string, html string")
    archives.write_warc(archives.with_revisits(archives.read_arc(archives.pages_to_arc(pages))), f"file://{tmp_path}/w")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in archives.read_warc(spark, f"file://{tmp_path}/w").collect()}
    other = spark.createDataFrame([(7, "ftp://h/x", big, 1), (8, "dns:h", big, 2)], "page_id long, url string, html string, digest int")
    archives.write_warc(archives.with_revisits(archives.read_arc(archives.pages_to_arc(other))), f"file://{tmp_path}/x")
    assert sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in archives.read_warc(spark, f"file://{tmp_path}/x").collect()) == [(7, 200, "response", None), (8, 200, "revisit", 7)]
    archives.write_warc(archives.with_revisits(archives.read_arc(archives.pages_to_arc(other.where("false")))), f"file://{tmp_path}/y")
    assert archives.read_warc(spark, f"file://{tmp_path}/y").count() == 0
    assert got == {3: (200, "revisit", 2), 2: (200, "response", None), 1: (0, "response", None), 4: (12, "response", None), None: (200, "response", None)}


def test_native_operators_odd(odd, none):
    for run in (licenses.scan, quality.ledger, lambda d: secrets.findings_by_path(d.withColumnRenamed("doc_id", "path"), secrets.scan_unseen(d.withColumnRenamed("doc_id", "path")))):
        assert run(odd).count() == len(ODD)
        assert run(none).count() == 0
    hits = {r["doc_id"]: len(r["hits"]) for r in licenses.scan(odd).collect()}
    assert hits[None] == 1 and hits[1] == 0


def test_ledger_sees_only_new_blobs(odd):
    paths = odd.withColumnRenamed("doc_id", "path")
    ledger = secrets.scan_unseen(paths)
    assert secrets.scan_unseen(paths, ledger).count() == 0
    assert secrets.scan_unseen(paths, ledger.where("size(findings) = 0")).count() == ledger.where("size(findings) > 0").count()


def test_ablation(docs):
    rows = quality.ledger(docs).select("doc_id", "fail_bits")
    bits = [r["fail_bits"] & quality.DEFAULT_POLICY.mask for r in rows.collect()]
    for r in quality.ablation(rows, quality.DEFAULT_POLICY).collect():
        bit = 1 << list(quality.RULES).index(r["rule"])
        assert (r["n_fail"], r["n_fail_alone"], r["n_kept_without"]) == (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))


def test_decontamination_blocks_agree(spark, odd, none):
    docs, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    short = spark.createDataFrame([(900, "a b"), (901, None), (902, "c")], bench.select("item_id", "text").schema)
    bench = bench.select("item_id", "text").unionByName(short)
    show = lambda df: sorted(map(str, df.withColumn("n_hit", decontaminate.n_hit()).select("doc_id", "n_words", "n_hit", "hit_items").collect()))
    assert show(decontaminate.annotate(docs, bench)) == show(decontaminate.annotate(docs, bench, block_words=300))
    got = {r["doc_id"]: r["hit_items"] for r in decontaminate.annotate(odd, short).collect()}
    assert got[5] == ["900", "902"] and got[1] == []
    unnamed = spark.createDataFrame([(None, "a b")], short.schema)
    assert [(r["n_hit"], r["hit_items"]) for r in decontaminate.annotate(odd.where("doc_id = 8"), unnamed).withColumn("n_hit", decontaminate.n_hit()).collect()] == [(2, [])]
    assert decontaminate.annotate(odd, bench.where("false")).count() == len(ODD) and decontaminate.annotate(none, bench).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, DATA), "test-" + name.split()[0])
        assert 0 < docs.count() <= before.count()
        if name == "n-gram jaccard":
            rows = brute_ngrams([tuple(r) for r in before.select("doc_id", "text").collect()], 5, 80)
            assert {r["doc_id"] for r in docs.collect()} == {d for d, _, c in rows if d == c}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, DATA).collect()} == {r["doc_id"] for r in docs.collect()}


def test_preferences_odd(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "a"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (1, 2, None, None), (2, 0, "user", "x"), (None, 0, "user", "y"), (4, 0, "user", "s"), (5, 0, "user", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pair_id", F.lit(9))
    got = {r["pair_id"]: tuple(r)[1:] for r in preferences.formatted(preferences.pairs(df)).collect()}
    assert got == {
        0: (1, "<|user|>\nhi<|end|>\n", "<|assistant|>\na<|end|>\n", "<|assistant|>\nb<|end|>\n<|unknown|>\n<|end|>\n", "14:0,9:1", "14:0,9:1,12:0,8:0"),
        2: (0, "", "<|user|>\nx<|end|>\n", "", "9:0,9:0", ""),
        4: (1, "<|user|>\ns<|end|>\n", "", "", "", ""),
    }
    assert preferences.formatted(preferences.pairs(df.where("false"))).count() == 0


NO_ID = [
    (None, "a line of its own in the first text without an id\nthe line that stands in all of these texts, here as well"),
    (None, "another line, unique and of the second text\nquite different words follow in this place, once only"),
    (None, "the line that stands in all of these texts, here as well\nsomething third, unlike everything before it"),
    (1, "the line that stands in all of these texts, here as well!\nquite different words follow in this place, once only"),
    (2, "nothing of this line is found elsewhere at all\nanother line, unique and of the second texts"),
]


def test_lines_without_ids(spark):
    """Each row without an id loses its own lines only, and lines that stand there first have their fuzzy links."""
    df = spark.createDataFrame(NO_ID, "doc_id long, text string")
    rows = lines.deduplicated(df).collect()
    kept = sorted(x for r in rows for x in r["text"].split("\n") if x)
    assert len(rows) == len(NO_ID)
    one = ["a line of its own in the first text without an id", "another line, unique and of the second text", "nothing of this line is found elsewhere at all", "quite different words follow in this place, once only", "something third, unlike everything before it"]
    assert [x for x in kept if not x.startswith("the line that stands")] == one
    assert len(kept) == len(one) + 1


def test_pipeline_keeps_texts_without_ids(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(corpus_pipeline.COLUMNS).where("length(text) > 400").limit(60)
    some = corpus_pipeline.written(docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id"))), "no-ids")
    assert some.where("doc_id is null").select("text").distinct().count() > 5
    for name, stage in corpus_pipeline.STAGES:
        had = some.where("doc_id is null").count()
        some = corpus_pipeline.written(stage(spark, some, DATA), "no-ids")
        if name == "n-gram jaccard":
            assert some.where("doc_id is null").count() == had > 5
    assert some.where("doc_id is null").count() > 0


def test_edits_of_short_lines(spark):
    """One character of lines of 30 to 80, and one word where 0.8 allows it, part no line from its copy; long lines of few words stay."""
    rng, rows, far = random.Random(11), [], []
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    for n in range(30, 81):
        line = " ".join(word() for _ in range(14))[: n - 1].strip() + "."
        line += "x" * (n - len(line))
        rows.append((line, line[: n // 2] + "#" + line[n // 2 + 1 :]))
        if n >= 66:
            line = " ".join(word() for _ in range(14))[:n].strip().ljust(n, "y")
            rows.append((line, line[:36] + "ZZZZZ" + line[41:]))
    few = [word() for _ in range(60)]
    far = [" ".join(rng.choice(few) for _ in range(1500)) for _ in range(6)]
    df = spark.createDataFrame([(i, "\n".join(p[i] for p in rows)) for i in range(2)] + [(10 + i, x) for i, x in enumerate(far)], "doc_id long, text string")
    got = {tuple(r) for r in lines.duplicates(df).collect()}
    assert got <= {(1, i) for i in range(len(rows))} and len(got) >= 0.97 * len(rows)


def test_all_n_best_come_out(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = pieces.Pieces(path)
    texts = ["hello", "a b", "the cat", "é① x", "in  on", "tokenization of unusual nonwordish strings", "aaaa aaaa", "abababab ' '' ---- ....", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pieces.encoded(df, path, with_ids=True)
    for r in out.select("*", *[pieces.path_ids(k).alias(f"p{k}") for k in range(pieces.N_BEST)]).collect():
        text = texts[r["doc_id"]] or ""
        found = [r[f"p{k}"] for k in range(pieces.N_BEST) if r[f"p{k}"] is not None]
        assert len(found) == r["n_paths"] == len(r["paths"]) and found[0] == r["ids"] and len({tuple(x) for x in found}) == len(found)
        # one word of all: the lattice of a text is that of its words put together
        want = model.best("".join(model.words(text))) if text else [(0.0, ())]
        assert [p["score"] for p in r["paths"]] == pytest.approx([s for s, _ in want])
        price = {}
        for end, edges in enumerate(model.lattice("".join(model.words(text)))):
            for _, s, ids in edges:
                price[ids] = s
        for ids, p in zip(found, r["paths"], strict=True):
            assert p["decodes"] and model.decode(ids) == text and p["n_pieces"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            if all((i,) in price for i in ids):
                assert sum(price[i,] for i in ids) == pytest.approx(p["score"])


def test_license_labels(spark):
    """Notices that differ in a word are told apart, wrapped ones are found, rows of one doc_id keep their own."""
    mit, bsd = licenses.NOTICES["mit-text"].split(), licenses.NOTICES["bsd"].split()
    rows = [
        (1, "Licensed under the GNU General Public License version 3"),
        (2, "This work is licensed under the GNU Lesser General Public License version 3"),
        (3, "This work is licensed under the GNU General Public License version 3"),
        (4, "Licensed under CC BY-NC 4.0"),
        (5, "Licensed under CC BY 4.0"),
        (6, "intro\n" + "\n".join(" ".join(mit[i : i + 7]) for i in range(0, len(mit), 7)) + "\nend"),
        (6, "nothing"),
        (7, "\n".join(" ".join(mit[i : i + 4]) for i in range(0, len(mit), 4))),
        (8, "Licensed under the\nApache License, Version 2.0 " + " ".join(f"w{i}" for i in range(60))),
        (9, "/*\n * " + "\n * ".join(" ".join(bsd[i : i + 3]) for i in range(0, len(bsd), 3)) + "\n */"),
        (10, " and ".join(mit)),
        (11, " and then ".join(mit)),
        (12, "Licensed under CC BY-NC 4.0. " + "Licensed under CC BY 4.0."),
    ]
    got = sorted((r["doc_id"], sorted({x["label"] for x in r["notices"] or ()})) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, []), (2, ["lgpl-3.0"]), (3, ["gpl-3.0"]), (4, ["cc-by-nc-4.0"]), (5, ["cc-by-4.0"]), (6, []), (6, ["mit-text"]), (7, ["mit-text"]), (8, ["apache-2.0"]), (9, ["bsd"]), (10, ["mit-text"]), (11, []), (12, ["cc-by-4.0", "cc-by-nc-4.0"])]


def test_group_of_near_copies_gives_few_pairs(spark, monkeypatch):
    """All differ from each other by more than the threshold allows, or by less: exact links, and no pair for each two of the rest."""
    rng, base = random.Random(2), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(150), i % 9):
            w[k] = f"x{i}y{k}"
        rows.append((i, " ".join(w)))
    made = []
    write = graph.Scratch.write
    monkeypatch.setattr(graph.Scratch, "write", lambda self, df, name: (made.append((name, out.count())), out)[1] if (out := write(self, df, name)) is not None else None)
    got = sorted(tuple(r) for r in ngrams.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_ngrams(rows)
    assert dict(made)["pairs"] < 2000


def test_small_groups_need_no_differences(spark, monkeypatch):
    """The index of buckets is dealt out once, and small groups are searched by marks: exact links, no table of differences."""
    rng, rows, made = random.Random(8), [], []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(100)]
        for i in range(9):
            w = list(base)
            for k in rng.sample(range(100), rng.randrange(6)):
                w[k] = f"x{g}y{i}z{k}"
            rows.append((10 * g + i, " ".join(w)))
    write = graph.Scratch.write
    monkeypatch.setattr(graph.Scratch, "write", lambda self, df, name: (made.append(name), write(self, df, name))[1])
    got = sorted(tuple(r) for r in ngrams.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_ngrams(rows) and len({r[2] for r in got}) > 12
    assert "mixed" in made and "deltas" not in made and "some" not in made


def test_odd_bits_never_exceed_the_difference():
    rng = np.random.default_rng(9)
    for size in (1, 5, 40, 300, 3000):
        x = np.unique(rng.integers(0, 1 << 63, size))
        y = np.unique(np.concatenate([x[size // 8 :], rng.integers(0, 1 << 63, size // 6)]))
        bits = np.bitwise_count((ngrams.bits_of(x) ^ ngrams.bits_of(y)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(x, y)) and (size < 40 or bits > 0)
    texts = ["abcabcabcabc abc", "one line", "one lines and more of them"]
    for k in (lines.K, lines.K_SHORT):
        sizes, bits = lines.marks_of(texts, k)
        sets = [lines.shingles(x, k) for x in texts]
        assert sizes.tolist() == [len(s) for s in sets]
        for i, j in itertools.combinations(range(3), 2):
            assert np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64)).sum() <= len(sets[i] ^ sets[j])


def test_lines_of_two_texts_under_one_id(spark):
    rows = [(1, "a line that is the same in both of these texts\nfirst text only, with words of its own"), (1, "a line that is the same in both of these texts\nother text zero has another line here")]
    out = sorted(r["text"] for r in lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sorted("\n".join(out).split("\n")) == ["a line that is the same in both of these texts", "first text only, with words of its own", "other text zero has another line here"]


def test_sketches_of_similar_lines():
    """Lines at 0.8 or above differ in graph.MOST bits at most, and most meet in a band."""
    rng, met, n = random.Random(4), 0, 0
    for _ in range(400):
        x = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(30, 400)))
        y = list(x)
        for _ in range(len(x) // 45):
            y[rng.randrange(len(x))] = "#"
        y = "".join(y)
        s, t = lines.shingles(x, 5), lines.shingles(y, 5)
        if len(s & t) >= 0.8 * len(s | t):
            sig = lines.signatures([x, y])
            bits = lines.sketches(sig)
            assert sum(int(a ^ b).bit_count() if a ^ b >= 0 else (int(a ^ b) + (1 << 64)).bit_count() for a, b in zip(bits[0].tolist(), bits[1].tolist(), strict=True)) <= graph.MOST
            n, met = n + 1, met + bool((np.equal(*lines.band_keys(sig, 5))).any())
    assert n > 100 and met >= 0.98 * n


def test_pipeline_stages_odd(spark, odd):
    """Nulls in any column, empty and long texts, repeated rows, no rows, and columns of other names: no stage fails, and a clean text stays."""
    import corpus_pipeline

    clean = " ".join("".join(random.Random(i).choice("abcdefgh") for _ in range(6)) for i in range(80))
    rows = odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"), "component", F.lit(3).alias("node"), F.lit(4).alias("n_hit"), F.lit("x").alias("dropped"))
    one = rows.limit(1).withColumns({"doc_id": F.lit(99).cast("long"), "text": F.lit(clean)})
    rows = corpus_pipeline.written(rows.unionByName(one).unionByName(one), "odd-rows")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, DATA)
        got = out.collect()
        assert 99 in {r["doc_id"] for r in got}, name
        assert stage(spark, rows.where("false"), DATA).count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == corpus_pipeline.COLUMNS
            assert {r["text"] for r in got if r["doc_id"] == 99} <= {clean}, name
