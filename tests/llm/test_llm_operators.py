"""The training-data operators on small tables, against brute force and exact round trips."""

import base64
import hashlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from oracle_harness import compare, duck_connect, duck_rows, spark_rows
from vintagelake.llm import bpe, html, jaccard, langid, lines, mixing, outliers, sketch, vptree, warc, zclass
from vintagelake.llm.common import read

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long"
rng = np.random.default_rng(5)


def prose(n, words=60):
    return " ".join(f"w{rng.integers(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, copies and near copies, an extra column."""
    base = prose(80)
    edited = base.split()
    edited[40] = "other"
    long = prose(6000, 4000)
    rows = [(1, base, "en", "a"), (2, base, "en", "b"), (3, " ".join(edited), "de", "a"), (3, " ".join(edited), "de", "a"),
            (4, "", "en", "a"), (5, None, "en", None), (6, " \n\t ", None, "b"), (7, "One two", "de", "b"),
            (8, "one TWO", "de", "b"), (None, prose(70), None, None), (None, None, None, None), (9, long, "en", "a"),
            (10, long + " tail", "en", "b"), (11, "x" * 5000, "en", "c"), (12, "\n".join([prose(9), base, prose(9)]), "en", "c")]
    return spark.createDataFrame([(*r, 0, 0) for r in rows], DOCS)


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    low = {}
    for c, (d, _) in zip(comp, rows):
        low[c] = min((x for x in (low.get(c), d) if x is not None), default=None)
    return sorted(((d, len(s), low[c]) for (d, _), s, c in zip(rows, sets, comp)), key=str)


@pytest.mark.parametrize("hot", [jaccard.HOT_LIST, 1])
def test_jaccard_edge_cases(docs, hot):
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = sorted((tuple(r) for r in jaccard.jaccard_components(docs, hot_list=hot).collect()), key=str)
    assert got == want


def test_jaccard_chains_and_small_sets(spark):
    base = prose(60, 500).split()
    rows = [(i, " ".join(base[i:i + 40 - i % 3])) for i in range(12)]
    rows += [(100 + i, prose(int(rng.integers(1, 12)), 3)) for i in range(80)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_jaccard_whole_table(spark):
    rows = [tuple(r) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]
    got = E.queries()["op1_ngram_jaccard_join"](spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_first_of_groups_keeps_every_column(docs):
    kept = jaccard.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, 7, None, None, 9, 11], key=str)


def test_hasher_cuts_long_texts(monkeypatch):
    import pyarrow as pa
    texts = ["a b c d e f g", "", None, "Z" * 40, prose(50), "é É x y z w"]
    hasher = jaccard.Hasher()
    whole = [h for _, _, h in jaccard.batch_shingles(pa.array(texts), 5, hasher)]
    monkeypatch.setattr(jaccard, "SEGMENT", 64)
    parts = [h for _, _, h in jaccard.batch_shingles(pa.array(texts), 5, hasher)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(parts))


def test_hasher_joins_words_longer_than_a_segment(monkeypatch):
    import pyarrow as pa
    long = ["q" * 200, "q" * 128, "Q" * 127, "r" * 65]
    texts = [" ".join(["a b", *long, "c d"]), *long, f"{'s' * 63} {'t' * 64} {'u' * 65}", "v" * 64 + " " + "w" * 64 + " x"]
    hasher = jaccard.Hasher()
    whole = [h for _, _, h in jaccard.batch_words(pa.array(texts), hasher)]
    monkeypatch.setattr(jaccard, "SEGMENT", 64)
    parts = [h for _, _, h in jaccard.batch_words(pa.array(texts), hasher)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(parts))


def test_jaccard_tasks_take_small_batches(spark, monkeypatch):
    """The session's own setting is back afterwards."""
    key, seen, whole = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard._labels
    before = spark.conf.get(key)

    def labels(rows, *a):
        sizes = rows.select("text").mapInPandas(lambda batches: (b.assign(n=len(b))[["n"]] for b in batches), "n long")
        seen.append((int(spark.conf.get(key)), sizes.agg(F.max("n")).first()[0]))
        return whole(rows, *a)
    monkeypatch.setattr(jaccard, "_labels", labels)
    many = spark.range(0, 3 * jaccard.BATCH_ROWS, 1, 1).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    assert jaccard.jaccard_components(many).count() == 3 * jaccard.BATCH_ROWS
    assert seen == [(jaccard.BATCH_ROWS, jaccard.BATCH_ROWS)] and spark.conf.get(key) == before


def test_boundary_follows_cost():
    assert jaccard.boundary({8: (100, 0.0)}, 75) <= 8
    assert jaccard.boundary({8: (100, 1e9)}, 75) > 8


def test_ngram_jaccard_keeps_passages_apart_in_a_full_sketch(spark, monkeypatch):
    """Sets that share a passage only are not compared token by token where the sketch shows nothing."""
    rng, rows = random.Random(7), []
    word = lambda: "".join(rng.choices("abcdefghij", k=9))
    for group in range(40):
        passage = [word() for _ in range(10)]
        rows += [(group * 6 + i, " ".join([word() for _ in range(150)] + passage + [word() for _ in range(150)])) for i in range(6)]
    whole = [word() for _ in range(110)]
    rows += [(500 + i, " ".join(whole[:100 + i])) for i in range(6)]  # linked: stars, and pairs beyond the pivot
    staged, kept = {}, jaccard.stage
    monkeypatch.setattr(jaccard, "_order", lambda docs, k, bits: (np.full(1 << 16, 10, np.uint8), 0.0))
    monkeypatch.setattr(jaccard, "stage", lambda df, name: staged.setdefault(name, kept(df, name)))
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: 500 if d >= 500 else d for d, _ in rows}
    assert staged["clusters"].count() == 0
    assert staged["sets"].filter("length(toks) >= n * 5 / 2").count() == 0   # prefixes, not whole sets


def test_sketch_levels_follow_the_noise_of_its_counts():
    for mean in (0.0, 8.4, 134.0, 5000.0):
        counts = np.arange(0, 1 << 20)
        code = sketch.level(counts, mean).astype(int)
        assert (np.diff(code) >= 0).all() and (sketch.excess(code, mean)[code > 0] <= counts[code > 0] - mean + 1e-6).all()
        few = mean + 2 * sketch.spread(mean)
        assert sketch.level(np.array([few + mean ** 0.5]), mean)[0] > sketch.level(np.array([few]), mean)[0] or mean == 0
    assert sketch.level(np.array([1, 2]), 0.0).tolist() == [36, 40]


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_longer_prefixes_of_linked_sets_share_tokens(percent):
    rng = random.Random(percent)
    for _ in range(3000):
        n = rng.randint(1, 150)
        a = set(rng.sample(range(2 * n), n))
        b = set(rng.sample(sorted(a), n - rng.randint(0, n // 6))) | {1000 + i for i in range(rng.randint(0, n // 6))}
        if not b or 100 * len(a & b) < percent * len(a | b):
            continue
        prefix = [set(sorted(s)[:len(s) - jaccard._needed(len(s), percent) + jaccard._shared(len(s), percent)]) for s in (a, b)]
        for s in (a, b):
            assert len(prefix[0] & prefix[1]) >= jaccard._shared(jaccard._needed(len(s), percent), percent)


def test_patience_and_blocks():
    assert lines.patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert lines.patience([5, 2, 1, 3], [9, 5, 2, 3]) == [(0, 1), (1, 2), (3, 3)]
    assert lines.common_blocks([1, 2, 3], [7, 2, 3], [5, 2, 1], 3) == [1, 2]
    assert lines.common_blocks([1, 2, 3], [7, 2, 3], [5, 1, 1], 3) == []


def test_line_dedup(spark):
    a, b, c, d = (prose(12) for _ in range(4))
    rows = [(1, f"{a}\n{b}\n{c}"), (2, f"{d}\n\n{b}\n{c}\nshort"), (3, f"{a}\n{b}\n{c}"), (4, None), (5, ""), (None, f"{d}\nown"),
            (2, f"{d}\n\n{b}\n{c}\nshort")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, gone long")
    got = {(r["doc_id"], r["text"], r["n_removed"]) for r in lines.line_dedup(df).collect()}
    assert got == {(1, f"{a}\n{b}\n{c}", 0), (2, f"{d}\n\nshort", 2), (3, "", 3), (4, None, 0), (5, "", 0), (None, "own", 1)}


def test_patience_without_unique_lines(monkeypatch):
    assert lines.patience([7, 1, 8, 1, 9], [5, 1, 6]) == [(1, 1)]
    for size in (1 << 26, 8):
        monkeypatch.setattr(lines, "CELLS", size)
        for _ in range(60):
            a, b = (rng.integers(0, 4, rng.integers(1, 14)).tolist() for _ in range(2))
            table = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
            got = lines.longest_common(a, b)
            assert len(got) == table[-1, -1] and all(a[i] == b[j] for i, j in got)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_line_dedup_equals_all_pairs(spark):
    """Passages that many documents share: repeated, in other orders, and of lines too short alone."""
    vocabulary = [prose(int(n), 900) for n in rng.integers(1, 7, 12)]
    texts = [[vocabulary[i] for i in rng.integers(0, 12, rng.integers(2, 9))] + [f"own {d}"] for d in range(60)]
    first, second = prose(6, 900), prose(6, 900)
    texts += [[first, "own a", first]] + [["own b", second, first, "c"]] + [[f"own {k}", first, second] for k in "defghij"]
    want = {}
    for d, b in enumerate(texts):
        gone = set()
        for a in texts[:d]:
            gone |= set(lines.common_blocks(a, b, [len(x.split()) for x in b], lines.MIN_WORDS))
        want[d] = "\n".join(x for i, x in enumerate(b) if i not in gone)
    df = spark.createDataFrame([(d, "\n".join(x)) for d, x in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in lines.line_dedup(df).collect()} == want


def test_bpe_matches_the_library_and_decodes(docs):
    import sentencepiece
    from vintagelake.llm import pieces
    model = bpe.default_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    plain = bpe.encode(docs, model, dropout=0.0).collect()
    for r in plain:
        assert r["piece_ids"] == (None if r["text"] is None else sp.encode(r["text"]))
    for p in (0.1, 0.9):
        out = bpe.round_trip(docs, model, dropout=p)
        assert out.count() == docs.count() and out.filter("NOT lossless").count() == 0
    text = "▁ odd ▁▁ marks 😀\u0000 \n\n end "
    enc = bpe.Encoder(model, 0.3, 1)
    todo = [(c, v) for c in bpe.chunks(prose(50) + " Wörter" * 3) for v in range(3)]
    assert enc.encode_all(todo) == [enc.agenda(*t) for t in todo]
    odd = docs.sparkSession.createDataFrame([(1, text)], "doc_id long, text string")
    assert bpe.decode(bpe.encode(odd, model), model).first()["decoded"] == text


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_bpe_merges_frequent_chunks_by_themselves_only_where_one_is_skipped(monkeypatch, dropout):
    """The pieces are those of the agenda, for frequent, rare, long and odd chunks, and after the kept ones are forgotten."""
    enc, merged, whole = bpe.Encoder(bpe.default_model(), dropout, 7), [], bpe.Encoder._together
    monkeypatch.setattr(bpe.Encoder, "_together", lambda self, rows, *a: merged.append(len(rows)) or whole(self, rows, *a))
    text = " ".join(["of the data", "W\u00f6rter \u4e2d\u6587\u5b57 \U0001f600x", "rare%d" % 7, "x" * 97] * 3 + ["once", "\ud800", "y" * 300])
    for cache in (bpe.CACHE, 0):
        monkeypatch.setattr(bpe, "CACHE", cache)
        for n in (1, 400, 2):
            todo = [(c, int(k)) for c in bpe.chunks(text) for k in rng.integers(0, 1 << 62, n)]
            assert enc.encode_all(todo) == [enc.agenda(*t) for t in todo]
    assert enc.encode_all([]) == []
    enc = bpe.Encoder(bpe.default_model(), 0.1, 7)
    merged.clear()
    enc.encode_all([(c, int(k)) for c in bpe.chunks("of the") for k in rng.integers(0, 1 << 62, 2000)])
    assert sum(merged) < 0.7 * 4000


def test_dropout_varies_by_document_position_and_copy(spark):
    """More than four segmentations of a word, and other pieces for each copy that mixing makes."""
    model = bpe.default_model()
    word = "international"
    rows = [(i, " ".join([word] * 40)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = bpe.encode(docs, model, dropout=0.3).collect()
    ways = set()
    for r in out:
        at, part = [model.pieces[x] for x in r["piece_ids"]], []
        for p in at + ["\u2581"]:
            if p.startswith("\u2581") and part:
                ways.add(tuple(part))
                part = []
            part.append(p)
    assert len(ways) > 4
    assert len({tuple(r["piece_ids"]) for r in out}) == 20
    assert out == bpe.encode(docs, model, dropout=0.3).collect()
    twice = docs.limit(1).union(docs.limit(1)).union(docs.limit(1))
    got = corpus_pipeline.sentencepiece(spark, twice, SF).collect()
    assert len({tuple(r["piece_ids"]) for r in got}) == 3


def test_language_id(spark, docs):
    r = E.queries()["op4_language_id"](spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = r.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.9 * held.count()
    probs = np.array([[.5], [.3], [.2], [1e-7], [0]])
    seg = langid.Segmenter(["a", "b", "ab"], probs)
    assert np.exp(seg.forward(["ab", "aa"])).ravel() == pytest.approx([.5 * .3 + .2, .25])
    odd = docs.sparkSession.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "e" * 3000)], "doc_id long, text string")
    got = langid.predict(odd, ["a", "b", "ab"], ["x", "y"], np.repeat(probs, 2, 1)).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "x"] and all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in langid.predict(odd, ["a"], [], np.zeros((3, 0))).collect()] == ["und"] * 4


def test_languages_of_single_words_are_learned(spark):
    """More words than the bound: a late name whose words all occur once stays in the model."""
    from vintagelake.llm import pieces
    word = lambda letters: "".join(rng.choice(list(letters), 7))
    often = [word("abcde") for _ in range(150)]
    rows = [(i, " ".join(often * 2), "aa") for i in range(12)] + [(20 + i, " ".join(word("vwxyz") for _ in range(60)), "zz") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    vocabulary = pieces.load(pieces.default_path()).pieces
    langs, probs = langid.learn(docs, vocabulary, fit_words=100)
    assert langs == ["aa", "zz"]
    asked = spark.createDataFrame([(1, word("vwxyz") + " " + word("vwxyz")), (2, word("abcde"))], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, vocabulary, langs, probs).collect()}
    assert got == {1: "zz", 2: "aa"}
    assert langid.learn(docs.limit(0), vocabulary)[0] == []


def base_row(text):
    ws = [w.decode() for w in (text or "").encode().split()]
    seen, dup = set(), 0
    for ln in (text or "").split("\n"):
        if ln.encode().split():
            dup += ln in seen
            seen.add(ln)
    tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    hit = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    return len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_quality_rules(spark, docs):
    extra = [(20, "a b c a b c\nx y z\nx y z\n\n# | <é>"), (21, "a a a a"), (22, "a b"), (23, "a b c d a b c\na")]
    all_ = docs.filter("doc_id IS NULL OR doc_id != 9").select("doc_id", "text", "lang", "source").union(
        docs.sparkSession.createDataFrame([(*r, None, "s") for r in extra], "doc_id long, text string, lang string, source string"))
    got = outliers.quality_rules(all_).collect()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = sorted(((r["doc_id"], *base_row(r["text"])) for r in all_.collect()), key=str)
    assert sorted(((r["doc_id"], *(r[c] for c in cols)) for r in got), key=str) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert outliers.quality_rules(docs.limit(0)).count() == 0
    full = E.queries()["op5_quality_rules"](spark, "/root/testdata/sf0.01").join(read(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    full = full.filter("NOT base_failed")
    assert full.filter("quality = 1 AND kept").count() >= 0.98 * full.filter("quality = 1").count()
    assert full.filter("quality = 0 AND NOT kept").count() >= 0.8 * full.filter("quality = 0").count()


def test_quality_classifier(spark, docs):
    sf = "/root/testdata/sf0.01"
    r = E.queries()["op6_quality_classifier"](spark, sf).join(read(spark, sf, "labels"), "doc_id").filter("held_out")
    assert r.filter("quality = 1 AND predicted = 1").count() >= 0.95 * r.filter("quality = 1").count()
    assert r.filter("quality = 0 AND predicted = 0").count() >= 0.7 * r.filter("quality = 0").count()
    odd = zclass.quality_query(docs, read(spark, sf, "labels"))
    assert odd.count() == docs.count() and odd.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    none = zclass.quality_query(docs, read(spark, sf, "labels").limit(0))
    assert {x["score"] for x in none.collect()} == {0.5}


def test_dictionaries_hold_all_of_the_sample(spark):
    """Text behind a long opening, and documents of every id, when the sample exceeds the budget."""
    opening = prose(900, 3000)
    rows = [(i, f"{opening} doc{i}good {prose(60, 3000)}" if i % 2 else f"{opening} {prose(60, 3000)} junk{i} " + "spam! " * 20)
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    model = zclass.fit(docs, labels, dict_docs=200, dict_bytes=64 << 10, fit_docs=80)
    assert 32 << 10 < len(model["bad"]) <= 64 << 10 and model["bad"].count(b"spam!") > 50
    import re
    ids = [int(x) for x in re.findall(rb"doc([0-9]+)good", model["good"])]
    assert min(ids) < 200 and max(ids) >= 400


def test_mixing(spark, docs):
    res = compare(spark_rows(E.queries()["op7_mixing"](spark, SF)), duck_rows(duck_connect(SF), E.oracle_sql()["op7_mixing"]))
    assert res["ok"], res
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r["taken"] <= 2 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    out = mixing.repeat_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_nearest_neighbours(spark):
    x = rng.normal(size=(700, 8)).astype("float32")
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (1000, [1.0, 2.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vptree.search(df, F.col("vec_id") % 100 == 0, factor=1.0, shard_rows=256, block_rows=3).collect()
    assert len(got) == 70 and {r["query_id"] for r in got} == set(range(0, 700, 100))
    for q in range(0, 700, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(d)), d))[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == want.tolist()
        assert [m[2] for m in mine] == pytest.approx(d[want].tolist())


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    e = read(spark, sf, "embeddings").toPandas()
    x, ids = np.array(e["embedding"].tolist(), float), e["vec_id"].to_numpy()
    got = E.queries()["op8_nearest_neighbours"](spark, sf).toPandas()
    hits = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, d))[:10]]) & set(g["vec_id"]))
    assert hits >= 0.9 * len(got)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- x --><div class="ad">Buy this now, it is a long advert text</div>
<article><h1>Heading &amp; more</h1><p><b>First  paragraph&nbsp;is here, with
 enough text.<br><p>Second one, &lt;quoted&gt; and long enough to count as text.</p><p>Ok.</p>
<aside>Side bar text that does not belong</aside><p>Last paragraph after the side bar.</p>
<div class="comments"><p>Reader says something long here, very long indeed.</p></div></article>
<form><input name="q">Search all of it</form><footer>&copy; nobody in particular, all rights reserved</footer>"""


def test_html(spark):
    assert html.main_text(PAGE) == ("Heading & more\nFirst paragraph is here, with enough text.\n"
                                    "Second one, <quoted> and long enough to count as text.\nOk.\n"
                                    "Last paragraph after the side bar.")
    assert [html.main_text(x) for x in (None, "", "<p></p>", "just text", "a < b")] == ["", "", "", "just text", "a < b"]
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 3 and all(r["n_chars"] == len(r["text"]) for r in got)


def test_html_surge_and_dive():
    first, second, last = (f"{w} paragraph, long enough to surge on its own here." for w in ("First", "Second", "Last"))
    links = "".join(f"<div>Link {i}</div>" for i in range(6))
    apart = "<div></div><div></div>"
    # short divs before the surge and after a dive are no text
    assert html.main_text(f"<div>{links}{apart}<p>{first}</p>{apart}{links}</div>") == first
    assert html.main_text(f"<article>{links}{apart}<p>{first}</p>{apart}{links}</article>") == first
    assert html.main_text(f"<article>{links}<h1>Title</h1><p>By me</p><p>Now</p><p>{first}</p></article>") == f"Title\nBy me\nNow\n{first}"
    # a stripped list is no distance, and a later part of the article stays whatever its share
    items = "<ul class='sidebar'>" + "<li>item</li>" * 40 + "</ul>"
    long = f"<p>{second * 30}</p>"
    assert html.main_text(f"<article>{long}{items}<p>Ok.</p></article>") == f"{second * 30}\nOk."
    assert html.main_text(f"<article>{long}{apart * 20}<p>{last}</p></article>") == f"{second * 30}\n{last}"
    # a word that may be a topic strips nothing alone
    for mark in ("section id='legal'", "div class='discussion'", "section id='related-work'", "section id='cookies'"):
        assert html.main_text(f"<article><p>{first}</p><{mark}><p>{last}</p></{mark.split()[0]}></article>") == f"{first}\n{last}"
    assert html.main_text(f"<article><p>{first}</p><div class='search-form'><p>{last}</p></div></article>") == first


def test_warc(spark):
    rows = [(3, "http://a/\r\nx", "same é"), (2, None, "same é"), (2, "u", "same é"), (7, "u", None), (8, "u", ""),
            (9, "u", "big é " * 5000), (None, "u", "big é " * 5000), (None, None, "lone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.archive_query(pages, chunk=1000).collect()), key=str)
    want = []
    for (p, _, h), (kind, to) in zip(rows, [("revisit", 2), ("response", None), ("revisit", 2), ("response", None), ("revisit", 7),
                                           ("response", None), ("revisit", 9), ("response", None)]):
        raw = (h or "").encode()
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, to))
    assert got == sorted(want, key=str)
    assert warc.archive_query(pages.limit(0)).count() == 0


def test_warc_chunks_carry_running_digests(spark, tmp_path):
    text = "abc é" * 3000
    pages = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.plan_chunks(pages, chunk=500), str(tmp_path))
    rows = sorted(warc.read_archives(manifest, chunk=700).collect(), key=lambda r: r["chunk_no"])
    assert b"".join(bytes(r["chunk"]) for r in rows).decode() == text and max(len(r["chunk"]) for r in rows) <= 700
    done = b""
    for r in rows:
        done += bytes(r["chunk"])
        assert r["bytes"] == len(done) and r["digest"] == base64.b32encode(hashlib.sha1(done).digest()).decode()
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(open(manifest.first()["archive"], "rb").read()[:60]), True))


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_pieces", "piece_ids"] and out.count() > 0
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns, name
        assert step(spark, docs.limit(0), SF).count() == 0, name


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    """The five stages in plain Python; labels of one kind let every document pass the first."""
    lines_ = [prose(int(n), 900) for n in rng.integers(3, 30, 30)]
    rows = [(d, "\n".join([lines_[i] for i in rng.integers(0, 30, 3)] + [prose(int(rng.integers(10, 60)), 900)])) for d in range(40)]
    base = prose(70, 900)
    rows += [(50, rows[5][1]), (51, base), (52, base.replace(" ", "  ") + " t1 t2")]
    docs = spark.createDataFrame([(*r, "en", "a", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1) for d, _ in rows], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    left = []
    for k, (d, text) in enumerate(rows):
        b, gone = text.split("\n"), set()
        for _, a in rows[:k]:
            gone |= set(lines.common_blocks(a.split("\n"), b, [len(x.split()) for x in b], lines.MIN_WORDS))
        text = "\n".join(x for i, x in enumerate(b) if i not in gone)
        if not gone or text.split():
            left.append((d, text))
    firsts = {d for d, n, low in brute_components(left) if d == low or not n}
    kept = sorted(((d, t) for d, t in left if d in firsts), key=lambda r: (-len(r[1].split()), r[0]))
    assert len(kept) < len(left) < len(rows)
    # one source: 1.5 times its size, rounded along the ranks
    model = bpe.default_model()
    enc, want = bpe.Encoder(model, bpe.DROPOUT, bpe.SEED), []
    for rank, (d, t) in enumerate(kept):
        for copy in range(1, 2 + int((rank + 1) * 0.5 + 0.5) - int(rank * 0.5 + 0.5)):
            cs = bpe.chunks(t)
            want.append((d, np.frombuffer(b"".join(map(enc.agenda, cs, enc.keys(d, copy, t, len(cs)))), "<u2").tolist()))
    got = sorted((r["doc_id"], r["piece_ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted(want)


def test_pipeline_fails_on_lossy_pieces(spark, docs, monkeypatch):
    whole = bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda *a, **b: whole(*a, **b).withColumn("piece_ids", F.slice("piece_ids", 1, 3)))
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.sentencepiece(spark, docs.select("doc_id", "text"), SF).collect()
