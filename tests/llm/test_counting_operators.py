"""Source divergence, phrase collocations and token counts: brute force, SQL and the tokenizer's own library."""

import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare, duck_connect, duck_rows, spark_rows
from vintagelake.llm import divergence, phrases, prefixes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, rank long, deltas string, n_tokens long"


def table(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns named like the operators' own."""
    return spark.createDataFrame([(*r, 0, "x", 7, "y", 3) for r in rows], SCHEMA)


def words(draw, n, kinds):
    return " ".join(f"w{min(int(draw.expovariate(0.2)), kinds)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls in every column, empty and blank texts, repeated rows, a hot source, control and non-ASCII characters, a long text."""
    draw = random.Random(4)
    out = [(i, words(draw, draw.randint(1, 60), 30), "en" if i % 4 else "de", "hot" if i % 3 else f"s{i % 5}") for i in range(90)]
    out += [(1000, None, "en", "s1"), (1001, "", "en", "empty"), (1002, " \n\t ", None, None), (None, None, None, None),
            (1003, "ÄPFEL Äpfel äpfel DON'T don’t x\x00y a\x01b 日本 日本", "fr", "s1"), (1004, "only here", "it", "s1"),
            (1005, "w1 w2 w3. w1 w2 w3! W1 W2 W3\tw4\rw5", None, "s2"), (1006, words(draw, 5000, 40), "en", None)]
    return out + out[:20] + [out[-1]] * 3


# source divergence

def terms_of(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalpha():
            if run:
                out.append(run)
            run = ""
        else:
            run += c.lower() if c.isascii() else c
    return out


def brute_audit(rows, min_docs=3, top=200):
    docs, groups, lang_n, group_n = Counter(), set(), Counter(), Counter()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        t = terms_of(text)
        docs.update((lang, x) for x in set(t))
        lang_n.update((lang, x) for x in t)
        group_n.update((lang, source, x) for x in t)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        def shares(count):
            total = sum(count(t) for t in kept)
            return {t: 1 + 10**9 * (count(t) + 1) // (total + len(kept)) for t in kept}
        q, p = shares(lambda t: lang_n[lang, t]), {s: shares(lambda t: group_n[lang, s, t]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            best = [(-f(p[s][t], q[t]), t) for t in kept if group_n[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", best)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


@pytest.mark.parametrize("top", [200, 3])
def test_audit_equals_brute_force(spark, rows, top, monkeypatch):
    monkeypatch.setattr(divergence, "BUFFER", 20)
    monkeypatch.setattr(divergence, "PAIR_ROWS", 50)
    monkeypatch.setattr(divergence, "ENTRIES", 40)
    got = divergence.audit(table(spark, rows).repartition(5), top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, top=top)


def test_audit_of_empty_table(spark):
    assert divergence.audit(table(spark, [])).collect() == []


def test_skyband_keeps_what_fewer_than_k_dominate():
    draw = np.random.default_rng(2)
    for k, n in product((1, 3, 20), (1, 50, 700)):
        count, low = draw.integers(1, 8, n), draw.integers(1, 8, n)
        term = np.array([f"t{i:04d}".encode() for i in draw.permutation(n)], object)
        want = [i for i in range(n) if sum((count[j] >= count[i]) and (low[j] <= low[i]) and term[j] < term[i] for j in range(n)) < k]
        assert sorted(divergence.skyband(count, low, term, k).tolist()) == want


# phrases

def brute_phrases(rows, min_count, top, longest=5):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for sep in ".,;:!?\v\f\r":
            low = low.replace(sep, "\n")
        for piece in low.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            total[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, l, r = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("min_count,top", [(4, 2000), (2, 7), (300, 5)])
def test_phrases_equal_brute_force(spark, rows, min_count, top, monkeypatch):
    extra = [(2000 + i, "a\x01 b\x1f c a\x01 b\x1f c; \x7f d \x7f d, a a a a a a a", "en", "x") for i in range(5)]
    monkeypatch.setattr(phrases, "SLICE", 200)
    monkeypatch.setattr(phrases, "EDGES", 50)
    monkeypatch.setattr(phrases, "PAIRS", 100)
    got = phrases.collocations(table(spark, rows + extra).repartition(4), min_count, top)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows + extra, min_count, top)


def test_flows_sum_over_partitions(spark):
    """A node whose edges lie in several partitions."""
    grams = [("en", f"a b{i % 7} c{i}".encode(), 2) for i in range(400)] + [("de", b"a", 3)]
    edges = spark.createDataFrame(grams, "lang string, gram binary, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["lang"], r["phrase"]): r["a"] for r in phrases.flows(edges, 50).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = Counter()
    for lang, gram, n in grams:
        w = gram.decode().split()
        want.update({(lang, " ".join(w[:k])): n for k in range(1, len(w) + 1)})
    assert got == {k: n for k, n in want.items() if n >= 50}


def test_phrases_of_empty_table(spark):
    assert phrases.collocations(table(spark, [])).collect() == []


# token counts

ODD = ["a", "b", "the", "'", "'s", "'re", "r", "l", "ll", " ", "  ", "\n", "\t", "é", "ñ", "1", "23", "!", "<|", "<|endoftext|>", "|>",
       "endoftext", "　", "日本", "🙂", "xxxxxxxxx", "==", "-", "\x00", "՘", "'v", "ve", "\xa0"]


@pytest.fixture(scope="module")
def vocabulary():
    return prefixes.load(prefixes.default_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(prefixes.default_path())


def test_every_prefix_counts_as_the_library_says(vocabulary, library):
    model, draw = prefixes.Model(vocabulary), random.Random(1)
    for _ in range(1500):
        s = "".join(draw.choice(ODD) for _ in range(draw.randint(1, 14)))
        want = [len(e.ids) for e in library.encode_batch([s[:i] for i in range(1, len(s) + 1)], add_special_tokens=False)]
        assert np.cumsum(np.frombuffer(model.deltas(s), np.int16)).tolist() == want, s


def test_long_chunks_take_linear_time(vocabulary, library):
    model = prefixes.Model(vocabulary)
    for s in ("x" * 100_000, "日本語" * 30_000, " " * 100_000, "=-" * 50_000):
        assert np.frombuffer(model.deltas(s), np.int16).sum(dtype=np.int64) == len(library.encode(s, add_special_tokens=False).ids)


def test_budget_questions_read_the_table(spark, vocabulary, library):
    texts = [None, "", "Hello world, it's 'rest' time.  \n\n ok <|endoftext|> end", "日本 " * 50, "word " * 300]
    docs = table(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    counted = prefixes.table(docs, vocabulary)
    asked = counted.select("doc_id", "text", "n_tokens", prefixes.count_at(F.col("deltas"), F.lit(9)).alias("at_9"),
                           prefixes.longest_within(F.col("deltas"), F.lit(12)).alias("fits"))
    cut = {r["doc_id"]: r["text"] for r in prefixes.truncate(counted, 12).collect()}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in asked.collect():
        t = r["text"] or ""
        assert r["n_tokens"] == count(t) and r["at_9"] == count(t[:9])
        assert r["fits"] == max(i for i in range(len(t) + 1) if count(t[:i]) <= 12)
        assert (cut[r["doc_id"]] or "") == t[:r["fits"]]


def test_token_counts_of_whole_table_and_empty_table(spark, library, vocabulary):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r["doc_id"], len(t.encode()), n, n > 512) for r, t, n in (
        (r, r["text"] or "", len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()))
    assert sorted(tuple(r) for r in E.queries()["op13_token_counts"](spark, SF).collect()) == want
    assert prefixes.token_counts(table(spark, []), vocabulary, 512).collect() == []


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_phrase_collocations"])
def test_sql_oracle(spark, name):
    res = compare(spark_rows(E.queries()[name](spark, SF)), duck_rows(duck_connect(SF), E.oracle_sql()[name]))
    assert res["ok"], res
