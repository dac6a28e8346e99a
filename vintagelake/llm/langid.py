"""Language identification with segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary are the units.  Each language has a
probability for every piece; a word's probability is the sum, by a forward
algorithm, over all its segmentations into pieces, and a text's is the product
over its words ([^\\x20\\x09-\\x0D]+, each marked with a leading space piece).
The language with the largest probability is predicted; the score is its
posterior under equal priors.

Piece probabilities are fitted by expectation-maximisation (forward-backward
counts) over the words of a bounded sample: about ``fit_docs`` documents of
each learned language, whole texts.  Of a language with more than ``fit_words``
distinct words there, a hash chooses about that many, each with its count.
Every language with a word in a sampled document is learned.  Learning reads
only text and a non-null lang of rows outside the held-out fold; predictions
read only text.

Characters outside the vocabulary get a small fixed probability.  Words over
``CUT`` characters are scored in cuts of that length, so that memory and
underflow stay bounded for any text.  A null text, or one without a letter, is
``und`` with score 0; so is every text when no language could be learned.
Ties go to the smaller name.  Rows are kept one to one.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm import pieces
from vintagelake.llm.common import SPACES, fold, sample_rows, stage

FIT_DOCS = 80
FIT_WORDS = 80_000
EM_STEPS = 2
CUT = 32
UNSEEN = 1e-7
CACHE = 300_000

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Segmenter:
    """Forward and backward sums over the segmentations of many words at once.

    The pieces form a trie; from every start, the words still on a path of it
    step down together.
    """

    def __init__(self, vocabulary: list[str], probs: np.ndarray):
        """``probs``: one row per piece, then one for characters outside the vocabulary and one of zeros."""
        self.probs, self.none = probs, len(vocabulary) + 1
        states, steps, letters, piece = {"": 0}, {}, {}, [self.none]
        for i, p in enumerate(vocabulary):
            for e in range(1, len(p) + 1):
                if p[:e] not in states:
                    letter = letters.setdefault(p[e - 1], len(letters) + 1)
                    steps[states[p[:e - 1]], letter] = states[p[:e]] = len(states)
                    piece.append(self.none)
            if p:
                piece[states[p]] = i
        self.piece = np.array(piece, np.int64)
        # letter 0 is any character that no piece holds
        self.letter = np.zeros(0x110000, np.int64)
        for c, x in letters.items():
            self.letter[ord(c)] = x
        self.width = len(letters) + 1
        self.first = np.zeros(self.width, np.int64)
        for (state, x), to in steps.items():
            if state == 0:
                self.first[x] = to
        known = sorted((state * self.width + x, to) for (state, x), to in steps.items())
        self.keys = np.array([k for k, _ in known] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([t for _, t in known] + [0], np.int64)

    def spans(self, words: list[str]):
        """For words of one length: (start, end, rows, piece id of each row), by start and end."""
        n, size = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        letters = self.letter[chars.T]
        for s in range(size):
            state = self.first[letters[s]]
            ids = self.piece[state]
            ids[ids == self.none] = self.none - 1
            rows = np.arange(n)
            yield s, s + 1, rows, ids
            rows = np.flatnonzero(state)
            state = state[rows]
            for e in range(s + 1, size):
                want = state * self.width + letters[e][rows]
                at = np.searchsorted(self.keys, want)
                on = self.keys[at] == want
                rows, state = rows[on], self.to[at[on]]
                if not len(rows):
                    break
                ids = self.piece[state]
                ends = ids != self.none
                if ends.any():
                    yield s, e + 1, rows[ends], ids[ends]

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (of one length) in each language."""
        alpha = np.zeros((len(words[0]) + 1, len(words), self.probs.shape[1]))
        alpha[0] = 1
        for s, e, rows, ids in self.spans(words):
            alpha[e][rows] += alpha[s][rows] * self.probs[ids]
        return np.log(alpha[-1])

    def expected(self, words: list[str], weight: np.ndarray, out: np.ndarray) -> None:
        """Add the expected piece counts of words (of one length) that occur ``weight`` times."""
        size, spans = len(words[0]), list(self.spans(words))
        alpha = np.zeros((size + 1, *weight.shape))
        beta = np.zeros_like(alpha)
        alpha[0] = beta[-1] = 1
        for s, e, rows, ids in spans:
            alpha[e][rows] += alpha[s][rows] * self.probs[ids]
        for s, e, rows, ids in sorted(spans, key=lambda x: -x[0]):
            beta[s][rows] += beta[e][rows] * self.probs[ids]
        scale = weight / alpha[-1]
        for s, e, rows, ids in spans:
            np.add.at(out, ids, alpha[s][rows] * self.probs[ids] * beta[e][rows] * scale[rows])


def cuts(word: str) -> list[str]:
    """The word with its space mark, in parts of at most CUT characters."""
    w = pieces.SPACE + word
    return [w] if len(w) <= CUT else [w[i:i + CUT] for i in range(0, len(w), CUT)]


def _by_length(words) -> dict[int, list]:
    out: dict[int, list] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def fit_pieces(rows: list[tuple[str, str, int]], vocabulary: list[str], langs: list[str], steps: int = EM_STEPS):
    """Piece probabilities of ``langs`` from (language, word, count) rows."""
    at = {x: i for i, x in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    for lang, word, n in rows:
        for part in cuts(word):
            counts.setdefault(part, np.zeros(len(langs)))[at[lang]] += n
    used = np.array([bool(p) for p in vocabulary])
    probs = np.zeros((len(vocabulary) + 2, len(langs)))
    probs[:-2][used] = 1 / used.sum()
    probs[-2] = UNSEEN
    groups = _by_length(counts)
    for _ in range(steps):
        seg, total = Segmenter(vocabulary, probs), np.zeros_like(probs)
        for size in sorted(groups):
            for i in range(0, len(groups[size]), 4096):
                part = groups[size][i:i + 4096]
                seg.expected(part, np.stack([counts[w] for w in part]), total)
        total[:-2][used] += 0.05
        total[-2:] = 0
        probs = total / total.sum(0)
        probs[-2] = UNSEEN
        probs[-1] = 0
    return probs


def learn(docs: DataFrame, vocabulary: list[str], fit_docs: int = FIT_DOCS, fit_words: int = FIT_WORDS):
    """Fit on rows outside the held-out fold (crc32 of the id mod 4 is 2)."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    rows = sample_rows(rows.select("doc_id", "lang", "text"), "lang", fit_docs, "language")
    words = stage(rows.select("lang", F.explode(F.split("text", SPACES)).alias("w")).filter("w != ''")
                  .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")), "words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    got = [(r["lang"], r["w"], r["n"]) for r in sample_rows(words, "lang", fit_words, "word", "w").collect()]
    return langs, fit_pieces(sorted(got, key=lambda r: (-r[2], r[0], r[1])), vocabulary, langs)


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in text)


def predict(docs: DataFrame, vocabulary: list[str], langs: list[str], probs: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) for the rows of ``docs`` (doc_id, text)."""
    def run(batches):
        seg, k = Segmenter(vocabulary, probs), len(langs)
        seen: dict[str, int] = {}
        table = np.zeros((CACHE, k))

        def score(texts):
            nonlocal seen, table
            lists = [_WORDS.findall(t) for t in texts]
            new = {w for ws in lists for w in ws}.difference(seen)
            if len(seen) + len(new) > CACHE:
                seen, new = {}, {w for ws in lists for w in ws}
                if len(new) > len(table):
                    table = np.zeros((len(new), k))
            parts = {w: cuts(w) for w in new}
            got: dict[str, np.ndarray] = {}
            for size, ws in _by_length({p for ps in parts.values() for p in ps}).items():
                for i in range(0, len(ws), 8192):
                    got.update(zip(ws[i:i + 8192], seg.forward(ws[i:i + 8192])))
            for w, ps in parts.items():
                seen[w] = len(seen)
                table[seen[w]] = got[ps[0]] if len(ps) == 1 else sum(got[p] for p in ps)
            for ws in lists:
                yield table[np.fromiter(map(seen.__getitem__, ws), np.int64, len(ws))].sum(0) if ws else np.zeros(k)

        for b in batches:
            texts = b.column(1).to_pylist()
            pred, conf = ["und"] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if t and k and has_letter(t)]
            while todo:
                now, chars = [], 0
                while todo and (not now or chars + len(texts[todo[-1]]) < 1_000_000):
                    now.append(todo.pop())
                    chars += len(texts[now[-1]])
                for i, logp in zip(now, score([texts[i] for i in now])):
                    best = int(np.argmax(logp))
                    pred[i], conf[i] = langs[best], float(1 / np.exp(np.maximum(logp - logp[best], -700)).sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred), pa.array(conf)],
                                             ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def language_query(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``."""
    vocabulary = pieces.load(path or pieces.default_path()).pieces
    langs, probs = learn(docs, vocabulary, **options)
    return predict(docs, vocabulary, langs, probs).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
