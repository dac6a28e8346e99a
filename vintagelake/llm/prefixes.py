"""Exact token counts at every prefix of a text, by prefix dynamic programming.

For each text a row of the table holds ``deltas``: the change of the token count
that each code point brings, so their running sum is the exact number of tokens
of every prefix (cut between code points), as the tokenizer's own library counts
that prefix.  Truncation and budget questions (``count_at``, ``longest_within``,
``truncate``) read the table and never encode again.

Dynamic programme: the encoding of a prefix of a chunk ends in one token ``t``,
and what stands before ``t`` is the encoding of a shorter prefix.  So the last
token and the count of each prefix follow from those of shorter ones: of the
tokens that end there, the one that may follow the last token before it.  Two
tokens may stand side by side when no merge across their seam would have come
before the merges that built them up (``Model.may_follow``).  The work is linear
in the chunk's length times the longest token.

Chunks are those of byte-level BPE (contractions, letters, digits, others, white
space).  A prefix is cut into chunks as a text of its own, which differs from the
whole text's chunks in three places, all handled: a run of white space at the
end is one chunk until another character follows; ``'r``, ``'v`` and ``'l`` are
two chunks until the contraction is whole; and a special string is ordinary text
until its last character.  The classes of characters are asked of the library.

Null text: no deltas and 0 tokens; empty text: the same.  Very long texts and
chunks take memory in proportion to one text.  Repeated rows stay; an empty
table gives an empty one; columns of ``docs`` named like the new ones are replaced.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

# distinct units (twice as many, with the older ones) and token pairs remembered in a task
UNITS, PAIRS = 200_000, 1_000_000
KEEP_CHARS = 64        # longer units are worked out anew each time
PROBE = 2_000
TOPS = (0xFF, 0xFFFF, 0x10FFFF)  # narrow texts are scanned by small patterns
SHORT_CONTRACTIONS, LONG_CONTRACTIONS = "stmd", ("re", "ve", "ll")
NEVER = 1 << 60


class Vocabulary(NamedTuple):
    tokens: list[bytes]                 # by id
    merges: list[tuple[int, int, int]]  # left id, right id, merged id; best first
    specials: list[str]
    classes: list[tuple[str, str, str]]  # letters, digits, white space, as ranges of a pattern; for each width


def byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranges(points: list[int], top: int) -> str:
    """Sorted code points up to ``top`` as the inside of a pattern's character class."""
    out, at, points = [], 0, [p for p in points if p <= top]
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\U{points[at]:08x}-\\U{points[end]:08x}")
        at = end + 1
    return "".join(out)


def probe_classes(pre_tokenizer) -> list[tuple[str, str, str]]:
    """Letters, digits and white space as the library sees them, in texts of each width of ``TOPS``.

    A character between two of a known class starts no chunk if it is of their class.
    """
    left, found = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000], []
    for probe in ("!", "a", "1"):
        inside = set()
        for at in range(0, len(left), PROBE):
            part = left[at:at + PROBE]
            starts = {i for _, (i, _) in pre_tokenizer.pre_tokenize_str(probe + probe.join(map(chr, part)) + probe)}
            inside.update(c for i, c in enumerate(part) if 2 * i + 1 not in starts)
        found.append(sorted(inside))
        left = [c for c in left if c not in inside]
    return [(ranges(found[1], top), ranges(found[2], top), ranges(left, top)) for top in TOPS]


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file on the driver; refuses files the method does not fit."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v}
    added = spec["added_tokens"]
    if (model["type"] != "BPE" or plain or spec["normalizer"] or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
        raise ValueError("not a plain byte-level BPE file")
    of_char = byte_of_char()
    specials = [t["content"] for t in added]
    ids = {bytes(of_char[c] for c in word): i for word, i in model["vocab"].items() if word not in set(specials)}
    tokens = [b""] * (max(ids.values()) + 1)
    for word, i in ids.items():
        tokens[i] = word
    merges, known = [], {i for w, i in ids.items() if len(w) == 1}
    for pair in model["merges"]:
        a, b = (ids[bytes(of_char[c] for c in w)] for w in (pair if isinstance(pair, list) else pair.split(" ")))
        merged = ids[tokens[a] + tokens[b]]
        if a not in known or b not in known or merged in known:
            raise ValueError("a merge uses a later token, or two merges make one token")
        known.add(merged)
        merges.append((a, b, merged))
    return Vocabulary(tokens, merges, specials, probe_classes(Tokenizer.from_file(path).pre_tokenizer))


class Model:
    """The dynamic programme over one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.tokens, self.size = v.tokens, len(v.tokens)
        self.rank = {a * self.size + b: r for r, (a, b, _) in enumerate(v.merges)}
        self.halves = {m: (a, b, r) for r, (a, b, m) in enumerate(v.merges)}
        self.edges: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.ids: dict[bytes, int] = {}
        for i, word in enumerate(v.tokens):
            if len(word) == 1:
                self.ids[word] = i
        reached = set(self.ids.values())
        for a, b, m in v.merges:  # a token that its own bytes do not encode to never occurs
            if a in reached and b in reached and self.seam_holds(a, b, whole=False):
                reached.add(m)
                self.ids[v.tokens[m]] = m
        self.longest = max(map(len, self.ids))
        self.tails = {word[at:] for word in self.ids for at in range(len(word))}
        short = f"'(?:[{SHORT_CONTRACTIONS}]|{'|'.join(LONG_CONTRACTIONS)})"
        self.scans = [re.compile(f"[{white}]*(?:[{letters}]+|(?<! ){short}|[^{letters}{digits}{white}]+|[{digits}]+)|[{white}]+")
                      for letters, digits, white in v.classes]
        self.white = re.compile(f"[{v.classes[-1][2]}]*")
        self.special = re.compile("|".join(map(re.escape, sorted(v.specials, key=len, reverse=True)))) if v.specials else None
        self.units: dict[str, bytes] = {}
        self.old_units: dict[str, bytes] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one end of ``token`` while it is built, each with the rank of the merge that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            found, at, ends = [], token, NEVER
            while True:
                found.append((at, ends))
                if at not in self.halves:
                    break
                a, b, ends = self.halves[at]
                at = b if side else a
            self.edges[side][token] = found
        return found

    def seam_holds(self, a: int, b: int, whole: bool = True) -> bool:
        """No merge across the seam comes before the merges that build ``a`` and ``b``.

        Equal merges are done from the left: one that ends the left part's token
        comes before the seam's, one that ends the right part's comes after it.
        With ``whole`` false, the merge of ``a`` and ``b`` themselves is allowed.
        """
        for x, x_ends in self.edge(a, 1):
            for y, y_ends in self.edge(b, 0):
                r = self.rank.get(x * self.size + y)
                if r is not None and r < x_ends and r <= y_ends and (whole or x != a or y != b):
                    return False
        return True

    def may_follow(self, a: int, b: int) -> bool:
        key = a * self.size + b
        if (ok := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            ok = self.pairs[key] = self.seam_holds(a, b)
        return ok

    def prefix_tokens(self, chunk: bytes) -> list[int]:
        """Token counts of the byte prefixes of a chunk, from the empty one on."""
        ids, tails = self.ids, self.tails
        counts, last = [0], [-1]
        for end in range(1, len(chunk) + 1):
            if end <= self.longest and (t := ids.get(chunk[:end])) is not None:
                counts.append(1)
                last.append(t)
                continue
            start = end - 1
            while (word := chunk[start:end]) in tails:
                t = ids.get(word)
                if t is not None and start and self.may_follow(last[start], t):
                    counts.append(counts[start] + 1)
                    last.append(t)
                    break
                start -= 1
                if start < 0:
                    raise AssertionError("no token ends here")
            else:
                raise AssertionError("no token ends here")
        return counts

    def chars(self, chunk: str) -> list[int]:
        """Token counts of a chunk's prefixes of 1, 2, ... code points."""
        data = chunk.encode("utf-8")
        counts = self.prefix_tokens(data)
        if len(data) == len(chunk):
            return counts[1:]
        ends = [i for i in range(1, len(data)) if data[i] & 0xC0 != 0x80]
        return [counts[i] for i in ends] + counts[-1:]

    def unit_deltas(self, unit: str) -> bytes:
        """Deltas of white space with the chunk behind it; whatever stands before it is settled."""
        n = self.white.match(unit).end()
        run, body = unit[:n], unit[n:]
        counts = self.chars(run) if run else []
        if body:
            before = counts[n - 2] if n > 1 else 0  # the run but its last character is a chunk of its own
            if run and run[-1] != " ":
                before += self.chars(run[-1])[-1]
            if body[0] == "'" and body[1:] in LONG_CONTRACTIONS and run[-1:] != " ":
                quote = self.chars("'")[-1]
                inner = [quote, quote + self.chars(body[1])[-1], self.chars(body)[-1]]
            else:
                inner = self.chars(" " + body)[1:] if run[-1:] == " " else self.chars(body)
            counts = counts + [before + c for c in inner]
        return array("h", [b - a for a, b in zip([0, *counts], counts)]).tobytes()

    def split(self, text: str) -> list[str]:
        """The units of a text: white space with the chunk behind it."""
        try:
            text.encode("latin-1")
            width = 0
        except UnicodeEncodeError:
            width = 1 if len(text.encode("utf-16-le")) == 2 * len(text) else 2
        return self.scans[width].findall(text)

    def plain(self, text: str) -> bytes:
        """Deltas of a text without special strings."""
        out, units = [], self.units
        for unit in self.split(text):
            d = units.get(unit)
            if d is None:
                d = self.old_units.get(unit) or self.unit_deltas(unit)
                if len(unit) <= KEEP_CHARS:
                    if len(units) >= UNITS:  # those in use come back from the old ones
                        self.old_units, self.units = units, {}
                        units = self.units
                    units[unit] = d
            out.append(d)
        return b"".join(out)

    def deltas(self, text: str) -> bytes:
        """Deltas of every code point, as 16-bit integers."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            # up to its last character the special string is ordinary text
            d = array("h")
            d.frombytes(self.plain(text[at:m.end() - 1]))
            inside = sum(d[m.start() - at:])
            out += [d.tobytes(), array("h", [1 - inside]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])


def table(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens (of the whole text) and deltas (binary, 16 bits for each code point)."""
    base = docs.drop("n_tokens", "deltas")
    schema = StructType([*base.schema.fields, StructField("n_tokens", LongType()), StructField("deltas", BinaryType())])
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary))  # fixed size: the vocabulary

    def run(batches):
        model = None
        for batch in batches:
            model = model or Model(Vocabulary(*shared.value))
            found = [model.deltas(t.as_py() or "") for t in batch.column(text)]
            totals = [int(np.frombuffer(d, np.int16).sum(dtype=np.int64)) for d in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(totals, pa.int64()), pa.array(found, pa.binary())],
                names=[*batch.schema.names, "n_tokens", "deltas"])

    return base.mapInArrow(run, schema)


def count_at(deltas: Column, n_chars: Column) -> Column:
    """Tokens of the prefix of ``n_chars`` code points (of the whole text, if it is shorter)."""
    @F.pandas_udf(LongType())
    def at(d, n):
        import pandas as pd
        return pd.Series([None if k is None or k != k else
                          int(np.frombuffer(x or b"", np.int16)[:max(0, int(k))].sum(dtype=np.int64))
                          for x, k in zip(d, n)], dtype="Int64")
    return at(deltas, n_chars.cast("long"))


def longest_within(deltas: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens (0 if even the empty one has more)."""
    @F.pandas_udf(IntegerType())
    def fit(d, n):
        import pandas as pd
        out = []
        for x, k in zip(d, n):
            if k is None or k != k:
                out.append(None)
                continue
            # counts may fall as a prefix grows, so the last one that fits counts
            fits = np.flatnonzero(np.cumsum(np.frombuffer(x or b"", np.int16), dtype=np.int64) <= int(k))
            out.append(int(fits[-1]) + 1 if len(fits) and k >= 0 else 0)
        return pd.Series(out, dtype="Int32")
    return fit(deltas, budget.cast("long"))


def truncate(counted: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """The rows of ``table`` with the text cut to its longest prefix of at most ``budget`` tokens."""
    return counted.withColumn(text, F.substring(F.col(text), F.lit(1), longest_within(F.col("deltas"), F.lit(budget))))


def token_counts(docs: DataFrame, vocabulary: Vocabulary, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, read from the table of prefixes."""
    counted = table(docs.select("doc_id", "text"), vocabulary)
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
