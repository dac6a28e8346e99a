"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Merge-type segmentation: an agenda of candidate merges, best piece first and
leftmost among equals, as in a SentencePiece BPE model; with ``dropout`` 0 the
pieces are the model's own.  Each candidate (its place, its merged piece) is
skipped when a keyed hash of it falls below ``dropout``; the key holds the
seed, doc_id, copy number, text and the chunk's position.  Chunks are a run of
spaces with the characters up to the next space or newline (no piece crosses
one; checked when the model is read).  So every occurrence of a chunk is drawn
anew, also in another copy of its document.  A task works out frequent chunks
without skips once and keeps the merges made: an occurrence that skips none of
them makes the same ones, as a skipped candidate that is never the best changes
nothing.  Any other, and every rare chunk, is merged by itself.  Reruns agree, and rows equal in doc_id, text and copy number get the same pieces.

Characters outside the vocabulary, and the space mark itself where the text
holds it, become byte pieces: decoding returns the exact text.  A null text
gives null pieces, an empty one no pieces.  Rows are kept one to one.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.pieces import SPACE, default_path, load

DROPOUT, SEED = 0.1, 20
# chunks longer than this are merged one by one with a heap
WIDE = 96
# characters of the chunks that a task keeps, and of the texts it encodes at once
CACHE = 500_000
ROUND = 500_000
BLOCK = 8192
OFTEN = 3
# pieces decoded at once
DECODED = 1 << 16

_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1
_NEVER = np.iinfo(np.int32).max


class Model(NamedTuple):
    pieces: list[str]
    byte_ids: list[int]
    letters: np.ndarray    # code point -> id, -1 outside the vocabulary
    keys: np.ndarray       # left id * size + right id, sorted
    ranks: np.ndarray      # rank of the merged piece, 0 best, for each key
    by_rank: np.ndarray    # rank -> id


def default_model() -> Model:
    return build(default_path())


def build(path: str) -> Model:
    v = load(path)
    ids = {p: i for i, p in enumerate(v.pieces) if p}
    if any("\n" in p or SPACE in p.lstrip(SPACE) for p in ids) or -1 in v.byte_ids:
        raise ValueError("the vocabulary has pieces across spaces or newlines, or no byte pieces")
    by_rank = sorted(ids.values(), key=lambda i: (-v.scores[i], i))
    rank = {i: r for r, i in enumerate(by_rank)}
    size, merges = len(v.pieces), {}
    for p, i in ids.items():
        for at in range(1, len(p)):
            if (a := ids.get(p[:at])) is not None and (b := ids.get(p[at:])) is not None:
                merges[a * size + b] = rank[i]
    letters = np.full(0x110000, -1, np.int32)
    for p, i in ids.items():
        if len(p) == 1:
            letters[ord(p)] = i
    keys = np.array(sorted(merges), np.int64)
    return Model(v.pieces, v.byte_ids, letters, keys, np.array([merges[k] for k in keys.tolist()], np.int32),
                 np.array(by_rank, np.int64))


def chunks(text: str) -> list[str]:
    """The text with its leading mark, cut where no piece crosses."""
    return _CHUNKS.findall(SPACE + text.replace(" ", SPACE))


def _salt(start: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The part of a candidate's hash that its place and its merged piece give."""
    return (start.astype(np.uint64) * np.uint64(_A)) ^ (rank.astype(np.uint64) * np.uint64(_B))


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run of ``n``, one after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Encoder:
    def __init__(self, model: Model, dropout: float, seed: int):
        self.m, self.size = model, len(model.pieces)
        self.limit, self.seed = int(dropout * (1 << 64)), seed
        self.mark = np.array([model.byte_ids[x] for x in SPACE.encode()], "<u2")
        self._table()
        self._forget()

    def keys(self, doc_id: int | None, copy: int, text: str, n: int) -> np.ndarray:
        """The keys of the ``n`` chunks of a text."""
        row = xxhash.xxh3_64_intdigest(f"{doc_id} {copy}".encode(), seed=self.seed)
        row = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=row)
        h = np.uint64(row) + np.arange(n, dtype=np.uint64) * np.uint64(_A)
        for shift in (30, 27):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(_B)
        return h ^ (h >> np.uint64(31))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of candidate merges; _NEVER where there is none."""
        want = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * self.size + b, -2)
        at = self._slot(want)
        there = self.slots[at]
        out = np.where(there == want, self.values[at], _NEVER)
        more = (there != want) & (there >= 0)
        if more.any():
            want, at, found = want[more], at[more], out[more]
            left = np.arange(len(want))
            while len(left):
                at = (at + 1) & (len(self.slots) - 1)
                there = self.slots[at]
                hit = there == want
                found[left[hit]] = self.values[at[hit]]
                on = ~hit & (there >= 0)
                left, want, at = left[on], want[on], at[on]
            out[more] = found
        return out

    def _slot(self, want: np.ndarray) -> np.ndarray:
        return ((want.astype(np.uint64) * np.uint64(_A)) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _table(self) -> None:
        """The model's merges by the hash of their key; a taken slot sends a key to the next one."""
        keys, ranks = self.m.keys, self.m.ranks
        size = 1 << (2 * len(keys) + 2).bit_length()
        kind = np.int32 if self.size ** 2 <= np.iinfo(np.int32).max else np.int64
        self.slots, self.values = np.full(size, -1, kind), np.full(size, _NEVER, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[free]
            put = self.slots[at] == keys
            self.values[at[put]] = ranks[put]
            keys, ranks, at = keys[~put], ranks[~put], (at[~put] + 1) & (size - 1)

    def skipped(self, key: np.ndarray, salt: np.ndarray) -> np.ndarray:
        h = key ^ salt
        for _ in range(2):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(_B)
        return h ^ (h >> np.uint64(31)) < np.uint64(min(self.limit, _MASK))

    def merge_rank(self, a, b, start, key):
        """Ranks of candidate merges (arrays); _NEVER where there is none or it is skipped."""
        rank = self.rank(a, b)
        return np.where(self.skipped(key, _salt(start, rank)), _NEVER, rank) if self.limit else rank

    def _forget(self) -> None:
        """Keep no chunk but the empty one, which stands for a space mark that the text holds."""
        self.ids, self.texts, self.kept, self.held = {"": 0}, [""], 1, 0
        self.width, self.odd, self.own = np.zeros(1, np.int64), np.zeros(1, bool), np.zeros(1, bool)
        # of each chunk: characters and their first ranks, merges made without skips, pieces without skips
        self.sym, self.first, self.met, self.plain = (
            np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint64), self.mark)
        self.n_sym, self.n_met, self.n_plain = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([len(self.mark)])

    def learn(self, cs: list[str]) -> np.ndarray:
        """The numbers of chunks, good until the next call; new frequent ones are worked out and kept."""
        if self.held > CACHE:
            self._forget()
        k = self.kept
        self.texts = self.texts[:k]
        self.width, self.odd, self.own = self.width[:k], self.odd[:k], self.own[:k]
        self.n_sym, self.n_met, self.n_plain = self.n_sym[:k], self.n_met[:k], self.n_plain[:k]
        self.sym, self.first = self.sym[:self.n_sym.sum()], self.first[:self.n_sym.sum()]
        ids = np.fromiter(map(self.ids.get, cs, repeat(-1)), np.int64, len(cs))
        at = np.flatnonzero(ids < 0)
        new = [cs[i] for i in at.tolist()]
        often = sorted((c for c, n in Counter(new).items() if not self.limit or n >= OFTEN and len(c) <= WIDE), key=len)
        self.ids.update(zip(often, range(k, k + len(often))))
        self._add(often, False)
        self.kept, self.held = len(self.texts), self.held + sum(map(len, often))
        ids[at] = np.fromiter(map(self.ids.get, new, repeat(-1)), np.int64, len(new))
        at = np.flatnonzero(ids < 0)
        at = at[np.argsort(np.fromiter((len(cs[i]) for i in at.tolist()), np.int64, len(at)), kind="stable")]
        ids[at] = np.arange(self.kept, self.kept + len(at))
        self._add([cs[i] for i in at.tolist()], True)
        self.at_sym, self.at_met, self.at_plain = (np.cumsum(n) - n for n in (self.n_sym, self.n_met, self.n_plain))
        return ids

    def _add(self, new: list[str], own: bool) -> None:
        """Add chunks, shortest first; with ``own`` every occurrence is to be merged by itself."""
        if not new:
            return
        self.texts = self.texts + new
        width, sym, first, met, plain = np.array([len(c) for c in new]), [], [], [], []
        n_met, n_plain, odd = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), np.zeros(len(new), bool)
        hi = 0
        while hi < len(new):
            lo, size = hi, int(width[hi])
            hi = min(lo + BLOCK, int(np.searchsorted(width, size, "right")))
            if size > WIDE:
                done = [] if own else [np.frombuffer(self.agenda(c, 0), "<u2") for c in new[lo:hi]]
            else:
                cps = np.frombuffer("".join(new[lo:hi]).encode("utf-32-le", "surrogatepass"), np.uint32)
                s = self.m.letters[cps].reshape(hi - lo, size)
                r = np.full(s.shape, _NEVER, np.int32)
                r[:, :-1] = self.rank(s[:, :-1], s[:, 1:])
                odd[lo:hi] = (s < 0).any(1)
                sym.append(s.ravel()), first.append(r.ravel())
                if own:
                    continue
                seen, done = [(np.empty(0, np.int64), np.empty(0, np.uint64))], [None] * (hi - lo)
                for rows, ends, starts in self._together(s, r[:, :-1], np.zeros(hi - lo, np.uint64), seen):
                    for i, x, p in zip(rows.tolist(), ends.astype("<u2"), range(len(rows))):
                        done[i] = self._pieces(ends[p], starts[p], new[lo + i]) if odd[lo + i] else x
                owner, salts = (np.concatenate(x) for x in zip(*seen))
                met.append(salts[np.argsort(owner, kind="stable")])
                n_met[lo:hi] = np.bincount(owner, minlength=hi - lo)
            if not own:
                n_plain[lo:hi] = [len(x) for x in done]
                plain += done
        join = np.concatenate
        self.width, self.odd, self.own = join([self.width, width]), join([self.odd, odd]), join([self.own, np.full(len(new), own)])
        self.sym, self.first = join([self.sym, *sym]), join([self.first, *first])
        self.met, self.plain = join([self.met, *met]), join([self.plain, *plain])
        self.n_sym = join([self.n_sym, np.where(width > WIDE, 0, width)])
        self.n_met, self.n_plain = join([self.n_met, n_met]), join([self.n_plain, n_plain])

    def encode(self, ids: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of chunks, given by number and key, one after the other, and how many each has."""
        n, own = self.n_plain[ids], self.own[ids]
        if self.limit:
            for lo in range(0, len(ids), 4 * BLOCK):
                part = ids[lo:lo + 4 * BLOCK]
                owner = np.repeat(np.arange(lo, lo + len(part)), self.n_met[part])
                own[owner[self.skipped(key[owner], self.met[_spread(self.at_met[part], self.n_met[part])])]] = True
        found, rows = [], np.flatnonzero(own)
        width = self.width[ids[rows]]
        rows = rows[np.argsort(width, kind="stable")]
        width.sort()
        lo = 0
        while lo < len(rows):
            size = int(width[lo])
            hi = min(lo + BLOCK, int(np.searchsorted(width, size, "right")))
            part, lo = rows[lo:hi], hi
            if size > WIDE:
                found += [(np.array([i]), np.frombuffer(self.agenda(self.texts[ids[i]], key[i]), "<u2")[None, :])
                          for i in part.tolist()]
                continue
            at = self.at_sym[ids[part]][:, None] + np.arange(size)
            rank = self.first[at[:, :-1]]
            if self.limit:
                rank[self.skipped(key[part][:, None], _salt(np.arange(size - 1), rank))] = _NEVER
            for done, ends, starts in self._together(self.sym[at], rank, key[part]):
                done = part[done]
                odd = self.odd[ids[done]]
                found.append((done[~odd], ends[~odd].astype("<u2")))
                found += [(done[i:i + 1], self._pieces(ends[i], starts[i], self.texts[ids[done[i]]])[None, :])
                          for i in np.flatnonzero(odd).tolist()]
        for done, ends in found:
            n[done] = ends.shape[1]
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        rest = np.flatnonzero(~own)
        out[_spread(at[rest], n[rest])] = self.plain[_spread(self.at_plain[ids[rest]], n[rest])]
        for done, ends in found:
            out[at[done][:, None] + np.arange(ends.shape[1])] = ends
        return out, n

    def encode_all(self, todo: list[tuple[str, int]]) -> list[bytes]:
        """Piece ids (as uint16 bytes) of (chunk, key) pairs."""
        out, n = self.encode(self.learn([c for c, _ in todo]), np.array([k for _, k in todo], np.uint64))
        return [x.astype("<u2").tobytes() for x in np.split(out, np.cumsum(n)[:-1])] if todo else []

    def _together(self, sym, rank, key, seen=None):
        """The agenda for chunks of one length: every step makes the best merge of each.

        ``rank`` holds their first ranks.  Yields (rows, symbols, their places)
        of the chunks that are done.  With ``seen`` nothing is skipped, and
        (rows, salts) of the merges made are added to it.
        """
        n, size = sym.shape
        start = np.broadcast_to(np.arange(size, dtype=np.int32), (n, size))
        live = np.arange(n)
        while True:
            width = sym.shape[1]
            if width > 1:
                best = rank.argmin(1)
                value = rank[np.arange(len(live)), best]
                done = value == _NEVER
            else:
                done = np.ones(len(live), bool)
            if done.any():
                yield live[done], sym[done], start[done]
                if done.all():
                    return
                more = ~done
                sym, start, live, rank, key, best, value = (
                    x[more] for x in (sym, start, live, rank, key, best, value))
            r, k = np.arange(len(live)), len(live)
            if seen is not None:
                seen.append((live, _salt(start[r, best], value)))
            keep = np.ones(sym.shape, bool)
            keep[r, best + 1] = False
            merged = self.m.by_rank[value]
            sym, start = sym[keep].reshape(k, width - 1), start[keep].reshape(k, width - 1)
            sym[r, best] = merged
            keep = np.ones(rank.shape, bool)
            keep[r, best] = False
            rank = rank[keep].reshape(k, width - 2)
            for side in (best - 1, best):
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                s = side[ok]
                a, b, at = sym[ok, s], sym[ok, s + 1], start[ok, s]
                rank[ok, s] = self.merge_rank(a, b, at, key[ok]) if seen is None else self.rank(a, b)

    def _pieces(self, sym, start, chunk: str) -> np.ndarray:
        return np.frombuffer(self._bytes((s, chunk[p]) for s, p in zip(sym.tolist(), start.tolist())), "<u2")

    def _bytes(self, symbols) -> bytes:
        ids: list[int] = []
        for s, c in symbols:
            ids += [s] if s >= 0 else [self.m.byte_ids[x] for x in c.encode("utf-8", "surrogatepass")]
        return np.array(ids, "<u2").tobytes()

    def agenda(self, chunk: str, key: int) -> bytes:
        """The same for one chunk of any length, with a heap of (rank, place, ids)."""
        sym = [int(self.m.letters[ord(c)]) for c in chunk]
        n = len(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(places):
            places = [p for p in places if p >= 0 and after[p] < n]
            if not places:
                return
            a = np.array([sym[p] for p in places], np.int64)
            b = np.array([sym[after[p]] for p in places], np.int64)
            for p, x, y, rk in zip(places, a.tolist(), b.tolist(), self.merge_rank(
                    a, b, np.array(places, np.int64), np.uint64(key)).tolist()):
                if rk != _NEVER:
                    heapq.heappush(heap, (rk, p, x, y))
        offer(range(n - 1))
        gone = [False] * n
        while heap:
            rk, p, x, y = heapq.heappop(heap)
            if gone[p] or sym[p] != x or after[p] >= n or sym[after[p]] != y:
                continue
            sym[p] = int(self.m.by_rank[rk])
            q = after[p]
            gone[q], after[p] = True, after[q]
            if after[q] < n:
                before[after[q]] = p
            offer((before[p], p))
        return self._bytes((sym[p], chunk[p]) for p in range(n) if not gone[p])


def encode(docs: DataFrame, model: Model, dropout: float = DROPOUT, seed: int = SEED, copy: str | None = None) -> DataFrame:
    """(doc_id, text, piece_ids array<int>) for the rows of ``docs`` (doc_id, text); ``copy`` names a column of copy numbers."""
    def run(batches):
        enc = Encoder(model, dropout, seed)
        for b in batches:
            ids, texts, copies = (b.column(c).to_pylist() for c in range(3))
            at = 0
            while at < len(texts):
                first, cs, n, keys, many = at, [], [], [], 0
                while at < len(texts) and many < ROUND:
                    t, had = texts[at], len(cs)
                    if t:
                        many += len(t)
                        if SPACE in t:
                            segs = t.split(SPACE)
                            cs += chunks(segs[0])
                            for s in segs[1:]:
                                cs += ["", *_CHUNKS.findall(s.replace(" ", SPACE))]
                            real = np.array([c != "" for c in cs[had:]])
                            key = np.zeros(len(real), np.uint64)
                            key[real] = enc.keys(ids[at], copies[at], t, int(real.sum()))
                        else:
                            cs += chunks(t)
                            key = enc.keys(ids[at], copies[at], t, len(cs) - had)
                        keys.append(key)
                    n.append(len(cs) - had)
                    at += 1
                values, sizes = enc.encode(enc.learn(cs), np.concatenate(keys or [np.empty(0, np.uint64)]))
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *n])].astype(np.int32)
                arr = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()),
                                               mask=pa.array([t is None for t in texts[first:at]]))
                part = b.slice(first, at - first)
                cs = keys = key = values = sizes = None  # freed before the batch is handed on
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), arr], ["doc_id", "text", "piece_ids"])
    no = (F.col(copy) if copy else F.lit(0)).cast("long").alias("copy")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", no).mapInArrow(
        run, "doc_id long, text string, piece_ids array<int>")


def decode_ids(ids: np.ndarray, model: Model) -> str:
    """The text of piece ids: exact inverse of encoding."""
    table = _decode_table(model)
    return _finish(b"".join(map(table.__getitem__, ids.tolist())))


def _decode_table(model: Model) -> list[bytes]:
    # a space mark is a space; byte pieces, also those of a literal space mark, are themselves
    table = [p.replace(SPACE, " ").encode() for p in model.pieces]
    for x, i in enumerate(model.byte_ids):
        table[i] = bytes([x])
    return table


def _finish(raw: bytes) -> str:
    return raw[1:].decode("utf-8", "surrogatepass")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` (doc_id, text, piece_ids) with ``decoded``, worked out from the pieces alone."""
    def run(batches):
        table = _decode_table(model)
        size = np.array([len(x) for x in table], np.int32)
        first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(table), np.uint8)
        for b in batches:
            col = b.column(2)
            values, offs = col.values.to_numpy(), col.offsets.to_numpy()
            valid = col.is_valid().to_pylist()
            texts, at = [], 0
            while at < len(valid):
                lo = at
                at = max(lo + 1, int(np.searchsorted(offs, offs[lo] + DECODED, "right")) - 1)
                part = values[offs[lo]:offs[at]]
                n = size[part]
                raw = flat[_spread(first[part], n)].tobytes()
                ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[offs[lo:at + 1] - offs[lo]].tolist()
                texts += [_finish(raw[s:e]) if ok else None for s, e, ok in zip(ends, ends[1:], valid[lo:at])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), col, pa.array(texts, pa.string())],
                                             ["doc_id", "text", "piece_ids", "decoded"])
    return encoded.mapInArrow(run, "doc_id long, text string, piece_ids array<int>, decoded string")


def round_trip(docs: DataFrame, model: Model, **options) -> DataFrame:
    """(doc_id, n_pieces, pieces_hash, lossless): digests of encoding and decoding every text."""
    out = decode(encode(docs, model, **options), model)
    return out.select("doc_id", F.when(F.col("piece_ids").isNotNull(), F.size("piece_ids")).cast("long").alias("n_pieces"),
                      F.xxhash64("piece_ids").alias("pieces_hash"), F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"))
