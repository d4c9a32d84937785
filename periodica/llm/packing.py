"""Operator 6: best-fit packing with a swap-based local search.

Documents are cut into pieces of at most ``capacity`` tokens; a piece of full
length is a sequence by itself. The others are dealt at random into groups of a
bounded number of pieces. Each group is packed best-fit decreasing and then
improved: moves, one-for-one and two-for-one exchanges between underfull bins
that raise the sum of squared fills, so tokens flow from the emptiest bins into
fuller ones until bins run empty. It ends when a
lower bound proves that no bin can be saved, or when no underfull bin has such an
exchange left. A bin that has none is tried again only when an exchange with a bin
that changed since is possible, which one comparison of that bin with all pieces and
pairs tells.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import cut, read, ship

TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 300_000  # words of one Python worker's cache, about 45 MB; workers live on through later stages
TEXTS = 512            # texts encoded together


@dataclass(frozen=True)
class PackRules:
    capacity: int = 2048
    group: int = 4096      # pieces packed together
    end_id: int = 0        # closes each document


class Letters(dict):
    """Each letter (code point) as the tokenizer's model takes it, or a space where it does
    not join a run of letters. Asked of the tokenizer itself, once for each letter."""

    def __init__(self, tokenizer):
        super().__init__()
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer

    def __missing__(self, c: int) -> str:
        plain = self.normalizer.normalize_str(chr(c))
        run = self.splitter.pre_tokenize_str("a" + plain)
        self[c] = run[0][0][1:] if plain and len(run) == 1 else " "
        return self[c]


class WordIds(dict):
    """Token ids of texts, word by word, as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and no token crosses it, so the ids of a text
    are those of its words, one after another. It lower-cases, and it parts marks
    from letters and digits, so ``words`` may do both beforehand where a full stop
    or comma stands alone (İ becomes an i and a mark, which joins what follows). A word
    of letters alone is one run, which goes to the tokenizer's model without the steps
    before it. Known words are kept up to ``most``; what is learnt beyond that is
    forgotten after its texts.
    """

    # a full stop or comma next to something other than a word or white space
    JOINED = re.compile(r"[.,](?:[^ \t\n\r\f\v]|(?<=[^\w \t\n\r\f\v][.,])|(?<=[_İ][.,]))")

    def __init__(self, path: str, most: int = CACHE_WORDS):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model, self.letters = self.tokenizer.model, Letters(self.tokenizer)
        self.learnt: list[bytes] = []

    def one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def words(self, text: str) -> list[bytes]:
        if not self.JOINED.search(text):
            text = text.replace(".", " .").replace(",", " ,")
        data = text.encode()
        return (data if b"<|" in data else data.lower()).split()

    def __missing__(self, word: bytes) -> bytes:
        text, run = word.decode(), " "
        if text.isalpha() and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            run = text.translate(self.letters)
        if " " in run:
            data = self.one(text).tobytes()
        else:
            ids = [t.id for t in self.model.tokenize(run)]
            data = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = data
        self.learnt.append(word)
        return data

    def ids(self, texts: list[str]) -> list[bytes]:
        out = [b"".join(map(self.__getitem__, self.words(x))) for x in texts]
        if len(self) > self.most:
            for w in self.learnt:
                del self[w]
        self.learnt.clear()
        return out


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, rules: PackRules, path: str, doc_id: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of each document; ``with_ids`` adds its ids (array of int)."""
    ship(docs.sparkSession)
    size, end = rules.capacity, np.array([rules.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for b in (x.slice(a, TEXTS) for x in batches for a in range(0, x.num_rows, TEXTS)):
            out: list[list] = [[], [], [], [], [], []]
            bodies = known.ids([x or "" for x in b.column(1).to_pylist()])
            for key, data in zip(b.column(0).to_pylist(), bodies):
                data += end
                for k, a in enumerate(range(0, len(data), 4 * size)):
                    part = data[a:a + 4 * size]
                    row = (key, k, a // 4, len(part) // 4, zlib.crc32(part))
                    for col, v in zip(out, row):
                        col.append(v)
                    if with_ids:
                        out[5].append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)][:len(names)], names=names)
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, PIECES + (", ids array<int>" if with_ids else "")))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: for each k, pieces over capacity - k stand alone, those over
    half of it take a bin each, and the pieces of k or more must fit what is left."""
    x = np.sort(lengths)
    total = np.concatenate([[0], np.cumsum(x)])
    half = np.searchsorted(x, capacity // 2, "right")
    best = -(-int(x.sum()) // capacity)
    for k in np.unique(np.append(x[:half], 1)):
        big = np.searchsorted(x, capacity - k, "right")
        small = np.searchsorted(x, k, "left")
        room = (big - half) * capacity - (total[big] - total[half])
        more = max(0, -(-int(total[half] - total[small] - room) // capacity))
        best = max(best, int(len(x) - half) + more)
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins of piece numbers; a bit set knows the rooms that bins have."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room > n:
            by_room.setdefault(room - n, []).append(b)
            rooms |= 1 << (room - n)
    return bins


class Search:
    """Local search over the bins of one group."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.n, self.cap = [int(x) for x in lengths], capacity
        self.bins = [list(b) for b in bins]
        self.fill = np.array([sum(self.n[i] for i in b) for b in bins], dtype=np.int64)
        self.at = np.zeros(len(self.n), dtype=np.int64)
        for b, items in enumerate(bins):
            self.at[items] = b
        self.len = np.asarray(lengths, dtype=np.int64)
        self.pi = self.pj = self.pb = np.zeros(0, np.int64)
        self.pairs(range(len(bins)))
        self.open = {b for b in range(len(bins)) if self.fill[b] < capacity}     # donors to be tried
        self.changed: set[int] = set()

    def pairs(self, of) -> None:
        """Pairs of pieces in one underfull bin, anew for these bins."""
        found = [(i, j, b) for b in of if 1 < len(self.bins[b]) and self.fill[b] < self.cap
                 for x, i in enumerate(self.bins[b]) for j in self.bins[b][x + 1:]]
        p = np.array(found, dtype=np.int64).reshape(-1, 3)
        keep = ~np.isin(self.pb, list(of))
        self.pi, self.pj, self.pb = (np.append(old[keep], new) for old, new in zip((self.pi, self.pj, self.pb), p.T))

    def change(self, donor: int, out: list[int], to: int, back: list[int]) -> None:
        for i in out:
            self.bins[donor].remove(i)
            self.bins[to].append(i)
            self.at[i] = to
        for j in back:
            self.bins[to].remove(j)
            self.bins[donor].append(j)
            self.at[j] = donor
        d = sum(self.n[i] for i in out) - sum(self.n[j] for j in back)
        self.fill[donor] -= d
        self.fill[to] += d
        self.pairs((donor, to))
        self.changed |= {donor, to}

    def step(self, donor: int) -> bool:
        """One exchange that raises the sum of squared fills; the largest flow out of the donor."""
        mine = self.bins[donor]
        room = self.cap - self.fill
        room[donor] = -1
        room[self.fill == 0] = -1
        out_sets = [[i] for i in mine] + [[i, j] for x, i in enumerate(mine) for j in mine[x + 1:]]
        best, act = 0, None
        for out in out_sets:
            n = sum(self.n[i] for i in out)
            fits = np.flatnonzero(room >= n)
            if len(out) == 1 and len(fits):  # move, into the fullest bin that takes it
                b = int(fits[np.argmin(room[fits])])
                if self.fill[b] + n > self.fill[donor] and n > best:
                    best, act = n, (out, b, [])
            flow = n - self.len                                         # one or two for one
            flow[(flow <= 0) | (flow > room[self.at]) | (self.fill[self.at] + flow <= self.fill[donor])] = 0
            j = int(np.argmax(flow))
            if flow[j] > best:
                best, act = int(flow[j]), (out, int(self.at[j]), [j])
            if len(out) == 1 and len(self.pb):                         # one for two
                flow = n - self.len[self.pi] - self.len[self.pj]
                flow[(flow <= 0) | (flow > room[self.pb]) | (self.fill[self.pb] + flow <= self.fill[donor])] = 0
                k = int(np.argmax(flow))
                if flow[k] > best:
                    best, act = int(flow[k]), (out, int(self.pb[k]), [int(self.pi[k]), int(self.pj[k])])
        if act is None:
            return False
        self.change(donor, *act)
        return True

    def wake(self, b: int) -> None:
        """Open the donors that have an exchange with bin b: any of their pieces or pairs for
        one of its pieces, a piece for a pair of its, or a move."""
        mine, room = self.bins[b], self.cap - int(self.fill[b])
        if not mine or not room:
            return
        one = np.array([self.n[i] for i in mine])
        two = np.array([self.n[i] + self.n[j] for x, i in enumerate(mine) for j in mine[x + 1:]], dtype=np.int64)

        def having(sizes: np.ndarray, at: np.ndarray, back: np.ndarray) -> list[int]:
            full = self.fill[at]
            able = np.flatnonzero((full < self.cap) & (at != b))
            flow = sizes[able, None] - back[None, :]
            ok = (flow > 0) & (flow <= room) & (int(self.fill[b]) + flow > full[able, None])
            return np.unique(at[able[ok.any(axis=1)]]).tolist()
        self.open.update(having(self.len, self.at, np.concatenate([[0], one, two])))
        self.open.update(having(self.len[self.pi] + self.len[self.pj], self.pb, one))

    def run(self) -> list[list[int]]:
        goal = lower_bound(self.len, self.cap)
        live = sum(1 for b in self.bins if b)
        while live > goal and self.open:
            donor = min(self.open, key=lambda b: (self.fill[b], b))
            while self.bins[donor] and self.step(donor):
                pass
            self.open.discard(donor)
            live -= not self.bins[donor]
            for b in self.changed:
                if b != donor and self.bins[b] and self.fill[b] < self.cap:
                    self.open.add(b)
                self.wake(b)
            self.changed.clear()
        return [b for b in self.bins if b]


def pack_group(lengths: np.ndarray, rules: PackRules) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece."""
    bins = best_fit(lengths, rules.capacity)
    if len(bins) > lower_bound(lengths, rules.capacity):
        bins = Search(lengths, bins, rules.capacity).run()
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(bins):
        at = 0
        for i in items:
            where[i], offset[i] = b, at
            at += int(lengths[i])
    return where, offset


PACKED = PIECES + ", sequence_id long, offset long"


def pack(pieces: DataFrame, rules: PackRules = PackRules()) -> DataFrame:
    """Give each piece (see ``token_pieces``) a sequence and its offset there.

    Pieces are dealt by their row number in the cut table, so copies of a row
    spread over all groups and no group grows with a key; a null doc_id is kept.
    """
    ship(pieces.sparkSession)
    rows = cut(pieces).withColumn("_row", F.monotonically_increasing_id())
    full = rows.filter(F.col("length") == rules.capacity)
    rest = rows.filter(F.col("length") < rules.capacity)
    groups = max(1, -(-rest.count() // rules.group))

    def run(t: pa.Table) -> pa.Table:
        where, offset = pack_group(t.column("length").to_numpy(), rules)
        base = (t.column("_group")[0].as_py() if t.num_rows else 0) << 32
        return (t.drop_columns(["_row", "_group"])
                .append_column("sequence_id", pa.array(where + base, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))
    packed = (rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
              .groupBy("_group").applyInArrow(run, PACKED))
    alone = full.withColumn("sequence_id", -F.col("_row") - 1).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone.drop("_row"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    rules = PackRules()
    docs = read(spark, sf_dir, "documents")
    return pack(token_pieces(docs, rules, public_tokenizers.path(TOKENIZER)), rules)
