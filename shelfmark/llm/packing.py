"""Best-fit packing of token pieces by exact-complement hashing.

Lengths are integers up to the capacity, so the whole plan is made on the counts per length: at most ``capacity``
numbers, whatever the number of documents.  The plan's runs of equal sequences are then spread over the pieces by
their rank within a length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import CACHE_WORDS, materialise, salt_of

CAPACITY = 1024
END_ID = 2
_LONG_PART = 64
_ROW_PARTS = 200
_BLOCK_CHARS = 8_000_000
_ROWS_PER_SALT = 500_000
# A text may be cut before a single space between characters that aren't white space: byte-level BPE of this kind
# always begins a token there, so the parts can be encoded one by one.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_TOUCHES_WHITE = f"^$|^[{_WHITE}]|[{_WHITE}]$"
# Inside a part the same holds before a single line break, and where a letter is followed by a sign or digit of ASCII: no
# token holds both, and none depends on what stands before it.
_SIGN_JOINT, _LINE_JOINT = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-@\[-`{-~])", r"([!-~À-ÖØ-öø-ÿ])(\n[!-~À-ÖØ-öø-ÿ])"


def _at_spaces(texts: list[str]) -> pa.Array:
    return pc.split_pattern(pa.array(texts, pa.string()), " ")


def _at_single_spaces(texts: list[str]) -> pa.Array:
    return pa.array([_CUT.split(text) for text in texts], pa.list_(pa.string()))


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def _heads_and_tails(lists: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The first value of each list, all others, and how many values each list has."""
    values, edges = lists.flatten(), lists.offsets.to_numpy()
    first = np.zeros(len(values), bool)
    first[edges[:-1]] = True
    return values.filter(pa.array(first)), values.filter(pa.array(~first)), np.diff(edges)


def _gather(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` hold the ids of entries, ``sizes`` of them each; the same for the entries in the given order."""
    starts, wanted = (np.cumsum(sizes) - sizes)[order], sizes[order]
    places = np.repeat(starts - np.cumsum(wanted) + wanted, wanted)
    places += np.arange(len(places))
    return ids[places], wanted


class PartIds:
    """Token ids of texts as little-endian 32-bit bytes.

    Texts are cut into parts at spaces, and parts into a word and the pieces behind it; each different word is encoded
    once a call, and the ids of the pieces are remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(True)
        self.begins = {}  # whether a token begins with a space, or with a line break
        for mark, letter in ((" ", "Ġ"), ("\n", "Ċ")):
            self.begins[mark] = np.zeros(max(vocabulary.values()) + 1, bool)
            self.begins[mark][[i for token, i in vocabulary.items() if token.startswith(letter)]] = True
        self.known: dict[str, bytes] = {}

    def _places(self, row: list[str], joined: str) -> np.ndarray:
        """Where the tokens of each part begin, by their places in the text."""
        got = self.tokenizer.encode(joined, add_special_tokens=False)
        ends = np.fromiter((end for _, end in got.offsets), np.int64, len(got.ids))
        return np.searchsorted(ends, np.cumsum([0] + [len(p) + 1 for p in row[:-1]]), side="right")

    def _rows(self, parts: pa.Array, mark: str = " ") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, each after a mark, and how many each has.  They are encoded in rows of many and cut where a
        token begins with the mark.

        Every part begins so; a row with more such tokens than parts has marks inside and is cut by the tokens' places.
        """
        edges = np.append(np.arange(0, len(parts), _ROW_PARTS), len(parts))
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), parts), pa.scalar(mark, pa.string()))
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for row, a, b in zip(_strings(rows), edges.tolist(), edges[1:].tolist()):
            got = np.array(self._ids([mark + row])[0], "<u4")
            cuts = np.flatnonzero(self.begins[mark][got])
            if len(cuts) != b - a:
                cuts = self._places(_strings(parts[a:b]), mark + row)
            ids.append(got)
            sizes.append(np.diff(cuts, append=len(got)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode(self, parts: list[str], mark: str = " ") -> list[bytes]:
        ids, sizes = self._rows(pa.array(parts, pa.string()), mark)
        edges, raw = [0, *(4 * np.cumsum(sizes)).tolist()], ids.tobytes()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for at in range(0, len(texts), 100) for x in self._ids(texts[at : at + 100])]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that stand behind a word: a line break and what follows it, or what begins with a sign or digit."""
        known = self.known
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = pieces
        # A line break is one token; pieces without one of their own are encoded behind one, which then goes.
        found = self._encode([p.removeprefix("\n") for p in new], "\n")
        known.update((p, ids if p[0] == "\n" else ids[4:]) for p, ids in zip(new, found))
        return [known[p] for p in pieces]

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts after a space, how many each has, and which touch white space: they don't stand alone."""
        odd = pc.match_substring_regex(parts, _TOUCHES_WHITE).to_numpy(zero_copy_only=False)
        cut = ~odd & (pc.utf8_length(parts).to_numpy() <= _LONG_PART) & ~pc.match_substring(parts, " ").to_numpy(zero_copy_only=False)
        marked = parts.filter(pa.array(cut))
        for joint in (_SIGN_JOINT, _LINE_JOINT, _LINE_JOINT):  # lines of one character share it with both neighbours
            marked = pc.replace_substring_regex(marked, joint, r"\1 \2")
        heads, tails, counts = _heads_and_tails(pc.split_pattern(marked, " "))
        words = pa.concat_arrays([heads, parts.filter(pa.array(~cut & ~odd))]).dictionary_encode()
        pieces = tails.dictionary_encode()
        ids, sizes = self._rows(words.dictionary)
        found = self._pieces(_strings(pieces.dictionary))
        ids = np.concatenate([ids, np.frombuffer(b"".join(found), "<u4")])
        sizes = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found)) // 4, [0]])  # the last: no ids
        many = np.ones(len(parts), np.int64)
        many[cut] = counts
        first = np.cumsum(many) - many
        order = np.full(many.sum(), -1)
        order[np.concatenate([first[cut], first[~cut & ~odd]])] = words.indices.to_numpy()
        order[np.setdiff1d(np.arange(len(order)), first, assume_unique=True)] = len(words.dictionary) + pieces.indices.to_numpy()
        ids, sizes = _gather(ids, sizes, order)
        return ids, np.add.reduceat(sizes, first) if len(first) else sizes, odd

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        left = [k for k, text in enumerate(texts) if text]
        for cutter in (_at_spaces, _at_single_spaces):
            if not left:
                break
            heads, tails, counts = _heads_and_tails(cutter([texts[k] for k in left]))
            tails = tails.dictionary_encode()
            own, sizes, odd = self._parts(tails.dictionary)
            order, ends = tails.indices.to_numpy(), np.append(0, np.cumsum(counts - 1))
            heads, again = self._whole(_strings(heads)), []
            for at in range(0, len(left), 100):
                edges = ends[at : at + 101]
                row = order[edges[0] : edges[-1]]
                ids, wanted = _gather(own, sizes, row)
                edges, raw = edges - edges[0], ids.tobytes()
                places = 4 * np.append(0, np.cumsum(wanted))[edges]
                odds = np.diff(np.append(0, np.cumsum(odd[row]))[edges])
                for k, head, a, b, n in zip(left[at : at + 100], heads[at : at + 100], places.tolist(), places[1:].tolist(), odds.tolist()):
                    if n:
                        again.append(k)
                    else:
                        out[k] = head + raw[a:b]
            left = again
        for k, ids in zip(left, self._whole([texts[k] for k in left])):
            out[k] = ids
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> PartIds:
    """The encoder of a worker.  Tasks share the cores already; threads of the tokenizer's own would only wait for each other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return PartIds(path)


def _blocks(batches: Iterator[pd.Series]) -> Iterator[list[str | None]]:
    """The texts in lists of some size, as the words of a list are encoded once."""
    held, chars = [], 0
    for texts in batches:
        for text in texts.tolist():
            held.append(text)
            chars += len(text or "")
            if chars >= _BLOCK_CHARS:
                yield held
                held, chars = [], 0
    if held:
        yield held


def token_pieces(docs: DataFrame, tokenizer: str, with_ids: bool = True, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(ident, piece, start, length, ids_crc32[, ids])``: the ids of every text and the end id, cut where too long.

    Every piece but the first has ``CAPACITY`` tokens; the first has what remains.  Null and empty texts are the end
    id alone.  Repeated rows and null idents give pieces of their own; other columns are not read.
    """
    kind = "lengths array<int>, crcs array<long>" + ", ids array<array<int>>" * with_ids

    @F.pandas_udf(kind)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, end = _encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        try:
            for values in _blocks(batches):
                coded = encoder.encode(values)
                for at in range(0, len(values), 1000):
                    out = []
                    for raw in coded[at : at + 1000]:
                        raw += end
                        n = len(raw) // 4
                        first = n % CAPACITY or CAPACITY
                        edges = [0, *range(first, n + 1, CAPACITY)]
                        parts = [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
                        row = [[len(p) // 4 for p in parts], [zlib.crc32(p) for p in parts]]
                        out.append(row + [[np.frombuffer(p, "<i4") for p in parts]] * with_ids)
                    yield pd.DataFrame(out, columns=["lengths", "crcs", "ids"][: 2 + with_ids])
        finally:  # the worker stays, and with it the memory of what it remembers
            encoder.known.clear()
            pa.default_memory_pool().release_unused()

    zipped = "arrays_zip(lengths, crcs, ids)" if with_ids else "arrays_zip(lengths, crcs)"
    rows = docs.select(F.col(ident).alias(ident), cut(F.col(text)).alias("cut")).select(ident, "cut.*")
    rows = rows.select(ident, F.col("lengths")[0].alias("first"), F.posexplode(F.expr(zipped)).alias("piece", "part"))
    start = F.expr(f"IF(piece = 0, 0L, first + (piece - 1L) * {CAPACITY})")
    names = {"lengths": "length", "crcs": "ids_crc32", "ids": "ids"}
    picked = [F.col(f"part.{old}").cast("long").alias(new) if old != "ids" else F.col("part.ids") for old, new in list(names.items())[: 2 + with_ids]]
    return rows.select(ident, "piece", start.alias("start"), *picked)


def _exact(free: np.ndarray, length: int, capacity: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that exactly fill what ``length`` leaves of the capacity."""
    gap = capacity - length
    if gap == 0:
        return ()
    own = free.copy()
    own[length] -= 1
    if own[gap] > 0:
        return (gap,)

    def pair(total: int, top: int) -> tuple[int, int] | None:
        low = np.arange(max(1, total - top), total // 2 + 1)
        ok = (own[low] > 0) & (own[total - low] > 0)
        if total % 2 == 0 and len(low):
            ok[-1] &= own[total // 2] > 1
        hits = np.flatnonzero(ok)
        return (total - int(low[hits[0]]), int(low[hits[0]])) if len(hits) else None

    if two := pair(gap, gap):
        return two
    for big in range(gap - 2, (gap + 2) // 3 - 1, -1):
        if own[big] > 0:
            own[big] -= 1
            rest = pair(gap - big, min(big, gap - big - 1))
            own[big] += 1
            if rest:
                return (big, *rest)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each.

    From the longest length down, sums of one to three other lengths that exactly fill the gap are consumed as often
    as all of them are available; every step uses up a length or its combination.  What is left is put, longest
    first, into the open sequence with the least room that takes it.
    """
    free = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        free[length] = n
    full: list[tuple[tuple[int, ...], int]] = []
    rest: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while free[length] > 0:
            found = _exact(free, length, capacity)
            if found is None:
                rest.append((length, int(free[length])))
                free[length] = 0
                break
            pattern = (length, *found)
            times = min(int(free[x]) // pattern.count(x) for x in set(pattern))
            for x in pattern:
                free[x] -= times
            full.append((pattern, times))
    rooms: dict[int, list[list]] = {}  # room left -> patterns with that room
    for length, n in rest:
        while n:
            room = min((r for r in rooms if r >= length and rooms[r]), default=None)
            if room is None:
                each = capacity // length
                many, n = divmod(n, each)
                if many:
                    rooms.setdefault(capacity - each * length, []).append([(length,) * each, many])
                if n:
                    rooms.setdefault(capacity - n * length, []).append([(length,) * n, 1])
                n = 0
            else:
                group = rooms[room][-1]
                times = min(n, group[1])
                group[1] -= times
                if not group[1]:
                    rooms[room].pop()
                rooms.setdefault(room - length, []).append([group[0] + (length,), times])
                n -= times
    return full + [(pattern, times) for groups in rooms.values() for pattern, times in groups if times]


def place(pieces: DataFrame, ident: str = "doc_id") -> DataFrame:
    """The columns of ``pieces`` with ``sequence_id`` and ``offset``; pieces are ``(ident, piece, length, ids_crc32, ...)``.

    Only the counts per length come to the driver, and only the runs of the plan are broadcast; both are bounded by the
    capacity.  Ranks are counted per length and salt, so that a very common length is spread over many tasks.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, used, base = [], dict.fromkeys(counts, 0), 0
    for pattern, times in plan(counts):
        offset = 0
        for length in pattern:
            runs.append((length, used[length], used[length] + times, base, offset))
            used[length] += times
            offset += length
        base += times
    table = spark.createDataFrame(runs, "length long, rank_from long, rank_to long, base long, offset long")
    salts = max(64, sum(counts.values()) // _ROWS_PER_SALT)
    salted = pieces.withColumn("salt", salt_of(F.struct(ident, "piece"), salts))
    shares = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    shares = materialise(shares.select(F.col("length").alias("of_length"), F.col("salt").alias("of_salt"), before.alias("before")), "length-shares")
    order = Window.partitionBy("length", "salt").orderBy(ident, "piece", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(order))
    ranked = ranked.join(shares, (F.col("length") == F.col("of_length")) & (F.col("salt") == F.col("of_salt")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth") - 1).drop("of_length", "of_salt", "before", "nth", "salt")
    runs_of = table.withColumnRenamed("length", "run_length")
    hit = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    placed = ranked.join(F.broadcast(runs_of), hit)
    return placed.select(*pieces.columns, (F.col("base") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(ident, piece, start, length, ids_crc32, sequence_id, offset)`` of every document."""
    return place(materialise(token_pieces(docs, tokenizer, False, ident, text), "pieces"), ident)


def sequences(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The packed sequences themselves: ``(sequence_id, length, ids)``; at most ``CAPACITY`` ids a row."""
    pieces = materialise(token_pieces(docs, tokenizer, True, ident, text), "pieces-with-ids")
    placed = place(pieces, ident).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
    return placed.select("sequence_id", "length", F.flatten(F.col("parts.ids")).alias("ids"))
