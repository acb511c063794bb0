"""Phrase collocations with stripes.

Every prefix of zero, one or two words keys a counter of the words that follow it.  Counters are built per task,
merged elementwise, and give everything else: an entry is the count of prefix plus word, which is also the total of the
prefix that is one word longer, and the largest entry that extends a phrase decides whether it is subsumed.

A phrase can only be frequent if what is left without its first and without its last word is.  So each level ships
entries only of what may pass, told by a bitmap of the level before; the bitmap may let too much through, never too
little.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise, mix64

_BREAK = 0xFF  # a byte that UTF-8 never uses stands between pieces
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_SPELLING = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + bytes([_BREAK]) * len(_SEPARATORS)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Mining:
    """``flush`` words of a task share counters; ``chunk`` bytes of a text are cut into words at a time.

    A prefix that more than one in ``share`` of a task's words begin with has its counter dealt out by the next word, over
    as many tasks as it takes.  A bitmap has ``bits`` bits for each phrase that it marks, and ``most_bits`` at most.
    """

    most_words: int = 3
    least: int = 10
    subsumed: int = 50  # percent of a phrase's places at which a longer one takes its place
    first: int = 2000
    flush: int = 5_000_000
    chunk: int = 1 << 22
    share: int = 2
    bits: int = 16
    most_bits: int = 1 << 27


class _Ids(dict):
    """Words to integers from 1, in the order they are met; 0 is the break between pieces, and the empty word."""

    def __init__(self) -> None:
        super().__init__({bytes([_BREAK]): 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


class Marks:
    """A bitmap over 64-bit hashes; its length is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(64 * len(self.words) - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _longer(sofar: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more."""
    with np.errstate(over="ignore"):
        return mix64(sofar * _ODD + words)


def _word_ids(data: bytes, ids: _Ids, chunk: int) -> Iterator[np.ndarray]:
    """The words of one text as integers, with 0 between pieces and at the end."""
    data = data.translate(_SPELLING)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + chunk)
        end = len(data) if end < 0 else end
        words = data[at:end].replace(b"\xff", b" \xff ").split()
        yield np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        at = end
    yield np.zeros(1, np.int64)


def _level(x: np.ndarray, level: int, root: np.ndarray, words: np.ndarray, passing: list[Marks]):
    """Counters of one run of words: ``(grams, hashes, prefix, next, count)``.

    ``grams`` are the prefixes as rows of word ids, ``hashes`` theirs; ``prefix`` counts rows of ``grams`` and entries are
    sorted by it.  At level 0 the entry of word 0 is the number of all words.
    """
    size = np.int64(len(words))
    grams, hashes = np.zeros((1, 0), np.int64), root
    code = np.where(x > 0, 0, -1)  # the phrase of ``level`` words that starts here, if it may be frequent
    for m in range(level):
        both = (code >= 0) & (x > 0 if m == 0 else np.append(code[1:] >= 0, False))
        at = np.flatnonzero(both)
        at = at[at + m < len(x)]
        last = x[at + m]
        fine = last > 0
        at, last = at[fine], last[fine]
        keys, inverse = np.unique(code[at] * size + last, return_inverse=True)
        before, after = keys // size, keys % size
        grams, hashes = np.column_stack([grams[before], after]), _longer(hashes[before], words[after])
        passes = passing[m].has(hashes)
        dense = np.where(passes, np.cumsum(passes) - 1, -1)
        code = np.full(len(x), -1, np.int64)
        code[at] = dense[inverse]
        grams, hashes = grams[passes], hashes[passes]
    starts = np.flatnonzero(code >= 0)
    if level == 0:
        counts = np.bincount(x, minlength=len(words))
        counts[0] = len(starts)
        after = np.flatnonzero(counts)
        return grams, hashes, np.zeros(len(after), np.int64), after, counts[after]
    at = starts[starts + level < len(x)]
    at = at[(x[at + level] > 0) & (code[at + 1] >= 0)]
    keys, counts = np.unique(code[at] * size + x[at + level], return_counts=True)
    return grams, hashes, keys // size, keys % size, counts


_STRIPES = "lang string, prefix string, slice int, nexts array<string>, counts array<long>"


def _stripes(texts: DataFrame, level: int, passing: list[Marks], hot: dict[int, int], settings: Mining) -> DataFrame:
    """Counters of prefixes with ``level`` words, one row per task, flush, prefix and slice.

    ``hot`` has the number of slices by the hash of a prefix, where it is more than one.
    """
    common = np.array(sorted(hot), np.uint64)
    dealt = np.array([hot[h] for h in sorted(hot)], np.int64)

    def rows(held: dict[str, list[np.ndarray]], ids: _Ids) -> Iterator[pa.RecordBatch]:
        spelled = [b"", *list(ids)[1:]]
        names = pa.array(spelled, pa.binary()).cast(pa.string())
        words = np.fromiter(map(_hash, spelled), np.uint64, len(spelled))
        for lang, runs in held.items():
            root = np.array([_hash(lang.encode())], np.uint64)
            grams, hashes, prefix, after, counts = _level(np.concatenate(runs), level, root, words, passing)
            if not len(prefix):
                continue
            slices = np.ones(len(grams), np.int64)
            if level == 0:
                slices[:] = hot[0]
            elif len(common):
                found = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                slices = np.where(common[found] == hashes, dealt[found], 1)
            part = (words[after] % slices[prefix].astype(np.uint64)).astype(np.int64)
            order = np.argsort(prefix * slices.max() + part, kind="stable")
            prefix, part, after, counts = prefix[order], part[order], after[order], counts[order]
            begins = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])))
            for low in range(0, len(begins), 20_000):
                here = begins[low : low + 20_000]
                end = begins[low + 20_000] if low + 20_000 < len(begins) else len(prefix)
                offsets = pa.array(np.append(here, end) - here[0], pa.int32())
                own = grams[prefix[here]]
                parts = [names.take(pa.array(own[:, m])) for m in range(level)]
                spelling = pc.binary_join_element_wise(*parts, " ") if level else pa.array([""] * len(here), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(here), pa.string()),
                        spelling,
                        pa.array(part[here], pa.int32()),
                        pa.ListArray.from_arrays(offsets, names.take(pa.array(after[here[0] : end]))),
                        pa.ListArray.from_arrays(offsets, pa.array(counts[here[0] : end], pa.int64())),
                    ],
                    names=["lang", "prefix", "slice", "nexts", "counts"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        ids, sofar = _Ids(), 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                own = held.setdefault(lang.as_py(), [])
                for run in _word_ids(text.as_py(), ids, settings.chunk):
                    own.append(run)
                    sofar += len(run)
                if sofar >= settings.flush:
                    yield from rows(held, ids)
                    held, ids, sofar = {}, _Ids(), 0
        if held:
            yield from rows(held, ids)

    return texts.mapInArrow(count, _STRIPES)


def _merged(stripes: DataFrame, parts: int, least: int, label: str) -> DataFrame:
    """``(lang, prefix, next, f)``: elementwise sums of the counters, for totals and entries of at least ``least``.

    Partial counters move as they are and are taken apart where they meet, so a task adds them in an aggregate that
    spills, whatever the size of a counter.
    """
    met = stripes.repartition(parts, "lang", "prefix", "slice")
    entries = met.select("lang", "prefix", "slice", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    sums = entries.groupBy("lang", "prefix", "slice", F.col("e.nexts").alias("next")).agg(F.sum("e.counts").alias("f"))
    return materialise(sums.where(F.col("f") >= least).select("lang", "prefix", "next", "f"), label)


def _marks(phrases: DataFrame, settings: Mining) -> Marks:
    """Bitmap of ``(lang, phrase)`` rows of equally many words."""
    count = phrases.count()
    size = min(max(1 << 16, 1 << (settings.bits * count).bit_length()), settings.most_bits)

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = _gram_hashes(batch)
            at &= np.uint64(size - 1)
            slots, inverse = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
            bits = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pd.DataFrame({"slot": slots, "bits": bits.view(np.int64)})

    found = phrases.mapInPandas(set_bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(size // 64, np.uint64)
    words[found["slot"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return Marks(words)


def _gram_hashes(rows: pd.DataFrame) -> np.ndarray:
    """The hashes of ``(lang, phrase)`` rows of equally many words, as the counters have them."""
    sofar = np.fromiter((_hash(lang.encode()) for lang in rows["lang"]), np.uint64, len(rows))
    spelled = [phrase.encode().split(b" ") for phrase in rows["phrase"]]
    for place in range(len(spelled[0]) if spelled else 0):
        sofar = _longer(sofar, np.fromiter((_hash(words[place]) for words in spelled), np.uint64, len(spelled)))
    return sofar


def _phrases(level: DataFrame) -> DataFrame:
    """``(lang, phrase, prefix, next, f)`` of a level's entries."""
    joined = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    return level.where("next <> ''").withColumn("phrase", joined)


def merged_stripes(docs: DataFrame, settings: Mining = Mining(), text: str = "text", lang: str = "lang") -> list[DataFrame]:
    """Per number of words in the prefix: ``(lang, prefix, next, f)`` of all counts of at least ``least``.

    In the first frame, an empty ``next`` has the number of all words of the language.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    texts = texts.where("text is not null")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.rdd.getNumPartitions())
    levels: list[DataFrame] = []
    passing: list[Marks] = []
    hot, total = {0: settings.share * parts}, 0
    for level in range(settings.most_words):
        stripes = _stripes(texts, level, list(passing), hot, settings)
        # A total of the whole language counts however small it is.
        levels.append(_merged(stripes, parts, 1 if level == 0 else settings.least, f"stripes-{level}"))
        if level == 0:
            total = levels[0].where("next = ''").agg(F.sum("f")).first()[0] or 0
            levels[0] = levels[0].where((F.col("f") >= settings.least) | (F.col("next") == ""))
        found = _phrases(levels[level])
        if level + 1 < settings.most_words:
            passing.append(_marks(found.select("lang", "phrase"), settings))
            # Fewer than ``share * parts`` phrases of one length, as they would otherwise have more words than there are.
            slices = F.ceil(F.col("f") * settings.share * parts / max(total, 1)).cast("long").alias("slices")
            common = found.select("lang", "phrase", slices).where("slices > 1").toPandas()
            hot = {int(h): int(n) for h, n in zip(_gram_hashes(common), common["slices"])}
    return levels


def collocations(docs: DataFrame, settings: Mining = Mining(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first phrases of two words and more.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest-scoring cut (the first of equal ones), ``n``
    all words of the language; the score is ``floor(1000000 * a * a / (l * r))``, with counts below 10^15 in exact decimals.
    A phrase goes where a longer one of at least ``least`` places holds ``subsumed`` percent of its places.  Null texts
    are empty, a null language is ``und``; repeated rows count each time; a text is never cut short.  An empty table, or
    one without frequent phrases, gives no rows.
    """
    levels = merged_stripes(docs, settings, text, lang)
    phrases = [_phrases(level) for level in levels[1:]]
    # What every phrase of one word more says about the two phrases inside it.
    inside = None
    for longer in phrases[1:]:
        both = F.array(F.col("prefix"), F.concat_ws(" ", F.expr("substring(prefix, instr(prefix, ' ') + 1)"), F.col("next")))
        rows = longer.select("lang", F.explode(both).alias("phrase"), F.col("f").alias("above"))
        inside = rows if inside is None else inside.unionByName(rows)
    rows = phrases[0]
    for more in phrases[1:]:
        rows = rows.unionByName(more)
    rows = rows.select("lang", "phrase", F.col("f").alias("a"))
    if inside is not None:
        rows = rows.join(inside.groupBy("lang", "phrase").agg(F.max("above").alias("above")), ["lang", "phrase"], "left")
        rows = rows.where(F.col("above").isNull() | (100 * F.col("above") < settings.subsumed * F.col("a"))).drop("above")
    # The counts of all parts are totals of prefixes, which the level before has.
    totals = None
    for level in levels[:-1]:
        own = _phrases(level).select("lang", F.col("phrase").alias("part"), "f")
        totals = own if totals is None else totals.unionByName(own)
    words = F.split("phrase", " ")
    cuts = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " "))
    cuts = cuts.join(totals.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(totals.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    cuts = cuts.withColumn("above", a * a * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("below", l * r)
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # First within parts of a language, so that the last step sees a fixed number of rows, whatever number there are.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    parted = parted.where(F.col("rank") <= settings.first).drop("rank", "part")
    ranked = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= settings.first)
    sizes = levels[0].where("next = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
