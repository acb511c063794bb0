"""Toxicity, MinHash, line dedup, mixing and packing against brute force and on awkward rows."""

import gc
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm_helpers import BASE, LONG, awkward, components, documents, near_duplicate_components
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import components as llm_components
from shelfmark.llm import lines, minhash, mixing, packing, queries, toxicity

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# -- components --------------------------------------------------------------------


def test_components_of_random_graphs(spark):
    draw = random.Random(1)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.component for r in llm_components.connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components(nodes, links)


def test_components_without_edges(spark):
    edges = spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")
    assert llm_components.connected_components(edges).count() == 0


# -- MinHash -----------------------------------------------------------------------


def test_minhash_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    sets, parts = near_duplicate_components(rows, 3, 85)
    got = queries.op5_minhash_near_dedup(spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), parts[i], parts[i] == i) for i in sets}


def test_minhash_links_through_a_chain(spark):
    words = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(12):  # each differs from the next in one more place
        changed = [f"x{i}" if i % 60 == 0 and i // 60 < k else w for i, w in enumerate(words)]
        texts.append(" ".join(changed + [f"tail{k // 3}"]))
    docs = documents(spark, texts + ["quite another text with words of its own"])
    _, parts = near_duplicate_components(list(enumerate(texts + ["quite another text with words of its own"])), 3, 85)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, queries.CONTRACT_BANDING).collect()}
    assert got == parts


def test_minhash_on_awkward_rows(spark, rows):
    got = rows(minhash.near_duplicates(awkward(spark)), "doc_id", "component_id", "kept")
    assert got.count((1, 0, False)) == 2 and (0, 0, True) in got and (6, 5, False) in got
    assert {(2, 2, True), (3, 3, True), (4, 4, True), (7, 7, True), (8, 8, True)} <= set(got) and len(got) == 12
    assert minhash.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_minhash_keeps_one_of_each_group(spark):
    docs = awkward(spark)
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id is not None) == [(False, i) for i in (0, 2, 3, 4, 5, 7, 8)]
    repeated = documents(spark, [BASE, BASE], ids=[4, 4])
    assert minhash.without_near_duplicates(repeated).count() == 1


# -- toxicity ----------------------------------------------------------------------


def test_segments_equal_brute_force():
    def best(values):
        """All maximal segments by their definition: highest first, then left and right of it."""
        out = []

        def find(low, high):
            top = max(((sum(values[a:b]), a - b, -a, a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,))
            if top[0] > 0:
                find(low, top[3])
                out.append((top[3], top[4], top[0]))
                find(top[4], high)

        find(0, len(values))
        return out

    draw = random.Random(5)
    for _ in range(200):
        values = [draw.choice([-3, -2, -1, 1, 2, 3]) + draw.random() / 100 for _ in range(draw.randrange(14))]
        got = toxicity.segments(np.array(values, float))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in best(values)]
        assert np.allclose([s for _, _, s in got], [s for _, _, s in best(values)])


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_toxicity_on_held_out_rows(spark, folder):
    scored = queries.op1_toxicity(spark, folder)
    known = scored.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in known) / len(known)
    caught = sum(r.predicted for r in known if r.toxic) / sum(r.toxic for r in known)
    spared = sum(1 - r.predicted for r in known if not r.toxic) / sum(1 - r.toxic for r in known)
    assert right > 0.95 and caught > 0.8 and spared > 0.98
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in known)


def test_toxicity_on_awkward_rows(spark):
    labelled = documents(spark, [f"nice text {BASE} {i}" for i in range(150)] + [f"{BASE} badword you badword {i}" for i in range(150)])
    rows = labelled.select("text", F.when(F.col("doc_id") >= 150, 1).otherwise(0).alias("label"))
    model = toxicity.train(rows)
    docs = awkward(spark).unionByName(documents(spark, ["so badword and badword"], ids=[50]))
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == 13 and [r.doc_id for r in got if r.predicted] == [50]
    assert toxicity.without_toxic(docs, model).columns == docs.columns and toxicity.without_toxic(docs, model).count() == 12
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    for none in (rows.limit(0), rows.where("label = 0")):
        plain = toxicity.train(none)
        assert plain.weights == {} and toxicity.score_documents(docs, plain).where("predicted = 1 and score < 0.5").count() == 0


# -- line dedup --------------------------------------------------------------------


def _apart(a, b):
    """Edit distance between sequences of words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def _kept_lines(rows):
    """Rows ``(doc_id, text)`` with distinct ids, after line dedup."""
    seen, out = [], {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = None
            continue
        keep = []
        for line in text.split("\n"):
            body = line.strip(" ")
            if line.strip(" \t\r\x0b\x0c"):
                units = body.split(" ") if " " in body or len(body) < lines.MIN_CHARS else ["char " + c for c in body]
                fit = len(units) >= lines.MIN_WORDS
                again = any(units == w or fit and len(w) >= lines.MIN_WORDS and abs(len(units) - len(w)) <= 1 and _apart(units, w) <= 1 for w in seen)
                seen.append(units)
                if again:
                    continue
            keep.append(line)
        out[i] = "\n".join(keep)
    return out


def test_line_dedup_equals_brute_force(spark):
    draw, texts = random.Random(2), []
    pool = [[draw.choice("abcdefgh") for _ in range(draw.randrange(3, 9))] for _ in range(40)]
    for _ in range(60):
        body = []
        for _ in range(draw.randrange(5)):
            words = list(draw.choice(pool))
            for _ in range(draw.randrange(3)):
                at = draw.randrange(len(words))
                words[at : at + draw.randrange(2)] = draw.choice([[], ["z"], ["a"]])
            body.append(draw.choice(["", " "]) + " ".join(words))
        texts.append("\n".join(body))
    docs = documents(spark, texts)
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(docs).collect()}
    assert got == _kept_lines(list(enumerate(texts)))


def test_short_lines_and_lines_without_spaces(spark):
    page = "漢字" * 12
    texts = ["All rights reserved.\nLes.\n\n \t\nx", "Les.\nLes\nAll rights  reserved.\n All rights reserved. \n\n \t\ny"]
    texts += [page + "\n" + page[:-1] + "\n" + page[:15], page + "x\n" + page[:10] + "yz" + page[10:] + "\n" + " ".join(page) + "\n" + page[:15]]
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(documents(spark, texts)).collect()}
    assert got == _kept_lines(list(enumerate(texts)))
    assert got[1] == "Les\nAll rights  reserved.\n\n \t\ny" and got[2] == page + "\n" + page[:15] and " ".join(page) in got[3]


def test_line_dedup_on_awkward_rows(spark, rows):
    docs = awkward(spark)
    done = lines.without_repeated_lines(docs)
    assert done.columns == docs.columns
    got = rows(done, "doc_id", "text")
    assert got.count((1, "")) == 2 and (0, BASE) in got and (5, LONG) in got and (6, "") in got and (2, None) in got
    assert (4, " \t\n") in got and (None, "") in got and (None, None) in got and len(got) == 12
    assert lines.without_repeated_lines(docs.limit(0)).count() == 0


# -- packing -----------------------------------------------------------------------


def _check_packing(got, texts):
    """``texts``: doc_id -> text, distinct ids."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
    assert set(of) == set(texts)
    for i, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(of[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(ids) and all(r.length == 1024 for r in pieces[1:])
        assert len(pieces) == -(-len(ids) // 1024)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    return len(bins), sum(r.length for r in got)


def test_packing_of_the_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sequences, tokens = _check_packing(queries.op7_best_fit_packing(spark, SMALL).collect(), texts)
    assert sequences <= 1.02 * tokens / 1024 + 1


def test_packing_on_awkward_rows(spark):
    odd = ["  two  spaces ", " \n x", "a <|endoftext|> b", "tab\tand\x0bmore space 　wide", "x" * 300 + " y", "\x1c sep \x85 nel", "é ü 漢字 emoji 😀 ok"]
    texts = dict(enumerate([None, "", LONG, *odd]))
    _check_packing(packing.pack(documents(spark, list(texts.values())), TOKENIZER).collect(), texts)
    got = packing.pack(awkward(spark), TOKENIZER).collect()
    assert len([r for r in got if r.doc_id == 1]) == 2 and len([r for r in got if r.doc_id is None]) == 2
    assert packing.pack(awkward(spark).limit(0), TOKENIZER).count() == 0


def test_a_worker_encodes_without_threads_of_the_tokenizer():
    code = f"""
import os
from shelfmark.llm import packing
before = len(os.listdir("/proc/self/task"))
packing._encoder({TOKENIZER!r}).encode([f"text {{i}} of w{{i}}  many" for i in range(5000)])
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": os.pathsep.join(sys.path), "RAYON_NUM_THREADS": "4"}
    assert subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout == "0\n"


def test_rows_with_spaces_inside_a_part_are_cut_by_place():
    encoder, tokenizer = packing.PartIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    parts = ["plain", "in  side", "Ġ", "x y", "漢 \u3000字", "end"]
    wanted = [np.array(tokenizer.encode(" " + p, add_special_tokens=False).ids, "<u4").tobytes() for p in parts]
    assert encoder._encode(parts) == wanted


class CountingTokenizer:
    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode(self, text, **options):
        self.chars += len(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def _plain_ids(texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_a_word_is_encoded_once_whatever_signs_follow_it():
    words = [f"{a}{b}straße" for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [" ".join(["start", *(w + s for w in words)]) for s in ("", ",", ".", "!?", "'s", "-x", "2", ".\nNext", "\nNext.")]
    encoder = packing.PartIds(TOKENIZER)
    encoder.tokenizer = counting = CountingTokenizer(encoder.tokenizer)
    assert encoder.encode(texts) == _plain_ids(texts)
    assert counting.chars < 2 * sum(len(w) + 1 for w in words)


def test_ids_of_texts_of_signs_and_white_space():
    draw = random.Random(5)
    letters = ["ab \n.'s", "aéß×÷ªº1., ’\n", "ab \t\n\r\x1c\x1f\x85\xa0", "漢\u3000\u180e\ufeffe\u0301,\nЖ²½٣Ⅷ ", "\x00a.b \n"]
    texts = ["".join(draw.choices(draw.choice(letters), k=draw.randrange(40))) for _ in range(3000)]
    assert packing.PartIds(TOKENIZER).encode(texts) == _plain_ids(texts)


def test_blocks_hold_all_texts_in_order(monkeypatch):
    monkeypatch.setattr(packing, "_BLOCK_CHARS", 10)
    batches = [pd.Series(["abc", None, "", "x" * 25], dtype=object), pd.Series([], dtype=object), pd.Series(["d", "efg"], dtype=object)]
    assert list(packing._blocks(iter(batches))) == [["abc", None, "", "x" * 25], ["d", "efg"]]


def test_workers_keep_no_words_after_their_tasks(spark):
    docs = documents(spark, [" ".join(f"w{i}x{k}" for k in range(500)) for i in range(8)])

    def held(batches):
        for _ in batches:
            hashes = sum(len(x) for x in gc.get_objects() if type(x).__name__ == "WordHashes")
            yield pd.DataFrame({"hashes": [hashes], "parts": [len(packing._encoder(TOKENIZER).known)]})

    minhash.near_duplicates(docs, minhash.Banding(words=3, percent=85)).collect()
    packing.pack(docs, TOKENIZER).collect()
    got = spark.range(0, 64, 1, 16).mapInPandas(held, "hashes long, parts long").collect()
    assert {tuple(r) for r in got} == {(0, 0)}


def test_packed_sequences_hold_the_ids(spark):
    docs = documents(spark, [BASE, "", LONG])
    placed = packing.pack(docs, TOKENIZER).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    whole = packing.sequences(docs, TOKENIZER).collect()
    assert sorted(r.n for r in placed) == sorted(r.length for r in whole) and all(len(r.ids) == r.length for r in whole)


def test_plan_uses_every_piece_once():
    draw = random.Random(3)
    for _ in range(20):
        counts = {draw.randrange(1, 65): draw.randrange(1, 50) for _ in range(20)}
        used, total = Counter(), 0
        for pattern, times in packing.plan(counts, 64):
            assert sum(pattern) <= 64 and times > 0
            for x in pattern:
                used[x] += times
            total += times
        assert used == Counter(counts)
        need = max(sum(k * n for k, n in counts.items()) / 64, sum(n for k, n in counts.items() if k > 32))
        assert total <= 1.25 * need + 2
    assert sum(n for _, n in packing.plan({500: 10, 524: 6, 262: 8}, 1024)) == 10  # 6 pairs, 4 pairs and halves


# -- mixing ------------------------------------------------------------------------


def _targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in above})


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_mixing_meets_its_targets(spark, folder):
    got = queries.op9_source_mixing(spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or "")) and 0 <= r.taken <= 3 * r.size
        sizes[docs[r.doc_id].source] += r.size
        taken[docs[r.doc_id].source] += r.taken
    want = _targets(sizes)
    assert len(got) == len(docs)
    for r in got:
        source = docs[r.doc_id].source
        assert r.source_size == sizes[source] and math.isclose(r.target, want[source], rel_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = queries.op9_source_mixing(spark, folder).collect()
    assert sorted(again) == sorted(got)


def test_mixing_of_small_and_hot_sources(spark):
    texts = [BASE] * 200 + ["a b c", "d e", "", None, LONG, "only one here"]
    sources = ["hot"] * 200 + ["tiny", "tiny", "tiny", "nulls", None, "Ärger"]
    docs = documents(spark, texts, sources)
    got = mixing.mixed_sizes(docs).collect()
    size, taken = Counter(), Counter()
    for r in got:
        size[sources[r.doc_id]] += r.size
        taken[sources[r.doc_id]] += r.taken
        assert r.taken <= 3 * r.size
    want = _targets(size)
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] = len(r.text.split())
    assert {r.doc_id: r.taken for r in got if r.taken} == dict(words)


def test_mixing_on_awkward_rows(spark):
    assert mixing.mixed_sizes(awkward(spark)).count() == 12
    empty = awkward(spark).limit(0)
    assert mixing.mixed_sizes(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = documents(spark, ["", None])
    assert [r.taken for r in mixing.mixed_sizes(blank).collect()] == [0, 0] and mixing.mixed_documents(blank).count() == 0


def test_permutation_has_an_inverse():
    for size in (1, 2, 3, 17, 1000):
        index, n, key = np.arange(size), np.full(size, size), np.full(size, -12345)
        with np.errstate(over="ignore"):
            there = mixing.permuted(index, n, key)
            assert sorted(there) == list(range(size))
            assert (mixing.permuted(there, n, key, True) == index).all()


def test_mixing_agrees_whatever_the_splits(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(i % 50)) for i in range(300)] + [BASE] * 20
    docs = documents(spark, texts, [("a", "b", None)[i % 3] for i in range(320)])
    first = {r.doc_id: r.taken for r in mixing.mixed_sizes(docs.repartition(1)).collect()}
    turned = docs.orderBy(F.desc("doc_id")).repartition(7)
    assert {r.doc_id: r.taken for r in mixing.mixed_sizes(turned).collect()} == first
    assert {r.doc_id: len(r.text.split()) for r in mixing.mixed_documents(turned).collect()} == {i: n for i, n in first.items() if n}


def test_median_of_counted_heights():
    for values in ([3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 2.0], [2.5] * 9 + [1.0] * 4 + [9.0]):
        kinds, counts = np.unique(values, return_counts=True)
        assert toxicity._median(kinds, counts.astype(float)) == np.median(values)
    assert toxicity._median(np.zeros(0), np.zeros(0)) == 0.0
