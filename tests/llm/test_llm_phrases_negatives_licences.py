"""Collocations, hard negatives and licence notices against brute force, and on awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import awkward, documents
from pyspark.sql import functions as F

from shelfmark.llm import licences, negatives, phrases


def _words(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _collocations(rows, settings):
    """By the definition, from lists of all phrases."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for m in range(1, settings.most_words + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if a >= settings.least and len(p) > 1}
        scored = []
        for p, a in frequent.items():
            inside = [q for q in frequent if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * frequent[q] >= settings.subsumed * a for q in inside):
                continue
            cuts = [(1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            scored.append((score, a, " ".join(p), l, r))
        scored.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, sizes[lang], s) for i, (s, a, p, l, r) in enumerate(scored[: settings.first])]
    return sorted(out)


def _prose(seed, count):
    draw = random.Random(seed)
    words = ["the", "of", "New", "york", "times", "é", " x", "und", "big", "apple"]
    return ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(draw.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("settings", [phrases.Mining(least=3), phrases.Mining(least=2, most_words=4, subsumed=80, first=15, flush=50, chunk=7), phrases.Mining(least=4, most_words=2)])
def test_collocations_equal_brute_force(spark, settings):
    rows = list(zip([None, "en", "und", "fr"] * 15, _prose(4, 60)))
    docs = spark.createDataFrame([(i, t, lang, 1, "p") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n long, phrase string")
    got = sorted(tuple(r) for r in phrases.collocations(docs.repartition(5), settings).collect())
    assert got == _collocations(rows, settings) and got


def test_counts_do_not_depend_on_the_size_of_a_bitmap(spark):
    docs = documents(spark, _prose(8, 80))
    full = phrases.collocations(docs, phrases.Mining(least=3)).collect()
    crowded = phrases.collocations(docs, phrases.Mining(least=3, most_bits=64, bits=1)).collect()
    assert sorted(map(tuple, full)) == sorted(map(tuple, crowded))


def test_marks_with_few_bits_let_everything_true_pass():
    words = np.zeros(1, np.uint64)
    hashes = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for h in hashes[:20]:
        words[0] |= np.uint64(1) << (h & np.uint64(63))
    assert phrases.Marks(words).has(hashes[:20]).all()


def test_large_counts_are_exact(spark):
    a = 10**14 + 7
    row = spark.range(1).select(F.expr(f"cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) * cast(1000000 as decimal(7,0)) div (cast({a} as decimal(15,0)) * cast({a + 1} as decimal(15,0)))")).first()
    assert row[0] == 1_000_000 * a * a // (a * (a + 1))


def test_collocations_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    settings = phrases.Mining(least=3)
    assert sorted(map(tuple, phrases.collocations(docs, settings).collect())) == _collocations(rows, settings)
    assert phrases.collocations(docs.limit(0)).collect() == []


def _negatives(rows, settings):
    """Rows of ``(ident, label, integers)``."""
    out = []
    for anchor, label, q in rows:
        if anchor % 50:
            continue
        scored = sorted(((sum(a * b for a, b in zip(q, x)), i, other) for i, other, x in rows if i != anchor and len(x) == len(q)), key=lambda s: (-s[0], s[1]))
        for p, i, _ in [s for s in scored if s[2] == label][: settings.positives]:
            fits = [s for s in scored if s[2] != label and settings.low * p <= 100 * s[0] <= settings.high * p]
            out += [(anchor, i, k + 1, j, p, s) for k, (s, j, _) in enumerate(fits[: settings.negatives])]
    return sorted(out)


@pytest.mark.parametrize("settings", [negatives.Mining(), negatives.Mining(block=37, anchors=3, share=2, step=1), negatives.Mining(block=64, low=-200, high=120, positives=2, negatives=7)])
def test_hard_negatives_equal_brute_force(spark, settings):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(4, 12))
    rows = []
    for i in range(700):
        x = centres[i % 4] + draw.normal(size=12) * 0.7 if i % 9 else np.round(draw.normal(size=12))
        rows.append((i, None if i % 31 == 5 else int(i % 4), [float(v) for v in x]))
    rows += [(800 + 50 * k, k % 2, [0.5 * k] * 5) for k in range(8)] + [(1400, 3, []), (1450, 3, []), (1401, 2, [])]
    rows += [(2001, 1, None), (2002, 1, [1.0] * 11 + [None]), (2003, 1, [1.0] * 11 + [math.inf]), (None, 1, [1.0] * 12), (50, 0, [9.0] * 12), (100, 0, rows[100][2])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, ident int, vec string")
    fine = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        row = (label, [256 * v for v in x])
        fine[i] = min(fine.get(i, row), row)
    plain = [(i, label, [math.floor(v) for v in x]) for i, (label, x) in fine.items()]
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame, settings=settings).collect())
    assert got == _negatives(plain, settings) and got


def test_scan_prunes_and_stays_exact():
    draw = np.random.default_rng(1)
    x = np.floor(256 * draw.normal(size=(3000, 64)) * np.linspace(3, 0.01, 64))
    block = negatives.Block(np.arange(3000), np.zeros(3000), np.ascontiguousarray(x.T).tobytes(), x.min(axis=0), x.max(axis=0))
    scores = x @ x[7]
    found, read = negatives.first_rows(block, x[7], np.arange(3000), 5, 4)
    best = sorted(range(3000), key=lambda i: (-scores[i], i))[:5]
    assert found == [(int(scores[i]), i) for i in best] and read < 0.7 * x.size
    window = (int(scores.max()) // 3, int(scores.max()) // 2)
    (near,), read = negatives.window_rows(block, x[7], np.arange(3000), [window], 3, 4)
    inside = sorted((i for i in range(3000) if window[0] <= scores[i] <= window[1]), key=lambda i: (-scores[i], i))[:3]
    assert near == [(int(scores[i]), i) for i in inside] and read < x.size


def test_huge_numbers_are_added_exactly(spark):
    big = float(2**40)
    rows = [(0, 1, [big, 1.0]), (1, 1, [1.0, big]), (2, 2, [0.7, 0.7]), (3, 1, [1e300, 1.0]), (4, 2, [big, -1.0]), (5, 2, [1e308, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    plain = [(i, label, [math.floor(256 * v) for v in x]) for i, label, x in rows if i != 5]
    clipped = [tuple(min(v, 2**63 - 1) for v in r) for r in _negatives([r for r in plain if r[0] != 3], negatives.Mining())]
    got = [tuple(r) for r in negatives.hard_negatives(frame.where("vec_id <> 3")).collect()]
    assert sorted(got) == clipped
    assert all(r.positive_score <= 2**63 - 1 for r in negatives.hard_negatives(frame).collect())


def test_negatives_of_empty_tables(spark):
    frame = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(frame).collect() == []
    assert negatives.hard_negatives(frame.limit(0)).collect() == []


WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def _licences(text):
    words = _words(text, WORD)
    places = [(i, label) for phrase, label in licences.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    base = {label for _, label in places}
    labels, score = set(base), 1.0 if base else 0.0
    lines = [_words(line, WORD) for line in (text or "").split("\n")]
    paragraphs, now = [], []
    for line in [*lines, []]:
        now = now + line if line else (paragraphs.append(now) or [])
    for label, template in licences.TEMPLATES:
        own = licences.template_words(template)
        for block in paragraphs if len(own) >= licences.WIDE else lines:
            both = len(set(own) & set(block))
            if both >= licences.needed(len(own)):
                labels.add(label)
                score = max(score, both / len(own))
    firsts = [i for i, _ in places]
    return (len(words), len(places), min(firsts, default=None), max(firsts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def _licence_texts():
    draw = random.Random(6)
    texts = [None, "", " \n ", "CC BY CC BY cc-by", "all rights\nreserved All Rights Reserved", "cc\x00by", "ccby", "general public licenses", "Ünder CC BY"]
    for _, template in licences.TEMPLATES:
        words = template.split()
        texts += [template, f"Before it.\n{template.upper()}!\nafter", "\n".join(words), " ".join(words[:-1]), " ".join(w for w in words if draw.random() < 0.9)]
        texts.append("\n".join([" ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :]), "", "other words"]))
    return texts + ["the license of the work " * 5000 + "Released under the MIT License."]


def test_licences_equal_brute_force(spark):
    texts = _licence_texts()
    docs = spark.createDataFrame([(i % 40, t, "s", "r") for i, t in enumerate(texts)] * 2, "doc_id long, text string, label string, row string")
    got = sorted((tuple(r) for r in licences.scan_licences(docs.repartition(4)).collect()), key=repr)
    assert got == sorted([(i % 40, *_licences(t)) for i, t in enumerate(texts)] * 2, key=repr)
    assert len({r[6] for r in got}) > 10


def test_licences_with_other_templates_and_thresholds(spark):
    templates = [("one", "alpha"), ("two", "alpha beta"), ("many", " ".join(f"w{i}" for i in range(30))), ("none", "...")]
    docs = documents(spark, ["alpha", "beta alpha", "w1\n" + " ".join(f"w{i}" for i in range(2, 17)), "gamma"])
    got = {r.doc_id: (r.labels, r.score) for r in licences.scan_licences(docs, templates, {}, 50).collect()}
    assert got == {0: ("one,two", 1.0), 1: ("one,two", 1.0), 2: ("many", 16 / 30), 3: ("", 0.0)}
    assert {r.labels for r in licences.scan_licences(docs, [], {}).collect()} == {""}


def test_licences_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    got = sorted((tuple(r) for r in licences.scan_licences(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, *_licences(r.text)) for r in docs.collect()), key=repr)
    assert licences.scan_licences(docs.limit(0)).collect() == []


def test_licence_scan_runs_no_python(spark):
    plan = licences.scan_licences(documents(spark, ["Released under the MIT License."]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
