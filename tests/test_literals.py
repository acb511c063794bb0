"""Literals rewritten to JSON against a safe reader of literals."""

import ast
import json
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import literals
from shelfmark.functions.literals import is_unparsed, literal_to_json, parse_literal
from shelfmark.session import spread

TEXTS = ["", "a", "it's", 'say "so"', "a, b: (c) [d] {e}", "tab\tline\nend", "back\\slash", "é ü 中 😀", "\x07\x1f", "a/b", "None", "x" * 50]


def _string(draw, value):
    """One of the many spellings of a string."""
    quote = draw.choice(["'", '"', "'''", '"""'])
    out = []
    for c in value:
        code = ord(c)
        ways = [rf"\U{code:08x}"]
        ways += [rf"\u{code:04x}"] if code < 0x10000 else []
        ways += [rf"\x{code:02x}"] if code < 256 else []
        ways += [rf"\{code:03o}"] if code < 256 else []
        if c.isprintable() and c not in "\\'\"":
            ways += [c] * 12
        elif c in "\\'\"":
            ways += ["\\" + c] * 4
        elif c == "\n":
            ways += [r"\n", "\\\n\\n"]
        elif c == "\t":
            ways += [r"\t"]
        out.append(draw.choice(ways))
    body = "".join(out)
    if "\\" not in value and quote not in value and not value.endswith(quote[0]) and value.isprintable() and draw.random() < 0.2:
        return f"{draw.choice('rR')}{quote}{value}{quote}"
    cut = draw.randrange(len(out) + 1)
    if draw.random() < 0.3:  # two strings side by side
        return f"{quote}{''.join(out[:cut])}{quote}{draw.choice([' ', '  '])}'{''.join(out[cut:])}'"
    return f"{draw.choice(['', '', 'u'])}{quote}{body}{quote}"


def _literal(draw, depth):
    kind = draw.randrange(8 if depth else 4)
    gap = lambda: draw.choice(["", " ", "\n"])
    if kind == 0:
        return draw.choice(["None", "True", "False"])
    if kind == 1:
        return draw.choice(["0", "7", "-12", "+5", "1_000", "0x1F", "0o17", "0b101", "00", "- 3", "1.5", "-.5", "2.", "1e3", "1_0.5e-1_0", "012.5"])
    if kind < 4:
        return _string(draw, draw.choice(TEXTS))
    count = draw.randrange(4)
    items = [_literal(draw, depth - 1) for _ in range(count)]
    end = f"{gap()},{gap()}" if items and draw.random() < 0.4 else gap()
    if kind == 4:
        return f"[{gap()}{f'{gap()},{gap()}'.join(items)}{end}]"
    if kind == 5:
        return "()" if not items else f"({gap()}{','.join(items)}{end})"
    if kind == 6:
        keys = dict.fromkeys(_string(draw, f"k{i}") if draw.random() < 0.8 else str(i) for i in range(count))
        return "{" + ", ".join(f"{k}{gap()}:{gap()}{v}" for k, v in zip(keys, items)) + end.replace(",", "," if keys else "") + "}"
    numbers = [str(i) for i in range(max(count, 1))]
    return "{" + ", ".join(numbers) + draw.choice(["", ","]) + "}"


def _plain(value):
    """A literal's value as JSON has it."""
    if isinstance(value, dict):
        return {k if isinstance(k, str) else json.dumps(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [_plain(v) for v in (sorted(value) if isinstance(value, set) else value)]
    return value


def test_equal_to_a_safe_reader_on_generated_texts(spark):
    draw = random.Random(5)
    texts = []
    while len(texts) < 1000:
        text = _literal(draw, 4)
        try:
            texts.append((len(texts), text, json.dumps(_plain(ast.literal_eval(text)), sort_keys=True)))
        except (ValueError, SyntaxError) as error:
            raise AssertionError(text) from error
    frame = spark.createDataFrame(texts, "id int, text string, want string")
    for row in frame.withColumn("got", literal_to_json(F.col("text"))).collect():
        assert json.dumps(json.loads(row.got), sort_keys=True) == row.want, (row.text, row.got)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (r"['Foo\xa0Bar']", ["Foo\xa0Bar"]),
        ("('a', 'b')", ["a", "b"]),
        ("['x',]", ["x"]),
        ("['a' 'b', 'c']", ["ab", "c"]),
        ("{'a', 'b'}", ["a", "b"]),
        ("'a', 'b'", ["a", "b"]),
        (r"['a\/b']", [r"a\/b"]),
        ("[r'a\\d', u'é']", ["a\\d", "é"]),
        ("set()", []),
        (f"['{'long ' * 20_000}', 'x',]", ["long " * 20_000, "x"]),
    ],
)
def test_parse_literal_forms(spark, text, want):
    row = spark.createDataFrame([(text,)], "text string").select(parse_literal(F.col("text"), "array<string>").alias("v")).first()
    assert row.v == want


def test_deep_nesting(spark):
    text = "(" * 40 + "1," + "),"[::-1][1:] * 0 + ")" * 40
    row = spark.createDataFrame([(text,)], "text string").select(literal_to_json(F.col("text")).alias("v")).first()
    assert json.loads(row.v) == _plain(ast.literal_eval(text))


@pytest.mark.parametrize(
    "text",
    ["[a]", "['a'", "['a')", "[1 2]", "(,)", "{1: 2, 3}", "f('x')", "__import__('os')", "[1__0]", "['a' + 'b']", "[b'x']", "[1j]", r"['\xg1']", r"['\N{DASH}']", "['a']]", "[,1]", "['a\nb']", "[\ufdd0]", "(1:2)"],
)
def test_only_non_literals_stay_unread(spark, text):
    frame = spark.createDataFrame([(text,)], "text string").withColumn("v", parse_literal(F.col("text"), "array<string>"))
    assert frame.select(is_unparsed(F.col("text"), F.col("v")).alias("bad"), "v").first() == (True, None)


def test_a_string_is_cut_into_pieces_once(spark):
    """Inside lambdas Spark computes a value again wherever it is named."""
    plan = spark.range(1).select(literals.literal_to_json(F.col("id").cast("string")).alias("json"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(literals._PIECE) == 1


def test_spread_rows(spark):
    rows = spark.range(1000).coalesce(1)
    dealt = spread(rows)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 3 * spark.sparkContext.defaultParallelism and max(sizes) < 1000 / 2 and sum(sizes) == 1000
