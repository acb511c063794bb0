"""Parsing of list and dict literals that arrive as text.

Texts are written as Python literals.  Most read as JSON as they stand.  The others are rewritten to JSON by a chain of
expressions and never evaluated: strings, numbers and words are rewritten token by token, then brackets are resolved from
the innermost outwards, one level of nesting at a time, since only a whole pair tells whether ``(x)`` is a tuple or ``{x}``
a set.  While that goes on, noncharacters stand for whatever must not be taken for an open bracket, comma or colon.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Noncharacters of Unicode: no text may use them, so a text that does is no literal here.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"  # around a string
_STRUCTURE = "()[]{},:"
_IN_STRING = "\ufdd2\ufdd3\ufdd4\ufdd5\ufdd6\ufdd7\ufdd8\ufdd9"  # the same signs inside strings
_DONE = "\ufdda\ufddb\ufddc\ufddd\ufdde\ufddf\ufde0\ufde1"  # the same signs of resolved pairs
#: Makes any JSON invalid.
_NO = "!"

# Possessive loops: no backtracking and no recursion, however long a string is.
_STRING = (
    r"""[rRuU]?(?:'''(?:[^'\\]|\\(?s:.)|'(?!''))*+'''|\"""(?:[^"\\]|\\(?s:.)|"(?!""))*+\"""|"""
    r"""'[^'\\\n]*+(?:\\(?s:.)[^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+")"""
)
_NUMBER = (
    r"(?:[+-]\s*)?(?:0[xX][0-9a-fA-F_]++|0[oO][0-7_]++|0[bB][01_]++|[0-9][0-9_]*+(?:\.[0-9_]*+)?(?:[eE][+-]?[0-9_]++)?|\.[0-9][0-9_]*+(?:[eE][+-]?[0-9_]++)?)"
)
_TOKEN = rf"{_STRING}|{_NUMBER}|[A-Za-z_][A-Za-z_0-9]*+|\s++|(?s:.)"
_PIECE = r"\\(?:[0-7]{1,3}|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|(?s:.))|[^\\]++"
_BRACKETS = r"[()\[\]{}]"
_SEGMENT = r"[(\[{][^()\[\]{}]*+[)\]}]|[^()\[\]{}]++|[()\[\]{}]"

# Escapes of one letter, and words, with what they stand for.
_ESCAPES = {"\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "\n": ""}
_WORDS = {"None": "null", "True": "true", "False": "false", "null": "null", "true": "true", "false": "false", "set": "set"}


def _blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it; inside lambdas Spark shares nothing."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _one_of(value: Column, choices: dict[str, str], otherwise: Column) -> Column:
    out = None
    for name, stands_for in choices.items():
        out = F.when(value == name, F.lit(stands_for)) if out is None else out.when(value == name, F.lit(stands_for))
    return out.otherwise(otherwise)


def _character(digits: Column, base: int) -> Column:
    return F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32")


def _piece_value(piece: Column) -> Column:
    """What an escape, or a run without one, stands for; null for an escape that isn't complete, or names a character."""
    sign = F.substring(piece, 2, 1)
    known = F.length(piece) > 2
    escaped = (
        F.when(sign.rlike("[0-7]"), _character(F.substring(piece, 2, 3), 8))
        .when(sign.isin("x", "u", "U") & known, _character(F.substring(piece, 3, 8), 16))
        .when(sign.isin("x", "u", "U", "N"), F.lit(None))
        .otherwise(_one_of(sign, _ESCAPES, piece))
    )
    return F.when(~F.startswith(piece, F.lit("\\")), piece).otherwise(escaped)


def _string_to_json(token: Column) -> Column:
    plain = F.regexp_replace(token, "^[rRuU]", "")
    return _let(_let(plain, _body), lambda body: _let(_string_value(token, body), _quoted))


def _body(plain: Column) -> Column:
    triple = plain.rlike("(?s)^('''|\"\"\").*('''|\"\"\")$") & (F.length(plain) >= 6)
    return F.when(triple, F.substring(plain, F.lit(4), F.length(plain) - 6)).otherwise(F.substring(plain, F.lit(2), F.length(plain) - 2))


def _string_value(token: Column, body: Column) -> Column:
    pieces = F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0)), _piece_value)
    whole = _let(pieces, lambda values: F.when(~F.exists(values, lambda p: p.isNull()), F.array_join(values, "")))
    return F.when(token.rlike("^[rR]") | ~F.contains(body, F.lit("\\")), body).otherwise(whole)


def _quoted(value: Column) -> Column:
    json = F.to_json(F.struct(value.alias("v")))  # {"v":"…"}
    inside = _let(json, lambda quoted: F.translate(F.substring(quoted, F.lit(7), F.length(quoted) - 8), _STRUCTURE, _IN_STRING))
    return F.when(value.isNull(), F.lit(_NO)).otherwise(F.concat(F.lit(_OPEN), inside, F.lit(_CLOSE)))


def _number_to_json(token: Column) -> Column:
    wrong = token.rlike("__|_(?![0-9a-fA-F])|[.eE+-]_")
    return F.when(wrong, F.lit(_NO)).otherwise(_let(F.regexp_replace(token, r"[\s+_]", ""), _number_value))


def _number_value(plain: Column) -> Column:
    sign = F.when(F.startswith(plain, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(plain, "^-?0[xXoObB]", "")
    whole = None
    for letters, base in (("[xX]", 16), ("[oO]", 8), ("[bB]", 2)):
        found = plain.rlike(f"^-?0{letters}")
        value = F.concat(sign, F.conv(digits, base, 10))
        whole = F.when(found, value) if whole is None else whole.when(found, value)
    # Zeros in front are fine for fractions and for zero itself.
    stripped = F.when(plain.rlike(r"[.eE]|^-?0+$"), F.regexp_replace(plain, r"^(-?)0+(?=[0-9])", "$1")).otherwise(plain)
    decimal = F.regexp_replace(F.regexp_replace(stripped, r"^(-?)\.", "$10."), r"\.(?![0-9])", ".0")
    return whole.otherwise(decimal)


def _token_to_json(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    # One sign is the commonest token and no string, number or word.
    return (
        F.when((F.length(token) == 1) & F.contains(F.lit(_STRUCTURE), first), token)
        .when(token.rlike(f"^{_STRING}$"), _string_to_json(token))
        .when(token.rlike(r"^(?:[+-]\s*)?\.?[0-9]"), _number_to_json(token))
        .when(token.rlike("^[A-Za-z_]"), _one_of(token, _WORDS, F.lit(_NO)))
        .when(token.rlike(r"^\s"), F.lit(" "))
        .otherwise(F.lit(_NO))
    )


def _resolved(segment: Column) -> Column:
    """A pair of brackets without any inside, as JSON in signs that are done; other segments as they are."""
    pair = segment.rlike(r"(?s)^[(\[{].*[)\]}]$")
    inner = F.trim(F.substring(segment, F.lit(2), F.length(segment) - 2))
    out = _let(inner, lambda inside: _let(_without_last_comma(inside), lambda body: _pair_to_json(segment, inside, body)))
    return F.when(pair, F.translate(out, _STRUCTURE, _DONE)).otherwise(segment)


def _without_last_comma(inner: Column) -> Column:
    return F.when(F.endswith(inner, F.lit(",")), F.trim(F.substring(inner, F.lit(1), F.length(inner) - 1))).otherwise(inner)


def _pair_to_json(segment: Column, inner: Column, body: Column) -> Column:
    begin, end = F.substring(segment, 1, 1), F.substring(segment, -1, 1)
    comma_last = F.endswith(inner, F.lit(","))
    comma, colon = F.contains(inner, F.lit(",")), F.contains(inner, F.lit(":"))
    keys = F.regexp_replace(body, rf"(^|,)\s*([^{_OPEN}{_CLOSE},:]+?)\s*:", f"$1{_OPEN}$2{_CLOSE}:")  # numbers as keys
    listed = F.concat(F.lit("["), body, F.lit("]"))
    return (
        F.when(comma_last & (body == ""), F.lit(_NO))
        .when((begin == "{") & (end == "}"), F.when(colon | (body == ""), F.concat(F.lit("{"), keys, F.lit("}"))).otherwise(listed))
        .when(colon, F.lit(_NO))
        .when((begin == "[") & (end == "]"), listed)
        .when((begin == "(") & (end == ")"), F.when(comma | (body == ""), listed).otherwise(body))
        .otherwise(F.lit(_NO))
    )


def literal_to_json(text: Column) -> Column:
    """The JSON of a literal: lists, tuples and sets as arrays, dicts as objects; no valid JSON for anything else.

    Understands strings of all quotes and escapes but named characters, strings side by side, numbers of any base and with
    underscores, commas at the end, and values in brackets.  Bytes and complex numbers have no JSON.
    """
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    flat = F.array_join(F.transform(tokens, _token_to_json), "")
    joined = F.regexp_replace(F.regexp_replace(flat, rf"{_CLOSE} ?{_OPEN}", ""), r"set ?\( ?\)", "[]")
    # The text as a whole may be a tuple without brackets.
    resolved = _let(F.concat(F.lit("("), joined, F.lit(")")), _all_resolved)
    open_again = F.translate(resolved, _IN_STRING + _DONE + _OPEN + _CLOSE, _STRUCTURE + _STRUCTURE + '""')
    return F.when(~text.rlike("[\ufdd0-\ufdef]"), open_again)


def _all_resolved(whole: Column) -> Column:
    depths = F.aggregate(
        F.regexp_extract_all(whole, F.lit(_BRACKETS), F.lit(0)),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, b: F.struct(
            (s["now"] + F.when(b.isin("(", "[", "{"), 1).otherwise(-1)).alias("now"),
            F.greatest(s["most"], s["now"] + F.when(b.isin("(", "[", "{"), 1).otherwise(-1)).alias("most"),
        ),
    )
    levels = F.sequence(F.lit(1), F.greatest(depths["most"], F.lit(1)))
    return F.aggregate(levels, whole, lambda s, _: F.array_join(F.transform(F.regexp_extract_all(s, F.lit(_SEGMENT), F.lit(0)), _resolved), ""))


def _whole(text: Column, ddl: str, **options: str) -> Column:
    """JSON to ``ddl``, and null where anything stands behind the value: inside an object it can't be passed over."""
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {ddl}", options)["v"]


def parse_literal(text: Column, ddl: str) -> Column:
    """Text of a list or dict literal to ``ddl``; null when it is not one.

    The first parse reads the text as JSON.  Only where that fails is the text rewritten, so the common case stays cheap.
    An escaped slash is one sign in JSON and two in a literal, so texts with one are always rewritten.
    """
    filled = _blank_to_null(text)
    direct = F.when(~F.contains(filled, F.lit("\\/")), _whole(filled, ddl))
    return F.coalesce(direct, _whole(literal_to_json(filled), ddl, allowSingleQuotes="false"))


def is_unparsed(text: Column, parsed: Column) -> Column:
    """True for non-empty text that gave no value; ``[]`` is an empty dict too."""
    filled = _blank_to_null(text)
    empty = F.regexp_replace(filled, r"\s", "").isin("[]", "{}", "()", "set()", "None")
    return filled.isNotNull() & ~empty & parsed.isNull()
