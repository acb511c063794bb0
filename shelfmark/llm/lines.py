"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Lines are sequences of words, or of characters where a longer line has no space.  Two lines are duplicates if they are
equal, or if both have units enough and one unit inserted, removed or replaced makes them equal.  Then leaving out one unit
of either, or of the longer one, gives equal variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise

#: Lines of fewer words go as copies only: one word is too large a part of them.
MIN_WORDS = 5
#: The same for lines without a space, whose units are characters.
MIN_CHARS = 20
#: What a blank line consists of; blank lines are never removed.
_BLANKS = " \t\r\x0b\x0c"
#: Documents that have something to fetch are marked by a hash of so many values; that bounds what is broadcast.
MARKS = 2**20
_LAST = 2**63 - 1


def _units(body: Column) -> Column:
    """Words between spaces; of a longer line without any, characters, marked so that none is equal to a word."""
    characters = F.transform(F.regexp_extract_all(body, F.lit("."), F.lit(0)), lambda c: F.concat(F.lit("\n"), c))
    return F.when(F.contains(body, F.lit(" ")) | (F.length(body) < MIN_CHARS), F.split(body, " ")).otherwise(characters)


def _hashes(body: Column) -> tuple[Column, Column]:
    return F.xxhash64(body), F.xxhash64(F.lit(7), body)


def _at(ident: str) -> Column:
    """The document's place: its ident, null last."""
    return F.coalesce(F.col(ident).cast("long"), F.lit(_LAST))


def _mark(at: Column | str) -> Column:
    return F.pmod(F.xxhash64(at), F.lit(MARKS)).cast("int")


def _line_rows(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """``(at, body, no, line)`` of every line that isn't blank: place of the document, hash of its text, number and text of the line."""
    lines = docs.select(_at(ident).alias("at"), F.xxhash64(text).alias("body"), F.posexplode(F.split(text, "\n", -1)).alias("no", "line"))
    return lines.where(F.trim("line", F.lit(_BLANKS)) != "").withColumn("line", F.trim("line"))


def _end_keys() -> Column:
    """Keys of which lines one word apart share one: their first and their last words.

    At most half of the words, an even number of them, make a key.  One edit spares either end, and lines of one word
    more or less have the same number or, where it changes, both numbers.
    """

    def keys(length: Column) -> Column:
        count = (F.floor(length / 4) * 2).cast("int")
        head = F.xxhash64(F.lit("head"), F.slice("words", 1, count))
        tail = F.xxhash64(F.lit("tail"), F.slice("words", -count, count))
        return F.array(head, tail)

    n = F.size("words")
    return F.array_distinct(F.concat(keys(n), keys(n - 1)))


def _one_word_apart(a: Column, b: Column) -> Column:
    """Edit distance of at most one word between the arrays ``a`` and ``b``."""
    changed = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda z: z))
    longer, shorter = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    low = F.size(shorter)
    first = F.array_position(F.zip_with(F.slice(longer, 1, low), shorter, lambda x, y: x != y), True).cast("int")
    rest = F.greatest(low - first + 1, F.lit(0))
    tails = F.slice(shorter, F.greatest(first, F.lit(1)), rest) == F.slice(longer, first + 1, rest)
    return (
        F.when(F.size(a) == F.size(b), changed <= 1)
        .when(F.abs(F.size(a) - F.size(b)) == 1, (first == 0) | tails)
        .otherwise(False)
    )


def repeated_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(at, body, dropped)``: the numbers of the lines that go, for each document that loses one.

    A line that isn't blank goes if an equal one, but for spaces around it, stands earlier, in the order of ``(ident, line
    number)``; null idents come last.  One of at least ``MIN_WORDS`` words (what single spaces separate), or of
    ``MIN_CHARS`` characters and no space, goes also if such a line that is one unit apart stands earlier.  ``at`` is the
    ident, or the largest number if it is null, and ``body`` the hash of the text, which tells rows of one ident apart.
    """
    lines = _line_rows(docs, ident, text).withColumn("words", _units(F.col("line")))
    h1, h2 = _hashes(F.col("line"))
    keys = F.when(F.size("words") >= MIN_WORDS, _end_keys()).otherwise(F.array().cast("array<bigint>"))
    lines = materialise(lines.select("at", "body", "no", h1.alias("h1"), h2.alias("h2"), keys.alias("keys")), "lines")
    distinct = lines.groupBy("h1", "h2").agg(F.min(F.struct("at", "no")).alias("first"), F.first("keys").alias("keys"))
    distinct = materialise(distinct.select("h1", "h2", "first.at", "first.no", "keys"), "distinct-lines")
    # Without loss: a line whose ends no other line has is one word apart from none.
    shared = distinct.select("h1", F.explode("keys").alias("key")).groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    shared = materialise(shared.where("a < b").select("key"), "shared-ends")
    suspects = distinct.select("h1", "h2", "at", "no", F.explode("keys").alias("key")).join(shared, "key")
    suspects = materialise(suspects.select("h1", "h2", "at", "no").distinct(), "suspects")
    # Their words, from the place where each stands first; only documents that may hold one are shuffled.
    marks = F.broadcast(suspects.select(_mark("at").alias("_mark")).distinct())  # at most MARKS numbers
    holders = docs.join(marks, _mark(_at(ident)) == F.col("_mark"), "left_semi")
    texts = _line_rows(holders, ident, text).select("at", "no", "line").join(suspects, ["at", "no"])
    texts = texts.where((h1 == F.col("h1")) & (h2 == F.col("h2"))).withColumn("words", _units(F.col("line")))
    texts = texts.select("h1", "h2", F.struct("at", "no").alias("first"), "words").dropDuplicates(["h1", "h2"])
    texts = materialise(texts, "suspect-words")

    # A line's hash is the XOR of hashes of its words and their places, so running hashes with the places as they are
    # and one lower give the hash without word i for every i.  Number 0 is the whole line.
    def running(lower: int) -> Column:
        def step(sofar: Column, j: Column) -> Column:
            return F.concat(sofar, F.array(F.element_at(sofar, -1).bitwiseXOR(F.xxhash64(j - lower, F.element_at("words", j)))))

        return F.aggregate(F.sequence(F.lit(1), F.size("words")), F.array(F.lit(0).cast("long")), step)

    hashed = texts.withColumn("before", running(0)).withColumn("after", running(1))
    left_out = F.transform(
        F.sequence(F.lit(0), F.size("words")),
        lambda i: F.struct(
            i.alias("i"),
            F.when(i == 0, F.element_at("before", -1))
            .otherwise(F.get("before", i - 1).bitwiseXOR(F.get("after", i)).bitwiseXOR(F.element_at("after", -1)))
            .alias("key"),
        ),
    )
    variants = hashed.select("h1", "h2", "first", F.explode(left_out).alias("v")).select("h1", "h2", "first", "v.i", "v.key")
    variants = materialise(variants, "variants")
    # Equal variants meet by key; of each kind only the earliest can matter, so no pairs are built.
    same = variants.groupBy("key", "i").agg(F.min("first").alias("early"), F.max("first").alias("late"))
    same = materialise(same, "variant-groups")
    kinds = same.groupBy("key").agg(
        F.min(F.when(F.col("i") == 0, F.col("early"))).alias("whole_early"), F.min(F.when(F.col("i") > 0, F.col("early"))).alias("part_early")
    )
    kinds = materialise(kinds.where("whole_early is not null and part_early is not null"), "variant-kinds")
    one = variants.where("i > 0").join(same.where("i > 0 and early < late").select("key", "i", "early"), ["key", "i"]).where("early < first")
    two = variants.join(kinds, "key").withColumn("early", F.expr("IF(i = 0, part_early, whole_early)")).where("early < first")
    found = one.select("h1", "h2", "early").unionByName(two.select("h1", "h2", "early")).groupBy("h1", "h2").agg(F.min("early").alias("early"))
    # The edit distance itself confirms what the hashed keys say.
    partner = texts.select(F.col("first").alias("early"), F.col("words").alias("early_words"))
    near = found.join(texts.select("h1", "h2", "words"), ["h1", "h2"]).join(partner, "early")
    near = near.where(_one_word_apart(F.col("words"), F.col("early_words"))).select("h1", "h2").distinct()
    verdict = distinct.select("h1", "h2", F.struct("at", "no").alias("first")).join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    verdict = materialise(verdict.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "line-verdicts")
    gone = lines.select("at", "body", "no", "h1", "h2").join(verdict, ["h1", "h2"]).where(F.col("near") | (F.struct("at", "no") > F.col("first")))
    return gone.groupBy("at", "body").agg(F.sort_array(F.collect_set("no")).alias("dropped"))


def without_repeated_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; texts lose their repeated lines.

    Documents stay even if no line does; their text is then empty.  Null texts stay null, empty ones and blank lines as
    they are.  Rows that repeat a document share its positions, so both keep the same lines.
    """
    dropped = repeated_lines(docs, ident, text)
    dropped = materialise(dropped.select(F.col("at").alias("_at"), F.col("body").alias("_body"), F.col("dropped").alias("_dropped")), "dropped-lines")
    marks = F.broadcast(dropped.select(_mark("_at").alias("_mark")).distinct())  # at most MARKS numbers
    marked = _mark(_at(ident)) == F.col("_mark")
    untouched = docs.join(marks, marked, "left_anti")
    fits = (_at(ident) == F.col("_at")) & (F.xxhash64(text) == F.col("_body"))
    joined = docs.join(marks, marked, "left_semi").join(dropped, fits, "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, k: ~F.array_contains("_dropped", k)), "\n")
    shorter = F.when(F.col("_dropped").isNull(), F.col(text)).otherwise(kept)
    return joined.withColumn(text, shorter).select(*docs.columns).unionByName(untouched.select(*docs.columns))
