"""Canonical result rows and comparison of several results of one query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.scalars import round_half_up
from shelfmark.operators.digests import comparable, differing_rows, row_hashes
from shelfmark.operators.ordering import GROUP_ROWS, with_positions
from shelfmark.session import BROADCAST_ROWS, materialise

# Largest difference at which two numbers still count as equal.
TOLERANCE = 0.01

# White space at either end, as text trimming understands it.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", F.lit("")).otherwise(fraction))


def _canonical(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.BooleanType, T.IntegralType)):
        return c.cast("bigint")
    if isinstance(kind, (T.FractionalType,)):
        return round_half_up(c.cast("double"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(kind, T.StringType):
        return F.regexp_replace(c, _EDGES, "")
    return c


def canonical_rows(df: DataFrame) -> DataFrame:
    """Lower-case names, booleans as 0/1, numbers to two decimals, ISO times, trimmed text."""
    return df.select(*[_canonical(f.name, f.dataType).alias(f.name.lower()) for f in df.schema])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def row_counts(results: Mapping[str, DataFrame]) -> DataFrame:
    """(source, row_count) over any number of frames."""
    return _union(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(s).alias("source"), "row_count") for s, df in results.items()]
    )


def row_count_match(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row: how many results, the range of their counts, and whether all agree.

    Pass only results that succeeded; with fewer than two nothing is comparable.
    """
    return row_counts(results).agg(
        F.count(F.lit(1)).alias("results"),
        F.min("row_count").alias("min_rows"),
        F.max("row_count").alias("max_rows"),
        (F.count(F.lit(1)) > 1).alias("comparable"),
        (F.countDistinct("row_count") == 1).alias("row_count_match"),
    )


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """Distinct field names over all JSON objects of a text column."""
    keys = F.map_keys(F.from_json(F.col(column), "map<string,string>"))
    return df.select(F.explode(keys).alias("field")).distinct()


def field_diff(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Field names that occur in the JSON rows of one result only."""
    a, b = json_fields(left, column), json_fields(right, column)
    return (
        a.join(b, "field", "left_anti")
        .withColumn("present_in", F.lit("left"))
        .unionByName(b.join(a, "field", "left_anti").withColumn("present_in", F.lit("right")))
    )


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """``(path, type)`` of every place in the JSON rows of a text column, however deep, and the type that all its values fit.

    ``$`` is a row itself, ``.name`` a field and ``[*]`` any element of an array.  Rows are read as Spark's variants and
    taken apart one level at a time; only the different paths of a level, combined per task, are shuffled.  Text that is
    no JSON has no paths.

    Rows of one type have the same paths and types, so one of them stands for all.  Where the type hides paths, since
    elements of an array fit none together, every row is taken apart.
    """
    spark = df.sparkSession
    typed = df.select(F.col(column).alias("text"), F.schema_of_variant(F.try_parse_json(column)).alias("type")).where("type is not null")
    hides = F.contains("type", F.lit("VARIANT"))
    # Rows whose type hides paths are spread by their text and never meet in one group.
    shown = typed.groupBy("type", F.when(hides, F.col("text")).alias("_own")).agg(F.first("text").alias("text"))
    shown = materialise(shown.select("text"), "json-types")
    level = shown.select(F.lit("$").alias("path"), F.try_parse_json("text").alias("v")).where("v is not null")
    found = None
    while True:
        kinds = level.groupBy("path").agg(F.schema_of_variant_agg("v").alias("type"), F.bool_or(_nested("v")).alias("_deeper"))
        kinds = materialise(kinds, "json-paths")
        found = kinds if found is None else found.unionByName(kinds)
        if not kinds.where("_deeper").limit(1).count():
            return found.select("path", "type")
        inner = level.where(_nested("v")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[*]")).otherwise(F.concat(F.lit("."), "key"))
        level = inner.select(F.concat("path", step).alias("path"), F.col("value").alias("v"))


def _nested(variant: str) -> Column:
    kind = F.schema_of_variant(variant)
    return (F.startswith(kind, F.lit("OBJECT<")) & (kind != "OBJECT<>")) | (F.startswith(kind, F.lit("ARRAY<")) & (kind != "ARRAY<VOID>"))


def path_diff(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """``(path, present_in, left_type, right_type)``: JSON paths of one result only, and those with other types.

    Numbers of all types count as one type, and so do objects and arrays each, whose fields and elements have paths of
    their own; a place that is null throughout has no type to differ.
    """
    a, b = (json_paths(df, column).withColumn("kind", _kind(F.col("type"))) for df in (left, right))
    a, b = (df.select(F.struct("type", "kind").alias(tag), F.col("path")) for df, tag in ((a, "l"), (b, "r")))
    joined = a.join(b, "path", "full_outer")
    present = F.when(F.col("r").isNull(), F.lit("left")).when(F.col("l").isNull(), F.lit("right"))
    apart = F.when((F.col("l.kind") != F.col("r.kind")) & (F.col("l.kind") != "void") & (F.col("r.kind") != "void"), F.lit("both"))
    return joined.select("path", F.coalesce(present, apart).alias("present_in"), F.col("l.type").alias("left_type"), F.col("r.type").alias("right_type")).where(
        "present_in is not null"
    )


def _kind(name: Column) -> Column:
    number = name.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    return F.when(number, F.lit("number")).otherwise(F.lower(F.regexp_extract(name, "^[A-Z]+", 0)))


def column_diff(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Field names of typed results that only one of them has."""
    return {
        "left": sorted(set(left.columns) - set(right.columns)),
        "right": sorted(set(right.columns) - set(left.columns)),
    }


def _without_equal_rows(left: DataFrame, right: DataFrame, key: str, common: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """The rows of both sides that have no equal row on the other one, and the most of them that share a key.

    Equal rows are counted by two 64-bit hashes, added up before the shuffle, so many copies of one row, or many
    different rows of one key, meet in no single task.  Of a row with ``n`` copies more than on the other side, ``n`` stay.
    """
    columns = [key, *common]
    sides = [df.withColumns(dict(zip(("_h1", "_h2"), row_hashes(df, other, columns)))) for df, other in ((left, right), (right, left))]
    counted = [df.groupBy("_h1", "_h2").agg(F.count(F.lit(sign)).alias("n"), F.first(F.col(key).cast("string")).alias("_k")) for df, sign in zip(sides, (1, -1))]
    signed = counted[0].unionByName(counted[1].withColumn("n", -F.col("n")))
    apart = signed.groupBy("_h1", "_h2").agg(F.sum("n").alias("_n"), F.first("_k").alias("_k")).where("_n <> 0")
    apart = materialise(apart, "unequal-rows")
    per_key = apart.groupBy("_k").agg(F.sum(F.greatest("_n", F.lit(0))).alias("l"), F.sum(F.greatest(-F.col("_n"), F.lit(0))).alias("r"))
    most, rows = per_key.agg(F.max(F.greatest("l", "r")), F.sum(F.lit(1))).first()
    few = (rows or 0) and apart.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    left_over = []
    for df, sign in zip(sides, (1, -1)):
        own = apart.where(F.col("_n") * sign > 0).select("_h1", "_h2", F.abs("_n").alias("_n"))
        found = df.join(F.broadcast(own) if few else own, ["_h1", "_h2"])
        one = found.groupBy("_h1", "_h2").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_row"), F.first("_n").alias("_n"))
        left_over.append(one.select("_row.*", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_same")).select(*columns))
    return left_over[0], left_over[1], most or 0


def _numbered(df: DataFrame, key: str, common: list[str], most: int) -> DataFrame:
    """Column ``_copy``: the place of a row among those of its key, in the order of its values."""
    values = [comparable(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"_v{k}") for k, c in enumerate(common)]
    names = [f"_v{k}" for k in range(len(common))]
    if most <= 1:
        return df.withColumn("_copy", F.lit(1).cast("bigint"))
    ordered = df.select("*", *values)
    if most <= GROUP_ROWS:
        order = Window.partitionBy(key).orderBy(*[F.col(n) for n in names] or [F.lit(0)])
        return ordered.withColumn("_copy", F.row_number().over(order).cast("bigint")).drop(*names)
    # A key with more rows than a task should order: places in the order of the whole table, less the key's first one.
    placed = with_positions(ordered, [key, *names], "_place")
    first = placed.groupBy(F.col(key).alias("_first_key")).agg(F.min("_place").alias("_first"))
    joined = placed.join(first, F.col(key).eqNullSafe(F.col("_first_key")))
    return joined.withColumn("_copy", F.col("_place") - F.col("_first") + 1).drop("_place", "_first", "_first_key", *names)


def cell_diff(left: DataFrame, right: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per differing cell of the common fields, and per row only one side has.

    ``key`` identifies a row on both sides; null is a key like any other.  Of rows that share a key, equal ones on both
    sides pair off, and the rest is numbered in the order of its values on either side and compared number by number.
    Numbers differ beyond the tolerance, everything else when not equal; null equals null only, NaN equals NaN only,
    and maps are equal if their entries are.
    """
    common = [c for c in left.columns if c in right.columns and c != key]
    kinds = {c: (left.schema[c].dataType, right.schema[c].dataType) for c in common}
    left, right, most = _without_equal_rows(left, right, key, common)

    def side(df: DataFrame, tag: str) -> DataFrame:
        return _numbered(df, key, common, most).select(
            F.col(key).alias(f"_{tag}key"), F.col("_copy").alias(f"_{tag}copy"), F.struct(F.lit(True).alias("_here"), *common).alias(f"_{tag}")
        )

    same = F.col("_lkey").eqNullSafe(F.col("_rkey")) & (F.col("_lcopy") == F.col("_rcopy"))
    joined = side(left, "l").join(side(right, "r"), same, "full_outer")

    def cell(field: str) -> Column:
        l, r = F.col("_l").getField(field), F.col("_r").getField(field)
        if all(isinstance(kind, T.NumericType) for kind in kinds[field]):
            a, b = l.cast("double"), r.cast("double")
            plain = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
            differs = F.when(l.isNull() | r.isNull(), l.isNull() != r.isNull()).when(plain, F.abs(a - b) > F.lit(tolerance)).otherwise(a != b)
        else:
            differs = ~comparable(l, kinds[field][0]).eqNullSafe(comparable(r, kinds[field][1]))
        return F.when(differs, _entry(field, l.cast("string"), r.cast("string"), "value"))

    here, there = F.coalesce(F.col("_l._here"), F.lit(False)), F.coalesce(F.col("_r._here"), F.lit(False))
    nothing = F.lit(None).cast("string")
    missing = F.when(here, _entry(None, nothing, nothing, "missing_right")).otherwise(_entry(None, nothing, nothing, "missing_left"))
    cells = F.filter(F.array(*[cell(c) for c in common]), lambda x: x.isNotNull()) if common else F.array(missing)
    cells = cells if common else F.filter(cells, lambda x: F.lit(False))
    return joined.select(
        F.when(here, F.col("_lkey")).otherwise(F.col("_rkey")).alias(key), F.explode(F.when(here & there, cells).otherwise(F.array(missing))).alias("_d")
    ).select(key, "_d.*")


def range_diff(left: DataFrame, right: DataFrame, key: str, tolerance: float = TOLERANCE, ranges: int = 1024, fan: int = 64) -> DataFrame:
    """``cell_diff`` of two tables that are expected to be mostly equal, by digests of key ranges.

    The result is the same: rows of a key stand in one range on both sides, and ranges with equal digests have no
    difference.  Equal tables are read once more than needed to find the ranges, and nothing but digests is shuffled.
    """
    rows = differing_rows(left, right, key, ranges, fan)
    if rows is None:
        kinds = T.StructType([T.StructField(key, left.schema[key].dataType), *[T.StructField(c, T.StringType()) for c in ("field", "left_value", "right_value", "difference")]])
        return left.sparkSession.createDataFrame([], kinds)
    return cell_diff(*rows, key, tolerance)


def _entry(field: str | None, left: Column, right: Column, kind: str) -> Column:
    return F.struct(
        F.lit(field).cast("string").alias("field"),
        left.alias("left_value"),
        right.alias("right_value"),
        F.lit(kind).alias("difference"),
    )


def cell_diff_by_position(
    left: DataFrame, right: DataFrame, order_by: Sequence[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """Compare row by row in a stated order, as ordered reports are compared."""
    return cell_diff(
        with_positions(left, list(order_by), "row_no"), with_positions(right, list(order_by), "row_no"), "row_no", tolerance
    )


def compare_results(
    results: Mapping[str, DataFrame], key: str, tolerance: float = TOLERANCE
) -> DataFrame:
    """Compare every result with the first: counts, fields and cells, one row per pair.

    ``match`` needs equal row counts, equal fields and no differing cell.  With
    a single result there is nothing to compare and no row.
    """
    (ref_name, ref), *others = [(n, canonical_rows(df)) for n, df in results.items()]
    kind = "reference_result string, compared_result string, row_count_match boolean, fields_match boolean, differing_cells bigint, match boolean"
    rows = [ref.sparkSession.createDataFrame([], kind)]
    for name, other in others:
        cells = cell_diff(ref, other, key.lower(), tolerance).agg(F.count(F.lit(1)).alias("differing_cells"))
        counts = row_count_match({ref_name: ref, name: other}).select("row_count_match")
        diff = column_diff(ref, other)
        fields = F.lit(not diff["left"] and not diff["right"])
        rows.append(
            cells.join(F.broadcast(counts)).select(  # one row each
                F.lit(ref_name).alias("reference_result"),
                F.lit(name).alias("compared_result"),
                "row_count_match",
                fields.alias("fields_match"),
                "differing_cells",
                ((F.col("differing_cells") == 0) & F.col("row_count_match") & fields).alias("match"),
            )
        )
    return _union(rows)


def overall_verdict(checks: DataFrame) -> DataFrame:
    """Verdict per test from rows (test_name, result, row_count, data_match).

    A test passes when all its results have the same row count and every data
    check holds; a test with a single result is not comparable.
    """
    return (
        checks.groupBy("test_name")
        .agg(
            F.count(F.lit(1)).alias("results"),
            (F.min("row_count") == F.max("row_count")).alias("row_count_match"),
            F.bool_and(F.coalesce("data_match", F.lit(False))).alias("data_match"),
        )
        .select(
            "test_name",
            "results",
            "row_count_match",
            "data_match",
            F.when(F.col("results") < 2, F.lit("not comparable"))
            .when(F.col("row_count_match") & F.col("data_match"), F.lit("match"))
            .otherwise(F.lit("mismatch"))
            .alias("verdict"),
        )
    )
