"""Governance tables: sensitive-value scan (R4) and row lineage.

The Gold jobs write lineage as three tables: the source files with a code each, the
processes (one row an edge of the job's graph) and a narrow table of rows that holds codes only. All are ordinary DataFrame jobs whose results are tables, not calls to a
catalogue service.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, MapType, StringType, StructType

from stratum.functions.expressions import EMAIL_PATTERN, unanchored, year_month_of
from stratum.operators.joins import join_small

# --- fixed values: detection patterns (kept to constructs that Java regex
# and RE2 read the same way: no \b, no \s, no look-around) ---
SENSITIVE_PATTERNS: dict[str, str] = {
    "email": unanchored(EMAIL_PATTERN),
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "card_number": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "secret_assignment": r"(token|secret|password|api_key) *= *\"[^\"]+\"",
}
# --- end of fixed values ---

# A literal every match of the pattern contains, by the pattern itself (a caller's pattern of the same
# name is another pattern). Testing it first (a plain
# substring search) skips the regex engine on most values without changing
# any result; on long texts the unanchored e-mail pattern is ~8x cheaper so.
REQUIRED_LITERAL = {SENSITIVE_PATTERNS["email"]: "@", SENSITIVE_PATTERNS["ipv4"]: ".", SENSITIVE_PATTERNS["secret_assignment"]: "="}


def matches(col: str, pattern: str) -> Column:
    """``col`` contains a match of ``pattern`` (prefiltered when possible)."""
    literal = REQUIRED_LITERAL.get(pattern)
    test = F.col(col).rlike(pattern)
    return F.col(col).contains(literal) & test if literal else test


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def sensitive_scan(df: DataFrame, columns: Sequence[str] | None = None,
                   patterns: Mapping[str, str] = SENSITIVE_PATTERNS) -> DataFrame:
    """Per (column, pattern), how many non-null values contain a match.

    One aggregate over the table for every pair (a single scan, partial
    aggregation), unpivoted to ``column_name, pattern, n_values, n_flagged,
    flagged_share``. Whole values are searched, never a prefix.
    """
    cols = list(columns) if columns is not None else _string_columns(df)
    if not cols:
        raise ValueError("no string columns to scan")
    aggs, rows = [], []
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"_n{i}"))
        for j, (name, pat) in enumerate(patterns.items()):
            aggs.append(F.count_if(matches(c, pat)).alias(f"_f{i}_{j}"))
            rows.append(F.struct(
                F.lit(c).alias("column_name"), F.lit(name).alias("pattern"),
                F.col(f"_n{i}").alias("n_values"), F.col(f"_f{i}_{j}").alias("n_flagged"),
            ))
    stats = df.select(*cols).agg(*aggs).select(F.inline(F.array(*rows)))
    return stats.withColumn(
        "flagged_share",
        F.when(F.col("n_values") > 0, F.col("n_flagged").cast("double") / F.col("n_values")),
    )


def sensitive_rows(df: DataFrame, id_col: str, columns: Sequence[str] | None = None,
                   patterns: Mapping[str, str] = SENSITIVE_PATTERNS) -> DataFrame:
    """Row-level classification: one ``(id, column_name, pattern)`` row per
    value that contains a match (a narrow map-only job, no shuffle)."""
    cols = list(columns) if columns is not None else [c for c in _string_columns(df) if c != id_col]
    tags = [
        F.when(matches(c, pat), F.struct(F.lit(c).alias("column_name"), F.lit(name).alias("pattern")))
        for c in cols for name, pat in patterns.items()
    ]
    return (
        df.select(id_col, F.explode(F.array(*tags)).alias("_tag"))
        .where(F.col("_tag").isNotNull())
        .select(id_col, "_tag.column_name", "_tag.pattern")
    )


# ---------------------------------------------------------------- checked findings, nested values


def _luhn(match: Column) -> Column:
    return F.call_function("luhn_check", F.translate(match, " -", ""))


def _octets(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda x: x.cast("int") <= 255)


#: What a match must pass beyond its pattern, by the pattern itself; other patterns have no further test.
CHECKS = {SENSITIVE_PATTERNS["card_number"]: _luhn, SENSITIVE_PATTERNS["ipv4"]: _octets}


def matched(value: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of ``pattern`` in ``value``; empty for null, and without a regex search where
    the pattern's required literal is missing."""
    found = F.regexp_extract_all(value, F.lit(pattern), F.lit(0))
    literal = REQUIRED_LITERAL.get(pattern)
    return F.when(value.contains(literal) if literal else value.isNotNull(), found).otherwise(F.array().cast("array<string>"))


def valid_matches(found: Column, pattern: str) -> Column:
    """How many of the matches pass the pattern's check: the Luhn digit of card numbers, octets up to 255 of addresses."""
    check = CHECKS.get(pattern)
    return F.size(F.filter(found, check)) if check else F.size(found)


def sensitive_findings(df: DataFrame, id_col: str, columns: Sequence[str] | None = None,
                       patterns: Mapping[str, str] = SENSITIVE_PATTERNS) -> DataFrame:
    """R4, checked: (id, column_name, pattern, n_matches, n_valid) for every value with a match. Map-only."""
    cols = list(columns) if columns is not None else [c for c in _string_columns(df) if c != id_col]
    pairs = [(c, name, pat) for c in cols for name, pat in patterns.items()]
    found = df.select(F.col(id_col), *[matched(F.col(c), pat).alias(f"m{i}") for i, (c, _, pat) in enumerate(pairs)])
    tags = [F.when(F.size(f"m{i}") > 0, F.struct(
        F.lit(c).alias("column_name"), F.lit(name).alias("pattern"), F.size(f"m{i}").cast("long").alias("n_matches"),
        valid_matches(F.col(f"m{i}"), pat).cast("long").alias("n_valid"))) for i, (c, name, pat) in enumerate(pairs)]
    return found.select(F.col(id_col), F.inline(F.array_compact(F.array(*tags))))


_LEAF = "array<struct<path:string,value:string>>"


def _leaf(path: Column, value: Column) -> Column:
    return F.array(F.struct(path.alias("path"), value.alias("value"))).cast(_LEAF)


def _json_leaves(path: Column, value: Column, depth: int) -> Column:
    """Leaves of a JSON text: objects by key, arrays by ``[]``, ``depth`` levels deep; anything else is a leaf itself."""
    if depth == 0:
        return _leaf(path, value)
    entries = F.map_entries(F.from_json(value, "map<string,string>"))
    items = F.from_json(value, "array<string>")
    inner = F.flatten(F.transform(entries, lambda e: _json_leaves(F.concat(path, F.lit("."), e["key"]), e["value"], depth - 1)))
    listed = F.flatten(F.transform(items, lambda x: _json_leaves(F.concat(path, F.lit("[]")), x, depth - 1)))
    start = F.substring(F.ltrim(value), 1, 1)
    return F.coalesce(F.when(start == "{", inner), F.when(start == "[", listed), _leaf(path, value))


def _leaves(path: Column, value: Column, kind: DataType, json: bool, depth: int) -> Column:
    none = F.array().cast(_LEAF)
    if isinstance(kind, StringType):
        return _json_leaves(path, value, depth) if json else _leaf(path, value)
    if isinstance(kind, IntegralType):
        return _leaf(path, value.cast("string"))
    if isinstance(kind, StructType):
        parts = [_leaves(F.concat(path, F.lit(f".{f.name}")), value[f.name], f.dataType, json, depth) for f in kind.fields]
        return F.concat(*parts) if parts else none
    if isinstance(kind, ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda x: _leaves(F.concat(path, F.lit("[]")), x, kind.elementType, json, depth))), none)
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        return F.coalesce(F.flatten(F.transform(F.map_entries(value), lambda e: _leaves(
            F.concat(path, F.lit("."), e["key"]), e["value"], kind.valueType, json, depth))), none)
    return none


def nested_values(df: DataFrame, columns: Sequence[str] | None = None, json_columns: Sequence[str] = (), json_depth: int = 3) -> DataFrame:
    """(path, value) of every text and whole number inside the columns: struct fields and map keys by ``.``, array items by
    ``[]``, JSON texts (``json_columns``) opened ``json_depth`` levels deep. Null values are left out; a JSON text that does not
    parse is one value."""
    cols = list(columns) if columns is not None else df.columns
    parts = [_leaves(F.lit(c), F.col(c), df.schema[c].dataType, c in json_columns, json_depth) for c in cols]
    return df.select(F.inline(F.concat(*parts))).where(F.col("value").isNotNull())


def sensitive_scan_nested(df: DataFrame, columns: Sequence[str] | None = None, json_columns: Sequence[str] = (),
                          patterns: Mapping[str, str] = SENSITIVE_PATTERNS) -> DataFrame:
    """R4 inside nested columns: (path, pattern, n_values, n_flagged, n_valid), one partially aggregated pass.

    ``n_flagged`` counts values with a match, ``n_valid`` those with a match that passes its check."""
    found = nested_values(df, columns, json_columns).select("path", *[matched(F.col("value"), p).alias(f"m{i}") for i, p in enumerate(patterns.values())])
    aggs = [F.count(F.lit(1)).alias("n_values")]
    rows = []
    for i, (name, pat) in enumerate(patterns.items()):
        aggs += [F.count_if(F.size(f"m{i}") > 0).alias(f"f{i}"), F.count_if(valid_matches(F.col(f"m{i}"), pat) > 0).alias(f"v{i}")]
        rows.append(F.struct(F.lit(name).alias("pattern"), F.col(f"f{i}").alias("n_flagged"), F.col(f"v{i}").alias("n_valid")))
    return found.groupBy("path").agg(*aggs).select("path", "n_values", F.inline(F.array(*rows)))


def row_lineage(fact: DataFrame, source_file_col: str = "_source_file",
                process_name: str = "silver_to_gold.monthly_sales",
                source_name: str = "silver.transactions_cleansed",
                target_name: str = "gold.agg_monthly_sales") -> DataFrame:
    """Each Gold aggregate group → contributing transaction → source file.

    ``fact`` is the sales fact carrying the file each transaction was read
    from. Grouping the result by the group key gives the aggregate's
    ``transaction_count`` back (rows with a null ``transaction_id`` are not
    counted there and are left out here).
    """
    return fact.where(F.col("transaction_id").isNotNull()).select(
        year_month_of("date_key").alias("year_month"),
        "store_id",
        "product_id",
        "transaction_id",
        F.col(source_file_col).alias("source_file"),
        F.lit(process_name).alias("process_name"),
        F.lit(f"{process_name}:v1").alias("process_qualified_name"),
        F.lit(source_name).alias("source_qualified_name"),
        F.lit(target_name).alias("target_qualified_name"),
    )


# ---------------------------------------------------------------- lineage tables of a Gold run

FILE_ID, PROCESS_ID = "source_file_id", "process_id"
PROCESS_SCHEMA = ("process_id long, process_name string, process_qualified_name string, source_qualified_name string, "
                  "target_qualified_name string, run_id string")


def file_id(path: Column) -> Column:
    """Dictionary code of a source file: 64 bits of its path, so every scan finds the same code without a join."""
    return F.xxhash64(path)


def lineage_files(source: DataFrame) -> DataFrame:
    """(source_file_id, source_file): the files that ``source`` is read from, one row a file.

    Only the scan's file metadata is read, no column. Two files with one code would merge their rows' lineage, so that stops the run."""
    files = source.select(F.col("_metadata.file_path").alias("source_file")).distinct()
    coded = files.groupBy(file_id(F.col("source_file")).alias(FILE_ID)).agg(
        F.min("source_file").alias("source_file"), F.count(F.lit(1)).alias("n"))
    clash = F.raise_error(F.concat(F.lit("two source files share the code of "), F.col("source_file")))
    return coded.select(FILE_ID, F.when(F.col("n") > 1, clash).otherwise(F.col("source_file")).alias("source_file"))


def lineage_processes(spark: SparkSession, edges: Sequence[tuple[str, str, str]], version: str, run_id: str) -> DataFrame:
    """One row for each (process name, source, target) of a run, with qualified names; as small as the job's graph."""
    rows = [(name, f"{name}:{version}", source, target, run_id) for name, source, target in edges]
    table = spark.createDataFrame(rows, "process_name string, process_qualified_name string, source_qualified_name string, "
                                        "target_qualified_name string, run_id string")
    return table.select(F.xxhash64("process_qualified_name", "source_qualified_name", "target_qualified_name").alias(PROCESS_ID), "*")


def lineage_rows(fact: DataFrame, process: tuple[str, str, str], version: str) -> DataFrame:
    """(year_month, store_id, product_id, transaction_id, source_file_id, process_id): which transaction, from which file,
    went into which Gold group. Grouped by its first three columns it counts ``transaction_count``."""
    name, source, target = process
    code = F.xxhash64(F.lit(f"{name}:{version}"), F.lit(source), F.lit(target))
    return fact.where(F.col("transaction_id").isNotNull()).select(
        year_month_of("date_key").alias("year_month"), "store_id", "product_id", "transaction_id", FILE_ID, code.alias(PROCESS_ID))


def expand_lineage(rows: DataFrame, files: DataFrame, processes: DataFrame) -> DataFrame:
    """The coded rows with file, process and qualified names written out (the two small tables joined when measured small)."""
    own = processes.drop("run_id").distinct()
    return join_small(join_small(rows, files, FILE_ID), own, PROCESS_ID)
