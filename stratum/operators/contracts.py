"""Column contracts: not-null, unique, regex and value-set rules with a
``mostly`` tolerance, evaluated for a whole suite in one pass.

Semantics follow the column-map expectations of the validation library the
original used (documented behaviour, not re-run here):

* ``not_null``: every null row is unexpected; the denominator is all rows.
* ``unique``: every non-null row whose value occurs more than once is
  unexpected (all copies count); nulls are ignored.
* ``match_regex`` / ``in_set``: non-null rows that fail are unexpected;
  nulls are ignored (they count only for ``not_null``).
* ``between`` / ``value_lengths``: non-null rows outside the closed range are
  unexpected. ``of_type``: all non-null rows are, when the column has another type.
* ``compound_unique``: like ``unique`` on several columns together; rows with all of
  them null are ignored.
* ``column_exists`` and ``row_count``: one check of the table (element count 1).
* success: ``(denominator - unexpected) / denominator >= mostly``; with a
  zero denominator the rule passes. All rules are evaluated; none
  short-circuits.

Plan: a single scan. With one uniqueness rule, an aggregate by its key carries the row-level counts along; with
several, ``GROUPING SETS ((u1), ..., (uk))`` does, and the row-level counts are summed over the first set.
Map-side partial aggregation, then a
one-row aggregate and an unpivot to one row per expectation. Only those rows
(as many as the suite has rules) ever reach the driver.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.functions.expressions import EMAIL_MOSTLY, EMAIL_PATTERN, REGION_VALUES
from stratum.operators.joins import skew_join
from stratum.session import checkpoint_root

log = logging.getLogger(__name__)

# --- fixed values: expectation type names of the contract documents ---
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
MATCH_REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
OF_TYPE = "expect_column_values_to_be_of_type"
VALUE_LENGTHS = "expect_column_value_lengths_to_be_between"
COLUMN_EXISTS = "expect_column_to_exist"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"
ROW_COUNT = "expect_table_row_count_to_be_between"
# --- end of fixed values ---

RESULT_COLUMNS = (
    "asset", "suite", "expectation_index", "expectation_type", "column_name", "mostly",
    "element_count", "missing_count", "unexpected_count", "unexpected_percent", "success",
)


_RANGED = (BETWEEN, VALUE_LENGTHS, ROW_COUNT)
_TABLE = (COLUMN_EXISTS, ROW_COUNT)
_UNIQUE = (UNIQUE, COMPOUND_UNIQUE)


@dataclass(frozen=True)
class Expectation:
    expectation_type: str
    column: str = ""
    regex: str | None = None
    value_set: tuple = ()
    mostly: float = 1.0
    min_value: float | None = None
    max_value: float | None = None
    type_name: str | None = None
    column_list: tuple = ()

    def __post_init__(self) -> None:
        kind = self.expectation_type
        if kind not in (NOT_NULL, UNIQUE, MATCH_REGEX, IN_SET, *_RANGED, OF_TYPE, COLUMN_EXISTS, COMPOUND_UNIQUE):
            raise ValueError(f"unsupported expectation {kind!r}")
        if not 0.0 <= self.mostly <= 1.0:
            raise ValueError("mostly must be within [0, 1]")
        needs = {MATCH_REGEX: ("regex", self.regex), IN_SET: ("value_set", self.value_set), OF_TYPE: ("type_name", self.type_name),
                 COMPOUND_UNIQUE: ("column_list", len(self.column_list) > 1)}
        if kind in needs and not needs[kind][1]:
            raise ValueError(f"{kind} needs a {needs[kind][0]}")
        if kind in _RANGED and self.min_value is None and self.max_value is None:
            raise ValueError(f"{kind} needs min_value or max_value")
        if not self.column and kind not in (ROW_COUNT, COMPOUND_UNIQUE):
            raise ValueError(f"{kind} needs a column")

    @property
    def name(self) -> str:
        """The column, or columns, the rule is about."""
        return self.column or ",".join(self.column_list)


def expectation(expectation_type: str, **kwargs) -> Expectation:
    """A rule from its type name and its named arguments, as contract documents write them."""
    for key in ("value_set", "column_list"):
        if key in kwargs:
            kwargs[key] = tuple(kwargs[key])
    if "type_" in kwargs:
        kwargs["type_name"] = kwargs.pop("type_")
    return Expectation(expectation_type, **kwargs)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(NOT_NULL, column, mostly=mostly)


def unique(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(UNIQUE, column, mostly=mostly)


def match_regex(column: str, regex: str, mostly: float = 1.0) -> Expectation:
    return Expectation(MATCH_REGEX, column, regex=regex, mostly=mostly)


def in_set(column: str, value_set: Iterable, mostly: float = 1.0) -> Expectation:
    return Expectation(IN_SET, column, value_set=tuple(value_set), mostly=mostly)


def customer_contract() -> list[Expectation]:
    """The Silver customer contract."""
    return [
        not_null("customer_id"),
        unique("customer_id"),
        match_regex("email", EMAIL_PATTERN, mostly=EMAIL_MOSTLY),
        in_set("region", REGION_VALUES),
    ]


def _in_range(c: Column, e: Expectation) -> Column:
    ok = F.lit(True)
    if e.min_value is not None:
        ok = ok & (c >= e.min_value)
    if e.max_value is not None:
        ok = ok & (c <= e.max_value)
    return ok


def _broken(df: DataFrame, e: Expectation) -> Column:
    """Whether a row breaks a row-level rule."""
    c, kind = F.col(e.column), e.expectation_type
    if kind == NOT_NULL:
        return c.isNull()
    if kind == MATCH_REGEX:
        ok = c.rlike(e.regex)
    elif kind == IN_SET:
        ok = c.isin(list(e.value_set))
    elif kind == BETWEEN:
        ok = _in_range(c, e)
    elif kind == VALUE_LENGTHS:
        ok = _in_range(F.length(c.cast("string")), e)
    else:
        ok = F.lit(df.schema[e.column].dataType.simpleString() == e.type_name.lower())
    return c.isNotNull() & ~ok


def _key(e: Expectation) -> Column:
    """The value of a uniqueness rule; null rows are ignored."""
    if e.expectation_type == UNIQUE:
        return F.col(e.column)
    some = F.coalesce(*[F.col(c).cast("string") for c in e.column_list]).isNotNull()
    return F.when(some, F.struct(*[F.col(c) for c in e.column_list]))


def contract_stats(df: DataFrame, expectations: Sequence[Expectation], suite: str = "",
                   asset: str = "") -> DataFrame:
    """One result row per expectation (lazy; nothing runs yet)."""
    if not expectations:
        raise ValueError("a contract needs at least one expectation")
    keys = {i: f"_k{i}" for i, e in enumerate(expectations) if e.expectation_type in _UNIQUE}
    row_level = [(i, e) for i, e in enumerate(expectations) if i not in keys and e.expectation_type not in _TABLE]
    counted = {e.column for _, e in row_level}
    base = df.select(*sorted(counted), *[_key(expectations[i]).alias(k) for i, k in keys.items()])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in row_level:
        aggs.append(F.count_if(F.col(e.column).isNull()).alias(f"_m{i}"))
        aggs.append(F.count_if(_broken(df, e)).alias(f"_u{i}"))
    if not keys:
        stats = base.agg(*aggs)
    else:
        names = list(keys.values())
        if len(names) == 1:
            grouped = base.groupBy(names[0]).agg(*aggs, F.lit(0).alias(f"_g{names[0]}"))
        else:
            grouped = base.groupingSets([[k] for k in names], *names).agg(*aggs, *[F.grouping(k).alias(f"_g{k}") for k in names])
        # every row is in the first set's groups exactly once
        first = F.col(f"_g{names[0]}") == 0
        final = [F.sum(F.when(first, F.col("_n"))).alias("_n")]
        for i, _ in row_level:
            final.append(F.sum(F.when(first, F.col(f"_m{i}"))).alias(f"_m{i}"))
            final.append(F.sum(F.when(first, F.col(f"_u{i}"))).alias(f"_u{i}"))
        for k in names:
            own, key = F.col(f"_g{k}") == 0, F.col(k)
            final.append(F.sum(F.when(own & key.isNull(), F.col("_n"))).alias(f"_null{k}"))
            final.append(F.sum(F.when(own & key.isNotNull() & (F.col("_n") > 1), F.col("_n"))).alias(f"_dup{k}"))
        stats = grouped.agg(*final)

    def cnt(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    rows = []
    for i, e in enumerate(expectations):
        elements = cnt("_n")
        if i in keys:
            missing, unexpected = cnt(f"_null{keys[i]}"), cnt(f"_dup{keys[i]}")
        elif e.expectation_type in _TABLE:
            ok = F.lit(e.column in df.columns) if e.expectation_type == COLUMN_EXISTS else _in_range(cnt("_n"), e)
            elements, missing, unexpected = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.when(ok, 0).otherwise(1).cast("bigint")
        else:
            missing, unexpected = cnt(f"_m{i}"), cnt(f"_u{i}")
        rows.append(F.struct(
            F.lit(i).alias("expectation_index"),
            F.lit(e.expectation_type).alias("expectation_type"),
            F.lit(e.name).alias("column_name"),
            F.lit(float(e.mostly)).cast("double").alias("mostly"),
            elements.alias("element_count"),
            missing.alias("missing_count"),
            unexpected.alias("unexpected_count"),
        ))
    out = stats.select(F.inline(F.array(*rows)))
    denom = F.when(F.col("expectation_type") == NOT_NULL, F.col("element_count")).otherwise(
        F.col("element_count") - F.col("missing_count")
    )
    return out.select(
        F.lit(asset).alias("asset"),
        F.lit(suite).alias("suite"),
        "expectation_index", "expectation_type", "column_name", "mostly",
        "element_count", "missing_count", "unexpected_count",
        F.when(denom > 0, F.col("unexpected_count").cast("double") / denom * 100).alias("unexpected_percent"),
        F.when(denom == 0, F.lit(True))
        .otherwise((denom - F.col("unexpected_count")).cast("double") / denom >= F.col("mostly"))
        .alias("success"),
    )


_RULE = "struct<expectation_index:int,expectation_type:string,column_name:string>"


def flag_rows(df: DataFrame, expectations: Sequence[Expectation], into: str = "broken_rules") -> DataFrame:
    """``df`` with ``into``: the rules that the row breaks, as an array of (expectation_index, expectation_type, column_name).

    Row-level rules are map-only. All uniqueness rules find their repeated keys in one pass (grouping sets, partial
    aggregation); those keys are stored once and joined back – broadcast when measured small, else with repeated
    hot keys salted. Table rules have no rows.
    """
    if into in df.columns:
        raise ValueError(f"the rows already have a column {into!r}")
    rules = list(enumerate(expectations))

    def tag(i: int, e: Expectation, broken: Column) -> Column:
        return F.when(broken, F.struct(F.lit(i).alias("expectation_index"), F.lit(e.expectation_type).alias("expectation_type"),
                                       F.lit(e.name).alias("column_name")))

    tags = [tag(i, e, _broken(df, e)) for i, e in rules if e.expectation_type not in (*_UNIQUE, *_TABLE)]
    unique = [(i, e) for i, e in rules if e.expectation_type in _UNIQUE]
    own = {c: f"own_{n}" for n, c in enumerate(df.columns)}
    # under names of our own while keys travel along, whatever the user's columns are called
    flagged = df.select(*[F.col(c).alias(o) for c, o in own.items()], F.array_compact(F.array(*tags)).cast(f"array<{_RULE}>").alias("row_rules"),
                        *[_key(e).alias(f"key_{i}") for i, e in unique])
    found = []
    if unique:
        checkpoint_root(df.sparkSession)
        keys = [f"key_{i}" for i, _ in unique]
        base = flagged.select(*keys)
        counted = (base.groupBy(*keys) if len(keys) == 1 else base.groupingSets([[k] for k in keys], *keys)).agg(F.count(F.lit(1)).alias("n"))
        repeated = counted.where(F.col("n") > 1).drop("n").checkpoint()
        for (i, e), k in zip(unique, keys, strict=True):
            again = repeated.where(F.col(k).isNotNull()).select(k).withColumn(f"again_{i}", F.lit(True))
            flagged = skew_join(flagged, again, k)
            found.append(tag(i, e, F.coalesce(F.col(f"again_{i}"), F.lit(False))))
    all_rules = F.concat("row_rules", F.array_compact(F.array(*found)).cast(f"array<{_RULE}>")) if found else F.col("row_rules")
    return flagged.select(*[F.col(o).alias(c) for c, o in own.items()], F.array_sort(all_rules).alias(into))


def contract_violations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Every row of ``df`` that breaks a rule, once for each rule it breaks, with expectation_index, expectation_type and column_name:
    the rows to quarantine."""
    if all(e.expectation_type in _TABLE for e in expectations):
        raise ValueError("the contract has no rule about rows")
    flagged = flag_rows(df, expectations, "broken_rules_of_row")
    return flagged.select(*df.columns, F.inline("broken_rules_of_row"))


@dataclass
class ValidationResult:
    success: bool
    asset: str
    suite: str
    results: list[dict] = field(default_factory=list)

    @property
    def statistics(self) -> dict:
        n = len(self.results)
        ok = sum(1 for r in self.results if r["success"])
        return {
            "evaluated_expectations": n,
            "successful_expectations": ok,
            "unsuccessful_expectations": n - ok,
            "success_percent": (100.0 * ok / n) if n else None,
        }

    def to_json_dict(self) -> dict:
        return {**asdict(self), "statistics": self.statistics}


class ContractViolation(ValueError):
    """Raised when a contract fails and the caller asked to halt."""

    def __init__(self, result: ValidationResult):
        self.result = result
        super().__init__(f"contract {result.suite!r} is broken by {result.asset!r}; nothing was promoted")


def validate(df: DataFrame, expectations: Sequence[Expectation], suite: str = "", asset: str = "",
             fail_on_error: bool = True, history_path: str | None = None, run_id: str | None = None) -> ValidationResult:
    """Evaluate every rule (one Spark job), then halt on failure.

    With ``history_path`` the result rows are kept there, one partition a run, before anything halts."""
    rows = [r.asDict() for r in contract_stats(df, expectations, suite, asset).collect()]
    rows.sort(key=lambda r: r["expectation_index"])
    result = ValidationResult(all(r["success"] for r in rows), asset, suite, rows)
    if history_path is not None:
        record(df.sparkSession, result, history_path, run_id or uuid.uuid4().hex)
    if not result.success:
        log.error("contract %r violated for %r: %s", suite, asset, result.statistics)
        if fail_on_error:
            raise ContractViolation(result)
    else:
        log.info("contract %r satisfied for %r", suite, asset)
    return result


RESULT_SCHEMA = ("asset string, suite string, expectation_index int, expectation_type string, column_name string, mostly double, "
                 "element_count long, missing_count long, unexpected_count long, unexpected_percent double, success boolean")


def record(spark: SparkSession, result: ValidationResult, path: str, run_id: str) -> None:
    """Add a run's result rows to the table at ``path``; the same run and asset again replace theirs."""
    names = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    rows = spark.createDataFrame([tuple(r[c] for c in names) for r in result.results], RESULT_SCHEMA)
    tagged = rows.withColumn("recorded_at", F.current_timestamp()).withColumn("run_id", F.lit(f"r-{run_id}")).withColumn(
        "asset_key", F.concat(F.lit("a-"), F.sha2("asset", 256)))
    tagged.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "asset_key").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All recorded results: a row for each run, asset and rule."""
    return spark.read.parquet(path).withColumn("run_id", F.expr("substring(run_id, 3)")).drop("asset_key")


def gate(df: DataFrame, expectations: Sequence[Expectation], suite: str = "", asset: str = "",
         history_path: str | None = None, run_id: str | None = None) -> DataFrame:
    """Return ``df`` unchanged if it meets the contract, else raise."""
    validate(df, expectations, suite, asset, True, history_path, run_id)
    return df


def split_rows(flagged: DataFrame, failed: Sequence[int], into: str = "broken_rules") -> tuple[DataFrame, DataFrame]:
    """(rows to promote, rows to quarantine) of flagged rows: a row stays back when it breaks a rule of ``failed``.

    A rule that holds within its tolerance keeps nothing back. Rows to promote lose ``into``; the others keep those of the failed rules."""
    wanted = F.array(*[F.lit(i) for i in failed]).cast("array<int>")
    held = F.filter(into, lambda r: F.array_contains(wanted, r["expectation_index"]))
    return flagged.where(F.size(held) == 0).drop(into), flagged.withColumn(into, held).where(F.size(into) > 0)


def promote(df: DataFrame, expectations: Sequence[Expectation], quarantine_path: str, suite: str = "", asset: str = "",
            run_id: str | None = None, history_path: str | None = None) -> tuple[DataFrame, dict]:
    """R10 without a halt: (rows to promote, summary); the rest is written to the quarantine with the rules it breaks.

    The rows are flagged in one scan and stored once (checkpoint); the verdict, the quarantine and the promoted rows are read from there.
    Quarantine rows lie in one partition a run, so a run that is repeated replaces its own. A failed
    rule about the table itself (row count, missing column) has no rows to hold back and halts.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    run_id = run_id or uuid.uuid4().hex
    flagged = flag_rows(df, expectations).checkpoint()
    result = validate(flagged.drop("broken_rules"), expectations, suite, asset, False, history_path, run_id)
    failed = [r["expectation_index"] for r in result.results if not r["success"]]
    if any(expectations[i].expectation_type in _TABLE for i in failed):
        raise ContractViolation(result)
    good, bad = split_rows(flagged, failed)
    counted = Observation("quarantine")
    bad.withColumns({"quarantined_at": F.current_timestamp(), "run_id": F.lit(f"r-{run_id}")}).observe(
        counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(quarantine_path)
    rows = counted.get["rows"]
    log.info("%d rows of %r quarantined in %s", rows, asset, quarantine_path)
    return good, {"quarantined": rows, "failed_rules": failed, "run_id": run_id}


class ContractRegistry:
    """Named suites; defining an existing name replaces it."""

    def __init__(self) -> None:
        self._suites: dict[str, tuple[Expectation, ...]] = {}

    def define(self, suite: str, expectations: Sequence[Expectation]) -> None:
        log.info("defining contract %r with %d rules", suite, len(expectations))
        self._suites[suite] = tuple(expectations)

    def get(self, suite: str) -> tuple[Expectation, ...]:
        if suite not in self._suites:
            raise KeyError(f"no contract named {suite!r}")
        return self._suites[suite]

    def names(self) -> list[str]:
        return sorted(self._suites)

    def stats(self, df: DataFrame, suite: str, asset: str = "") -> DataFrame:
        return contract_stats(df, self.get(suite), suite, asset)

    def validate(self, df: DataFrame, suite: str, asset: str = "", fail_on_error: bool = True) -> ValidationResult:
        return validate(df, self.get(suite), suite, asset, fail_on_error)
