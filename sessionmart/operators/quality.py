"""Data-quality checks as Spark queries.

A check is declared once (``Check``) and has two readings:

* ``violations(check, models)`` -- the DataFrame of failing rows/values, the
  same relation a declarative test would select (zero rows = pass).
* ``run_checks(checks, models)`` -- one summary row per check
  (check_name, model, severity, violations, status) as a DataFrame.

The summary takes one pass over each model and one shuffle for all checks. A
row emits an entry for every key check it takes part in and for
every row-level check it violates; a parent row of a reference check emits its
key. Entries are counted per (check, key) -- partial counts first, so a key or a
violation shared by very many rows collapses in each task -- and the counts per
check follow from them.

Uniqueness is found in two exact phases. The pass above counts 64-bit hashes in
place of the keys, so no key text is shuffled: a hash seen once proves its key
unique. Only if some hash was seen more often, a second pass over those models
takes the keys with such hashes (a semi join; the hashes are read from a
written table, so they are broadcast only while their size allows) and counts
them by their text. What the first pass found is written when the query is
built. Both passes must see the same rows, as tables and scans give them; a model
with a random or unordered ``limit`` in it is to be written first.

Failure counts follow the usual generic-test semantics:
  not_null            rows where the column is NULL
  unique              distinct non-NULL values that occur more than once
  unique_combination  distinct key combinations that occur more than once
  accepted_values     distinct non-NULL values outside the list
  relationships       child rows with a non-NULL key absent from the parent
  expression          rows matching the violation predicate
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionmart.config import scratch_path
from sessionmart.operators.joins import anti_join

NOT_NULL = "not_null"
UNIQUE = "unique"
UNIQUE_COMBINATION = "unique_combination"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"
EXPRESSION = "expression"

ROW_LEVEL = (NOT_NULL, ACCEPTED_VALUES, EXPRESSION)


@dataclass(frozen=True)
class Check:
    name: str
    model: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    severity: str = "error"
    to_model: str | None = None
    to_field: str | None = None
    # For EXPRESSION checks: DataFrame -> violation predicate.
    predicate: Callable[[DataFrame], Column] | None = field(default=None, compare=False)
    # For EXPRESSION checks: the columns reported for each violating row.
    report: tuple[str, ...] = ()


def not_null(model: str, col: str, severity: str = "error") -> Check:
    return Check(f"not_null_{model}_{col}", model, NOT_NULL, (col,), severity=severity)


def unique(model: str, col: str, severity: str = "error") -> Check:
    return Check(f"unique_{model}_{col}", model, UNIQUE, (col,), severity=severity)


def unique_combination(model: str, cols: Sequence[str], severity: str = "error") -> Check:
    return Check(f"unique_combination_{model}_{'__'.join(cols)}", model,
                 UNIQUE_COMBINATION, tuple(cols), severity=severity)


def accepted_values(model: str, col: str, values: Sequence, severity: str = "error") -> Check:
    return Check(f"accepted_values_{model}_{col}", model, ACCEPTED_VALUES, (col,),
                 tuple(values), severity=severity)


def relationships(model: str, col: str, to_model: str, to_field: str,
                  severity: str = "error") -> Check:
    return Check(f"relationships_{model}_{col}__{to_model}_{to_field}", model, RELATIONSHIPS,
                 (col,), severity=severity, to_model=to_model, to_field=to_field)


def expression(name: str, model: str, predicate: Callable[[DataFrame], Column],
               report: Sequence[str], severity: str = "error") -> Check:
    return Check(name, model, EXPRESSION, severity=severity, predicate=predicate,
                 report=tuple(report))


def _row_predicate(check: Check, df: DataFrame) -> Column:
    """Violation predicate of a row-level check (NULL never counts as a violation)."""
    if check.kind == NOT_NULL:
        return F.col(check.columns[0]).isNull()
    if check.kind == ACCEPTED_VALUES:
        return F.coalesce(~F.col(check.columns[0]).isin(*check.values), F.lit(False))
    return F.coalesce(check.predicate(df), F.lit(False))


def violations(check: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    """The failing rows (or failing values/keys) of one check."""
    df = models[check.model]
    if check.kind == NOT_NULL:
        return df.where(_row_predicate(check, df))
    if check.kind == EXPRESSION:
        return df.where(_row_predicate(check, df)).select(*check.report)
    if check.kind == ACCEPTED_VALUES:
        c = check.columns[0]
        return (df.where(_row_predicate(check, df))
                .groupBy(F.col(c).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))
    if check.kind in (UNIQUE, UNIQUE_COMBINATION):
        base = df.where(F.col(check.columns[0]).isNotNull()) if check.kind == UNIQUE else df
        return (base.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > F.lit(1)))
    if check.kind == RELATIONSHIPS:
        parent = models[check.to_model].select(F.col(check.to_field).alias(check.columns[0]))
        return anti_join(df.select(check.columns[0]), parent, check.columns[0])
    raise ValueError(f"unknown check kind {check.kind!r}")


def _key_text(*cols: str) -> Column:
    """One text per key: each value with its length in front, NULL marked apart."""
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.concat(*parts)


def _entry(i: int, when: Column | None, key: Column | None, child: int = 1, parent: int = 0, hash_: Column | None = None) -> Column:
    e = F.struct(F.lit(i).alias("check_id"), (F.lit(None) if hash_ is None else hash_).cast("bigint").alias("hash"),
                 (F.lit(None) if key is None else key).cast("string").alias("key"),
                 F.lit(child).cast("bigint").alias("n"), F.lit(parent).cast("bigint").alias("parents"))
    return e if when is None else F.when(when, e)


def _unique_entry(i: int, check: Check, with_key: bool) -> Column:
    """A row's key in a uniqueness check: its hash, and on demand its text."""
    whole = F.col(check.columns[0]) if check.kind == UNIQUE else _key_text(*check.columns)
    return _entry(i, F.col(check.columns[0]).isNotNull() if check.kind == UNIQUE else None, whole if with_key else None,
                  hash_=F.xxhash64(*check.columns))


def _emitted(by_model: Mapping[str, Sequence[Column]], models: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for model, entries in by_model.items():
        found = F.filter(F.array(*entries), lambda e: e.isNotNull())
        rows = models[model].select(F.inline(found))
        out = rows if out is None else out.unionByName(rows)
    return out


def _entries(checks: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """(check_id, hash, key, n, parents) of all checks, one pass over each model; a uniqueness check gives hashes only."""
    by_model: dict[str, list[Column]] = {}
    for i, ch in enumerate(checks):
        mine = by_model.setdefault(ch.model, [])
        if ch.kind in (NOT_NULL, EXPRESSION):
            mine.append(_entry(i, _row_predicate(ch, models[ch.model]), None))
        elif ch.kind == ACCEPTED_VALUES:
            mine.append(_entry(i, _row_predicate(ch, models[ch.model]), F.col(ch.columns[0])))
        elif ch.kind in (UNIQUE, UNIQUE_COMBINATION):
            mine.append(_unique_entry(i, ch, with_key=False))
        elif ch.kind == RELATIONSHIPS:
            mine.append(_entry(i, F.col(ch.columns[0]).isNotNull(), F.col(ch.columns[0])))
            by_model.setdefault(ch.to_model, []).append(
                _entry(i, F.col(ch.to_field).isNotNull(), F.col(ch.to_field), child=0, parent=1))
        else:
            raise ValueError(f"unknown check kind {ch.kind!r}")
    return _emitted(by_model, models)


def _repeated_keys(checks: Sequence[Check], models: Mapping[str, DataFrame], repeated: DataFrame) -> DataFrame:
    """(check_id, found): keys that occur more than once, among those whose hashes do (``repeated``: check_id, hash)."""
    by_model: dict[str, list[Column]] = {}
    for i, ch in enumerate(checks):
        if ch.kind in (UNIQUE, UNIQUE_COMBINATION):
            by_model.setdefault(ch.model, []).append(_unique_entry(i, ch, with_key=True))
    return (_emitted(by_model, models).join(repeated, ["check_id", "hash"], "left_semi")
            .groupBy("check_id", "key").agg(F.sum("n").alias("n")).where("n > 1")
            .groupBy("check_id").agg(F.count(F.lit(1)).alias("found")))


def run_checks(checks: Sequence[Check], models: Mapping[str, DataFrame],
               same_rows: Mapping[str, str] | None = None) -> DataFrame:
    """One row per check: check_name, model, severity, violations, status.

    ``same_rows`` names models that hold exactly the rows and keys of another
    one (a view that only adds columns): a key check on such a model takes the
    result of the same check on the other model and is not counted twice.
    """
    same_rows = same_rows or {}
    counted: list[Check] = []
    source: list[int] = []
    at: dict[tuple, int] = {}
    for ch in checks:
        model = same_rows.get(ch.model, ch.model) if ch.kind in (UNIQUE, UNIQUE_COMBINATION) else ch.model
        key = (ch.kind, model, ch.columns)
        if ch.kind not in (UNIQUE, UNIQUE_COMBINATION) or key not in at:
            at[key] = len(counted)
            counted.append(replace(ch, model=model))
            source.append(len(counted) - 1)
        else:
            source.append(at[key])
    spark = models[checks[0].model].sparkSession
    per_key = (_entries(counted, models).groupBy("check_id", "hash", "key")
               .agg(F.sum("n").alias("n"), F.sum("parents").alias("parents")))
    kinds = [c.kind for c in counted]

    def of(*names: str) -> Column:
        return F.col("check_id").isin([i for i, k in enumerate(kinds) if k in names])
    failing = (F.when(of(UNIQUE, UNIQUE_COMBINATION), (F.col("n") > 1).cast("bigint"))
               .when(of(ACCEPTED_VALUES), F.lit(1).cast("bigint"))
               .when(of(RELATIONSHIPS), F.when(F.col("parents") == 0, F.col("n")).otherwise(F.lit(0)))
               .otherwise(F.col("n")))
    first = scratch_path(spark, "check-counts")
    (per_key.select("check_id", "hash", failing.alias("failing")).where("failing > 0")
     .groupBy("check_id", "hash").agg(F.sum("failing").alias("found")).write.parquet(first))
    first = spark.read.parquet(first)
    counts, repeated = first.where("hash is null").select("check_id", "found"), first.where("hash is not null").select("check_id", "hash")
    if not repeated.isEmpty():
        counts = counts.union(_repeated_keys(counted, models, repeated))
    listed = spark.createDataFrame(
        [(c.name, c.model, c.severity, s) for c, s in zip(checks, source)],
        "check_name string, model string, severity string, check_id int")
    violations = F.coalesce("found", F.lit(0)).cast("bigint")
    status = (F.when(F.col("violations") == F.lit(0), F.lit("pass"))
              .when(F.col("severity") == F.lit("warn"), F.lit("warn"))
              .otherwise(F.lit("fail")))
    return (listed.join(counts, "check_id", "left")
            .select("check_name", "model", "severity", violations.alias("violations"))
            .withColumn("status", status))
