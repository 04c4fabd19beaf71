"""Data-quality rules.

``run_rules`` evaluates every rule in ONE aggregate over the table (one scan,
one tiny shuffle), where a per-rule ``filter().count()`` would scan 1 + N times.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brightlake.functions.dates import as_ts_lit
from brightlake.functions.rules import CUSTOMER_SEGMENTS, ORDER_STATUSES

WARN_PCT = 1  # failures below 1 % of the rows tested -> warn (strict <)


# Rule names and bounds of D3-D5.

def order_rules(max_quantity: int = 100, max_discount: float = 1) -> dict[str, Column]:
    """D3; the bounds can be set tighter."""
    return {
        "no_null_order_id": F.col("order_id").isNotNull(),
        "positive_amount": F.col("total_amount") > 0,
        "valid_status": F.col("status").isin(ORDER_STATUSES),
        "valid_quantity": F.col("quantity").between(1, max_quantity),
        "non_negative_discount": F.col("discount").between(0, max_discount),
    }


def customer_rules() -> dict[str, Column]:
    """D4."""
    return {
        "no_null_customer_id": F.col("customer_id").isNotNull(),
        "valid_email": F.col("email").contains("@"),
        "valid_segment": F.col("segment").isin(CUSTOMER_SEGMENTS),
    }


def product_rules() -> dict[str, Column]:
    """D5."""
    return {
        "no_null_product_id": F.col("product_id").isNotNull(),
        "positive_price": F.col("base_price") > 0,
        "valid_rating": F.col("rating").between(0, 5),
    }


def status_of(failed, tested) -> Column:
    """0 -> pass; failed < 1 % of tested -> warn; else fail (integer-exact)."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    tested = F.col(tested) if isinstance(tested, str) else tested
    return (F.when(failed == 0, "pass")
             .when(failed * 100 < tested * WARN_PCT, "warn")
             .otherwise("fail"))


def rule_counts(rules: dict[str, Column], null_fails: bool = False) -> list[Column]:
    """Aggregates of all rules: ``rows_tested``, and the rows that fail each rule by its name."""
    out = [F.count(F.lit(1)).alias("rows_tested")]
    for name, pred in rules.items():
        bad = ~F.coalesce(pred, F.lit(False)) if null_fails else ~pred
        out.append(F.count_if(bad).alias(name))
    return out


def result_rows(counts: DataFrame, rules, table_name: str, layer: str, run_at) -> DataFrame:
    """D1/D2 rows from one row of ``rule_counts``."""
    long = counts.unpivot(["rows_tested"], list(rules), "check_name", "rows_failed")
    return long.select(
        F.lit(table_name).alias("table_name"), F.lit(layer).alias("layer"), "check_name",
        status_of("rows_failed", "rows_tested").alias("status"),
        "rows_tested", "rows_failed", as_ts_lit(run_at).alias("run_at"))


def observed_rules(df: DataFrame, rules: dict[str, Column], name: str,
                   null_fails: bool = False) -> tuple[DataFrame, Observation]:
    """``df`` with its rule counts observed by whatever action writes it: no scan of their own."""
    seen = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    return df.observe(seen, *rule_counts(rules, null_fails)), seen


def observed_counts(seen: Observation) -> dict[str, int] | None:
    """Counts of an ``observed_rules`` write that has ended; None where the plan that ran had
    no counters left (Spark may replace an empty plan altogether)."""
    try:
        counts = seen.get
    except Py4JJavaError:
        return None
    return {k: int(v or 0) for k, v in counts.items()} or None


def counted_results(spark: SparkSession, counts: dict, rules, table_name: str, layer: str,
                    run_at) -> DataFrame:
    """D1/D2 rows of known rule counts."""
    row = [tuple(int(counts.get(c) or 0) for c in ("rows_tested", *rules))]
    schema = ", ".join(f"`{c}` long" for c in ("rows_tested", *rules))
    return result_rows(spark.createDataFrame(row, schema), rules, table_name, layer, run_at)


def run_rules(df: DataFrame, table_name: str, layer: str, rules: dict[str, Column],
              run_at, null_fails: bool = False) -> DataFrame:
    """One row per rule with status, rows tested and rows failed.

    A NULL predicate does not count as a failure (as ``filter(~cond)``) unless
    ``null_fails=True``.
    """
    return result_rows(df.agg(*rule_counts(rules, null_fails)), rules, table_name, layer, run_at)


def dq_gate(results: DataFrame, as_of, hours: int = 1, layer: str = "silver") -> DataFrame:
    """One decision row over the last ``hours`` of results for ``layer``.

    No results -> pass. Any ``fail`` -> ``dq_failed``. ``failed_checks`` holds
    the distinct failed rule names (bounded by the rule set).
    """
    now = as_ts_lit(as_of)
    recent = results.filter((F.col("run_at") >= now - F.make_interval(hours=F.lit(hours)))
                            & (F.col("run_at") <= now) & (F.col("layer") == layer))
    s = recent.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "fail").alias("failures"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "fail", F.col("check_name"))))
         .alias("failed_checks"))
    return s.withColumn("decision", F.when(F.col("failures") > 0, "dq_failed")
                        .otherwise("dq_passed"))


def assert_gate(gate: DataFrame) -> dict:
    """Raise-on-fail variant of the gate (reads the single decision row)."""
    row = gate.first().asDict()
    if row["decision"] == "dq_failed":
        raise RuntimeError(f"quality gate failed: {row['failed_checks']}")
    return row


def column_tests(df: DataFrame, table_name: str, unique=(), not_null=()) -> DataFrame:
    """D8 + D9: unique and not-null tests, one row per (column, test).

    One pass per table: the first unique column is grouped (partial
    aggregation) and the not-null counts ride along as per-value partial
    counts, so the table is computed once for all of its tests. Further
    unique columns get their own grouped pass. Result rows come from one
    row of totals (``explode``), with no union of re-scans.
    """
    unique, not_null = list(unique), list(not_null)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)]
    entries, parts = [], []
    if unique:
        first = unique[0]
        per_value = df.groupBy(first).agg(F.count(F.lit(1)).alias("_n"), *nulls)
        totals = per_value.agg(
            _dup_count(F.col(first), F.col("_n")).alias("_dup_0"),
            *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}")
              for i in range(len(not_null))])
        entries.append((first, "unique", "_dup_0"))
    else:
        totals = df.agg(*nulls)
    entries += [(c, "not_null", f"_null_{i}") for i, c in enumerate(not_null)]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"),
                              F.col(v).cast("bigint").alias("failures"))
                     for c, t, v in entries])
    parts.append(totals.select(F.explode(rows).alias("_e")).select("_e.*"))
    for c in unique[1:]:
        dup = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).agg(
            _dup_count(F.col(c), F.col("_n")).cast("bigint").alias("failures"))
        parts.append(dup.select(F.lit(c).alias("column_name"), F.lit("unique").alias("test"),
                                "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "test",
                      F.col("failures").cast("bigint").alias("failures"),
                      F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def _dup_count(value, n):
    """Rows beyond the first of each non-NULL value (NULL values are not duplicates)."""
    return F.coalesce(F.sum(F.when(value.isNotNull() & (n > 1), n - 1)), F.lit(0))


def data_present(df: DataFrame, condition: Column | None = None) -> bool:
    """Non-empty test that reads at most one row; ``condition`` narrows it, for
    example to a partition or a date."""
    return len((df if condition is None else df.filter(condition)).take(1)) > 0


def missing_tables(tables: dict[str, DataFrame], condition: Column | None = None) -> list[str]:
    """D10 for several tables: names of those without a (matching) row."""
    return [name for name, df in tables.items() if not data_present(df, condition)]


def pass_rate(results: DataFrame) -> DataFrame:
    """Share of passing results x 100."""
    return results.agg(F.avg(F.when(F.col("status") == "pass", 100.0).otherwise(0.0))
                       .alias("pass_rate"))
