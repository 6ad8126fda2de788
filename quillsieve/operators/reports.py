"""Stage reports as long tables (section, key, measure, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import DEFAULT_METRICS
from quillsieve.functions.scales import report_band
from quillsieve.operators.gates import metric
from quillsieve.operators.stats import moment_columns, statistics_of
from quillsieve.session import stage

SCHEMA = "section string, key string, measure string, value double"


def _long(df: DataFrame, section: str, key: Column, measures: dict[str, Column]) -> DataFrame:
    """Unpivot aggregate columns into report rows."""
    entries = F.array(*[F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value")) for m, c in measures.items()])
    return df.select(F.lit(section).alias("section"), key.cast("string").alias("key"), F.inline(entries))


def _sections(df: DataFrame, keys: dict[str, Column], inputs: dict[str, Column], aggregates: list[Column], label: str) -> DataFrame:
    """A staged table of aggregates over all rows (section ``all``) and per section and key,
    from one scan: each row is handed to its groups, and partial aggregates come before the
    shuffle. A row without a key is in no group of that section. Aggregates of a single
    section take their inputs through :func:`_within`."""
    def entry(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"))

    entries = F.array(entry("all", F.lit(None)), *[entry(s, k) for s, k in keys.items()])
    rows = df.select(F.inline(entries), *[c.alias(n) for n, c in inputs.items()])
    return stage(rows.where((F.col("section") == "all") | F.col("key").isNotNull()).groupBy("section", "key").agg(*aggregates), label)


def _within(section: str, column: Column) -> Column:
    return F.when(F.col("section") == section, column)


def _of(table: DataFrame, section: str, measures: dict[str, Column], name: str | None = None) -> DataFrame:
    """Report rows of one section."""
    key = F.lit("all") if section == "all" else F.col("key")
    return _long(table.where(F.col("section") == section), name or section, key, measures)


def _statistics(df: DataFrame, table: DataFrame, section: str, values: dict[str, Column], keep: tuple[str, ...]) -> DataFrame:
    """Rows of moments and medians; the moments are in the row over everything."""
    told = statistics_of(df, values, table.where("section = 'all'").first())
    return _long(told, section, F.col("metric"), {m: F.col(m) for m in keep})


def _over_all(values: dict[str, Column]) -> dict[str, Column]:
    """Values that only the row over everything aggregates."""
    return {n: _within("all", F.col(f"__v{i}")) for i, n in enumerate(values)}


def _inputs(values: dict[str, Column]) -> dict[str, Column]:
    return {f"__v{i}": c for i, c in enumerate(values.values())}


def generation_report(df: DataFrame, reasons: str = "reject_reasons") -> DataFrame:
    """Totals, accepted and rejected rows, and domains and difficulty bands of the
    accepted ones. ``df`` holds all generated rows with their reject reasons. One scan."""
    accepted = F.size(reasons) == 0
    table = _sections(
        df, {"domain": F.when(accepted, F.col("metadata.domain")), "difficulty": F.when(accepted, report_band(F.col("metadata.difficulty")))},
        {"__ok": accepted}, [F.count(F.lit(1)).alias("n"), F.count_if("__ok").alias("ok")], "generation-report")
    return (
        _of(table, "all", {
            "total_generated": F.col("n"), "passed_initial_filter": F.col("ok"), "rejected": F.col("n") - F.col("ok"),
        }, "totals")
        .unionByName(_of(table, "domain", {"count": F.col("n")}))
        .unionByName(_of(table, "difficulty", {"count": F.col("n")}))
    )


def assessment_report(df: DataFrame, metrics: tuple[str, ...] = (*DEFAULT_METRICS, "overall_score")) -> DataFrame:
    """Verification counts, mean, median and std per metric, and per domain the mean
    overall score and the verification rate. Two scans, the second for the medians."""
    verified = F.coalesce(F.col("verification.verified"), F.lit(False))
    values = {m: metric(m) for m in metrics}
    table = _sections(
        df, {"domain": F.coalesce(F.col("metadata.domain"), F.lit("unknown"))},
        {"__ok": verified, "__score": metric("overall_score"), **_inputs(values)},
        [F.count(F.lit(1)).alias("n"), F.count_if("__ok").alias("ok"), F.avg("__score").alias("m"), F.avg(F.col("__ok").cast("double")).alias("v"),
         *moment_columns(_over_all(values))], "assessment-report")
    return (
        _of(table, "all", {
            "total_assessed": F.col("n"), "passed_verification": F.col("ok"), "failed_verification": F.col("n") - F.col("ok"),
        }, "totals")
        .unionByName(_statistics(df, table, "score", values, ("mean", "median", "std")))
        .unionByName(_of(table, "domain", {"mean_score": F.col("m"), "verification_success_rate": F.col("v")}))
    )


def filtering_report(df: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Input, selected and rejected rows, overall score of the selected rows, their
    domains and difficulty bands, and the duplicate counts (a one-row frame with
    clusters and removed). ``df`` holds every candidate with its filtering struct. Two
    scans, the second for the median."""
    chosen = F.coalesce(F.col("filtering.selected"), F.lit(False))
    values = {"overall_score": F.when(chosen, metric("overall_score"))}
    table = _sections(
        df, {"domain": F.when(chosen, F.col("metadata.domain")), "difficulty": F.when(chosen, report_band(F.col("metadata.difficulty")))},
        {"__s": chosen, **_inputs(values)}, [F.count(F.lit(1)).alias("n"), F.count_if("__s").alias("s"), *moment_columns(_over_all(values))], "filtering-report")
    report = (
        _of(table, "all", {
            "input_samples": F.col("n"), "selected_samples": F.col("s"), "rejected_samples": F.col("n") - F.col("s"),
        }, "totals")
        .unionByName(_statistics(df, table, "quality", values, ("mean", "median", "min", "max")))
        .unionByName(_of(table, "domain", {"count": F.col("n")}))
        .unionByName(_of(table, "difficulty", {"count": F.col("n")}))
    )
    if duplicates is not None:
        report = report.unionByName(_long(duplicates, "deduplication", F.lit("all"), {
            "duplicate_clusters_found": F.col("clusters"), "duplicates_removed": F.col("removed"),
        }))
    return report


def advanced_report(df: DataFrame, methods: tuple[str, ...] = ("ifd", "limr", "less", "ensemble")) -> DataFrame:
    """Totals, mean, median and std per method, mean score and selected share per domain,
    mean learning effect, and the rationale and answer means with their correlation.
    ``df`` holds every assessed row with an ``advanced`` struct. Two scans, the second
    for the medians."""
    selected = F.coalesce(F.col("advanced.final_selected"), F.lit(False))
    values = {m: F.col(f"advanced.{m}_score") for m in methods}
    r, a = _within("all", F.col("__r")), _within("all", F.col("__a"))
    table = _sections(
        df, {"domain": F.coalesce(F.col("metadata.domain"), F.lit("unknown"))},
        {"__s": selected, "__l": F.col("advanced.loss_reduction"), "__g": F.col("advanced.accuracy_improvement"), "__e": F.col("advanced.ensemble_score"),
         "__r": metric("rationale_quality"), "__a": metric("answer_accuracy"), **_inputs(values)},
        [F.count(F.lit(1)).alias("n"), F.count_if("__s").alias("s"), F.avg(F.col("__s").cast("double")).alias("share"), F.avg("__e").alias("m"),
         F.avg("__l").alias("l"), F.avg("__g").alias("g"), F.avg(r).alias("r"), F.avg(a).alias("a"), F.corr(r, a).alias("c"),
         *moment_columns(_over_all(values))], "advanced-report")
    return (
        _of(table, "all", {"assessed_samples": F.col("n"), "final_selected": F.col("s")}, "totals")
        .unionByName(_statistics(df, table, "method", values, ("mean", "median", "std")))
        .unionByName(_of(table, "domain", {"mean_score": F.col("m"), "selected_ratio": F.col("share")}))
        .unionByName(_of(table, "all", {
            "mean_loss_reduction": F.col("l"), "mean_accuracy_improvement": F.col("g"),
        }, "learning_effect"))
        .unionByName(_of(table, "all", {
            "rationale_mean": F.col("r"), "answer_mean": F.col("a"), "correlation": F.col("c"),
        }, "rationale_vs_answer"))
    )


def rationale_answer_relation(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean rationale quality, mean answer accuracy and their Pearson correlation (null
    when one of them does not vary)."""
    r, a = F.col("rationale_quality"), F.col("answer_accuracy")
    both = r.isNotNull() & a.isNotNull()
    spread = (F.stddev_pop(F.when(both, r)) > 0) & (F.stddev_pop(F.when(both, a)) > 0)
    return df.groupBy(*(by or [])).agg(
        F.avg(r).alias("rationale_mean"), F.avg(a).alias("answer_mean"),
        F.when(spread, F.corr(r, a)).alias("correlation"),
    )


