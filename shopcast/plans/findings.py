"""Run every analysis question (Q01-Q14) and write the findings (S10).

Insights are templated from the computed evidence tables only; the numbers
come from tiny aggregated results (a handful of rows), never from the fact.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame

from shopcast.functions.labels import ASSORTMENT, PROMO2_MEMBER, PROMO2_ROUND, WEEKDAY, in_order, label_columns
from shopcast.plans import questions as Q
from shopcast.plans.context import PanelContext, build_context
from shopcast.session import materialize
from shopcast.sources.sinks import write_findings

QUESTION_TEXT = {
    "q01": "Are promotions distributed similarly between the training and forecast periods?",
    "q02": "How do sales behave before, during and after state holidays?",
    "q03": "What seasonal patterns do sales show?",
    "q04": "How strongly are sales and customers related?",
    "q05": "How much of the promotion effect comes from footfall versus basket size?",
    "q06": "Which stores gain most from promotions?",
    "q07": "How do opening and closing patterns vary by weekday and store type?",
    "q08": "Do stores that open every weekday sell differently at weekends?",
    "q09": "How does assortment relate to sales?",
    "q10": "Does distance to the nearest competitor affect sales?",
    "q11": "How does a competitor opening affect a store's sales?",
    "q12": "How much of the sales variance is between stores?",
    "q13": "Is the continuing promotion (Promo2) effective?",
    "q14": "What data-quality issues must the pipeline handle?",
}


def _fmt(v, spec=".1f"):
    return "n/a" if v is None else format(v, spec)


def _rows(df: DataFrame, key: str) -> dict:
    """A small evidence table by one of its columns."""
    return {r[key]: r for r in df.collect()}


def _q01(t):
    r = t["q01_chi2"].first()
    return f"Yates chi-square on promo share: {_fmt(r.chi2, '.2f')} (p = {_fmt(r.p_value, '.3g')})."


def _q02(t):
    r = _rows(t["q02_phase"], "HolidayPhase")
    said = [f"{p} {_fmt(r[p].vs_normal_pct, '+.1f')}%" for p in (Q.PHASE_BEFORE, Q.PHASE_DURING, Q.PHASE_AFTER) if p in r]
    return f"Against normal days, mean sales around state holidays change by: {', '.join(said) or 'n/a'}."


def _q03(t):
    r = [x for x in t["q03_month"].collect() if x.index_vs_year is not None]
    if not r:
        return "No trading rows."
    hi, lo = max(r, key=lambda x: x.index_vs_year), min(r, key=lambda x: x.index_vs_year)
    return f"Month {hi.Month} is strongest (index {_fmt(hi.index_vs_year, '.3f')}), month {lo.Month} weakest ({_fmt(lo.index_vs_year, '.3f')})."


def _q04(t):
    r = t["q04_corr"].first()
    return f"Pearson {_fmt(r.pearson, '.3f')}, Spearman {_fmt(r.spearman, '.3f')} between sales and customers."


def _q05(t):
    r = t["q05_decomposition"].first()
    return (f"Promotions lift weekday sales by {_fmt(r.lift_sales_pct)}%; footfall explains "
            f"{_fmt(r.share_customers_pct, '.0f')}% and basket size {_fmt(r.share_basket_pct, '.0f')}% of the log lift.")


def _q06(t):
    r = _rows(t["q06_quartiles"], "uplift_quartile").get(Q.QUARTILE_LABELS[-1])
    c = t["q06_corr"].first()
    share = _fmt(r.share_of_total_incremental) if r else "n/a"
    return (f"The quarter of stores with the largest uplift earns {share}% of all incremental sales; baseline and uplift "
            f"correlate by {_fmt(c.corr_baseline_uplift, '.3f')} over {c.stores} stores.")


def _q07(t):
    r = [x for x in t["q07_weekday"].collect() if x.open_rate is not None]
    if not r:
        return "No rows."
    hi, lo = max(r, key=lambda x: x.open_rate), min(r, key=lambda x: x.open_rate)
    return (f"Stores open most on {WEEKDAY[hi.DayOfWeek]} ({_fmt(100 * hi.open_rate)}%) and least on "
            f"{WEEKDAY[lo.DayOfWeek]} ({_fmt(100 * lo.open_rate)}%).")


def _q08(t):
    r = t["q08_mann_whitney"].first()
    return (f"Mann-Whitney U = {_fmt(r.u_statistic, '.1f')} (p = {_fmt(r.p_value, '.3g')}) for the "
            "Saturday/weekday ratio between segments." if r else "Only one segment present.")


def _q09(t):
    r = t["q09_assortment"].collect()
    if not r:
        return "No trading rows."
    best = max(r, key=lambda x: x.mean_sales)
    return f"Assortment {ASSORTMENT.get(best.Assortment, best.Assortment)} has the highest mean sales ({_fmt(best.mean_sales, ',.0f')}) over {best.stores} stores."


def _q10(t):
    r = _rows(t["q10_spearman"], "scope")
    said = [f"{s} {_fmt(r[s].spearman, '+.3f')} ({r[s].stores} stores)" for s in ("all", "le_500", "gt_500") if s in r]
    return f"Spearman correlation of competitor distance and mean sales: {', '.join(said) or 'n/a'}."


def _q11(t):
    r = {x.bucket_order: x for x in t["q11_buckets"].collect()}
    if not r:
        return "No competitor opened within the panel."
    first, last = r[min(r)], r[max(r)]
    return (f"Relative to the mean before the opening, sales are {_fmt(first.mean_relative_sales, '.3f')} at {first.Bucket} days "
            f"and {_fmt(last.mean_relative_sales, '.3f')} at {last.Bucket} days.")


def _q12(t):
    r = t["q12_variance"].first()
    return f"{_fmt(100 * r.share_between if r.share_between is not None else None)}% of sales variance lies between stores."


def _q13(t):
    a, p = _rows(t["q13_active"], "IsPromo2Active").get(1), _rows(t["q13_participation"], "Promo2").get(1)
    return (f"{PROMO2_ROUND[1]}: {_fmt(a.lift_vs_dormant_pct if a else None, '+.1f')}% against dormant rounds; "
            f"{PROMO2_MEMBER[1].lower()}: {_fmt(p.gap_vs_non_participants_pct if p else None, '+.1f')}% against the other stores.")


def _q14(t):
    r = [x for x in t["q14_quality"].collect() if x["count"]]
    worst = sorted(r, key=lambda x: -x.pct)[:3]
    return "Most frequent: " + "; ".join(f"{x.issue} {_fmt(x.pct)}%" for x in worst) + "." if worst else "No issue found."


#: Insight of each question, from its small evidence tables.
INSIGHTS = {"q01": _q01, "q02": _q02, "q03": _q03, "q04": _q04, "q05": _q05, "q06": _q06, "q07": _q07, "q08": _q08, "q09": _q09,
            "q10": _q10, "q11": _q11, "q12": _q12, "q13": _q13, "q14": _q14}
#: Fixed order of the tables with an ordinal label (T02).
ORDERS = {"q02_phase": ("HolidayPhase", [Q.PHASE_NORMAL, Q.PHASE_BEFORE, Q.PHASE_DURING, Q.PHASE_AFTER]),
          "q06_quartiles": ("uplift_quartile", Q.QUARTILE_LABELS), "q10_bands": ("DistanceBand", Q.DISTANCE_LABELS),
          "q11_buckets": ("Bucket", Q.EVENT_LABELS)}


def evidence(key: str, df: DataFrame) -> DataFrame:
    """An evidence table as reports show it: computed once, with labels beside
    codes, ordinal labels in their order."""
    df = label_columns(materialize(df, f"evidence-{key}"))
    return in_order(df, *ORDERS[key]) if key in ORDERS else df


def run_all(ctx: PanelContext) -> list[Q.Finding]:
    out = []
    for qkey, question in QUESTION_TEXT.items():
        tables = {k: evidence(k, fn(ctx)) for k, fn in Q.QUESTIONS.items() if k.startswith(qkey + "_")}
        out.append(Q.Finding(key=qkey, question=question, tables=tables, insight=INSIGHTS[qkey](tables)))
    return out


def main(argv: list[str]) -> None:
    from shopcast.session import get_spark
    sf_dir, out_dir = argv[1], argv[2]
    spark = get_spark()
    ctx = build_context(spark, sf_dir)
    write_findings(spark, run_all(ctx), out_dir).show(truncate=80)


if __name__ == "__main__":
    main(sys.argv)
