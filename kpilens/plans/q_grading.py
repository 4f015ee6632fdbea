"""Registered queries: answer grading and run reports (K1-K23), with oracle SQL.

Answers (FIXTURES.md section 3): the assistant turns of `conversations`. For the
number and JSON graders each answer gets a quoted figure and one JSON object
appended, built from `conv_id` and from the truth of the star schema (so the
figures are right, nearly right, wrong, or a known wrong answer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.operators import grading as K
from kpilens.plans.q_explain import drivers_ctes
from kpilens.plans.registry import kpi, register
from kpilens.plans.report import frozen_truth
from kpilens.plans.sql_base import rename, with_

ORACLE: dict[str, str] = {}

# ---- fixed values: answer decoration and the case set ------------------------------------
PROSE = {0: " Returns rose at one centre.",
         1: " Revenue moved with acquisition source BUILDING; the session source differs.",
         2: " No data yet for the current month: it is not complete.",
         3: " A weekend promotion explains it."}
RETURN_WORDS = ["return", "retour", "rückgabe", "devolución"]
SOURCE_WORDS = ["building"]
VOCAB_WORDS = ["acquisition", "session source"]
NO_DATA_WORDS = ["no data", "not complete", "incomplete", "not yet", "no orders"]
ALL_PRESENT = [["revenue", "umsatz"], ["returns", "acquisition", "no data"]]
CASES = [("C1", "why did revenue change last month?", "single_dim,fixed_question"),
         ("C2", "how was last month, anything to watch?", "mechanism_chain,fixed_question"),
         ("C3", "why did revenue change?", "no_driver,fixed_question"),
         ("C4", "show me the last three months", "open_ended,question_variation"),
         ("C5", "which channel grew most?", "ambiguous_kpi,question_variation"),
         ("C6", "revenue and basket size of the last three months?", "vocab_gap,question_variation"),
         ("C7", "how is revenue this month so far?", "truncated_data,question_variation"),
         ("C8", "what was revenue last month?", "fanout_trap,fixed_question")]
# -------------------------------------------------------------------------------------------

ANSWER_EXPRS = [
    "'C' || CAST(conv_id % 8 + 1 AS STRING) AS case_id",
    "turn div 2 AS run_index",
    "conv_id AS seq",
    "length(text) % 3 <> 0 AS fixture_passed",
    "CASE conv_id % 4 WHEN 0 THEN rev_c WHEN 1 THEN rev_c * 1003 div 1000 WHEN 2 THEN rev_c * 102 div 100"
    " ELSE fan_c END AS fig_c",
    "CAST(ROUND(chg * 1000) AS BIGINT) AS pct_t",
    "CASE WHEN conv_id % 7 = 0 THEN CAST(ROUND(mean_aov3 * 100) AS BIGINT) ELSE CAST(ROUND(aov3 * 100) AS BIGINT) END"
    " AS aov_c"]


def _truth(spark, d) -> DataFrame:
    """What the answers are graded against: one row of fields of the frozen truth document (with its rounding)."""
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    wrong = "known_wrong_answers."
    flagged = F.concat("last_month.drivers", "last_month.net_drivers")
    pairs = F.transform(flagged, lambda x: F.struct(x["dimension"].alias("dimension"), x["segment"].alias("segment")))
    return frozen_truth(spark, d).select(
        cents("last_month.headline.revenue").alias("rev_c"), F.col("last_month.vs_previous_month.delta_pct").alias("chg"),
        F.col("last_3_months.headline.revenue").alias("rev3"), F.col("last_3_months.headline.aov").alias("aov3"),
        F.col(wrong + "aov_last_3_months_as_mean_of_monthly").alias("mean_aov3"), F.col("last_month.unusual").alias("truth_unusual"),
        cents(wrong + "revenue_last_month_fanout").alias("fan_c"), cents(wrong + "revenue_last_month_by_item_month").alias("item_c"),
        F.array_sort(F.array_distinct(pairs)).alias("tolerated"), F.col("defaults.last_month").alias("last_month"),
        F.col("defaults.last_3_months").alias("period3"))


def answers(spark, d) -> DataFrame:
    """The answer table: conversation text + quoted figure + JSON object, with the
    fixture's outcome fields (case, run, tags, tokens, cost, latency)."""
    conv = kpi(spark, d).star.conversations.filter(F.col("role") == "assistant")
    # grading costs far more than moving a text, and a file may be a single task
    conv = conv.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id", "turn")
    a = conv.crossJoin(_truth(spark, d)).selectExpr("*", *ANSWER_EXPRS)
    prose = "CASE conv_id % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in PROSE.items()) + " ELSE '' END"
    a = a.selectExpr(
        "*",
        "CASE WHEN conv_id % 3 = 0 THEN format_number(fig_c div 100, 0) ELSE CAST(fig_c div 100 AS STRING) END"
        " || '.' || lpad(CAST(fig_c % 100 AS STRING), 2, '0') AS fig_txt",
        "CAST(fig_c div 100 AS STRING) || '.' || lpad(CAST(fig_c % 100 AS STRING), 2, '0') AS fig_plain",
        "CASE WHEN pct_t < 0 THEN '-' ELSE '+' END || CAST(abs(pct_t) div 10 AS STRING) || '.'"
        " || CAST(abs(pct_t) % 10 AS STRING) || '%' AS pct_txt",
        f"{prose} AS prose",
        "CASE WHEN conv_id % 6 = 0 THEN '\"' || last_month || '\"'"
        " ELSE '[\"' || array_join(period3, '\", \"') || '\"]' END AS period_txt",
        "CASE conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN '{\"dimension\": \"acq_source\", \"segment\": \"BUILDING\"}'"
        " ELSE '{\"dimension\": \"dist_center\", \"segment\": \"NATION_1\"}, {\"dimension\": \"brand\","
        " \"segment\": \"Brand#7\"}' END AS drivers_txt",
        "CAST(aov_c div 100 AS STRING) || '.' || lpad(CAST(aov_c % 100 AS STRING), 2, '0') AS aov_txt")
    a = a.selectExpr(
        "*",
        "text || ' Revenue ' || fig_txt || ' (' || pct_txt || ').' || prose || ' {\"period\": ' || period_txt"
        " || ', \"measure\": \"revenue\", \"value\": ' || fig_plain || ', \"unusual\": '"
        " || CASE WHEN conv_id % 2 = 0 THEN 'true' ELSE 'false' END || ', \"drivers\": [' || drivers_txt"
        " || '], \"aov\": ' || aov_txt || '}' || CASE WHEN conv_id % 5 = 0 THEN '\\n```' ELSE '' END AS output",
        "CASE conv_id % 4 WHEN 0 THEN array() WHEN 1 THEN array('query') WHEN 2 THEN array('query', 'script')"
        " ELSE array('script') END AS tool_calls",
        "array('t' || CAST(conv_id % 3 AS STRING)) AS tags",
        "length(text) AS input_tokens", "CAST(0 AS BIGINT) AS output_tokens",
        "length(text) / 1e6 AS cost_usd", "length(text) / 1000.0 AS latency_s",
        "CAST(NULL AS STRING) AS error")
    return a


def graded(spark, d) -> DataFrame:
    """Answers with their normalised text, numbers, JSON object and typed fields."""
    a = answers(spark, d)
    a = a.withColumn("norm", K.norm_text("output")).withColumn("nums", K.numbers_of("norm")) \
         .withColumn("obj_text", K.last_json_object("output"))
    return a.withColumn("obj", K.answer_fields(F.col("obj_text")))


def _arr(words: list[str]):
    return F.array(*[F.lit(w) for w in words])


def case_grade(g: DataFrame) -> DataFrame:
    """K23 grader per case (each an all_of composition, K14); an error never passes."""
    fig = lambda c: (F.col(c) / 100).cast("double")
    nums, obj, norm = F.col("nums"), F.col("obj"), F.col("norm")
    rev = fig("rev_c")
    empty = F.array().cast("array<struct<dimension:string,segment:string>>")
    c1 = (K.quotes(obj, nums, "value", rev) & K.quotes(obj, nums, "change_pct", F.col("chg"))
          & K.unusual_is(obj, F.col("truth_unusual")) & K.drivers_ok(obj, empty, F.col("tolerated")))
    c2 = K.quotes(obj, nums, "value", rev) & K.says_any(norm, _arr(RETURN_WORDS))
    c3 = (K.quotes(obj, nums, "value", rev) & K.unusual_is(obj, F.lit(False))
          & K.drivers_ok(obj, empty, F.col("tolerated")) & K.no_invented_cause(F.col("output")))
    c4 = K.period_is(F.col("obj_text"), F.col("period3")) & K.quotes(obj, nums, "value", F.col("rev3"))
    c5 = K.says_any(norm, _arr(SOURCE_WORDS)) & K.says_any(norm, _arr(VOCAB_WORDS))
    c6 = (K.quotes(obj, nums, "value", F.col("rev3")) & K.quotes(obj, nums, "aov", F.col("aov3"), 0.02)
          & K.not_number(nums, F.col("mean_aov3"), 0.02))
    c7 = K.says_any(norm, _arr(NO_DATA_WORDS)) & K.not_number(nums, fig("item_c"))
    c8 = K.quotes(obj, nums, "value", rev) & K.not_number(nums, fig("fan_c")) & K.not_number(nums, fig("item_c"))
    cid = F.col("case_id")
    verdict = (F.when(cid == "C1", c1).when(cid == "C2", c2).when(cid == "C3", c3).when(cid == "C4", c4)
                .when(cid == "C5", c5).when(cid == "C6", c6).when(cid == "C7", c7).otherwise(c8))
    return g.withColumn("passed", F.col("error").isNull() & F.coalesce(verdict, F.lit(False)))


def _sel(spark, d, *cols):
    return graded(spark, d).select("conv_id", "turn", *cols)


# ---------------------------------------------------------------- K1-K4
@register("text_norm")
def text_norm(spark, d):
    """K1: normalised answer text."""
    return answers(spark, d).select("conv_id", "turn", K.norm_text("output").alias("norm"))


@register("numbers_in_text")
def numbers_in_text(spark, d):
    """K2: numbers of each answer (count, sum, max)."""
    a = answers(spark, d).withColumn("nums", K.numbers_in("output"))
    return a.select("conv_id", "turn", F.size("nums").alias("n_numbers"),
                    F.aggregate("nums", F.lit(0.0), lambda acc, x: acc + x).alias("sum_numbers"),
                    F.array_max("nums").alias("max_number"))


@register("has_number")
def has_number(spark, d):
    """K3: does the answer quote last month's revenue (0.5 %)?"""
    a = answers(spark, d).withColumn("nums", K.numbers_in("output"))
    return a.select("conv_id", "turn", K.has_number(F.col("nums"), (F.col("rev_c") / 100).cast("double"))
                    .alias("quotes_revenue"))


@register("last_json_object")
def last_json_object(spark, d):
    """K4: the answer object (last-ending, outermost)."""
    return answers(spark, d).select("conv_id", "turn", K.last_json_object("output").alias("json_text"))


# ---------------------------------------------------------------- K5-K15
@register("grade_quotes")
def grade_quotes(spark, d):
    """K5: value and change quoted (JSON field or prose)."""
    g = graded(spark, d)
    return g.select("conv_id", "turn", (K.quotes(F.col("obj"), F.col("nums"), "value", (F.col("rev_c") / 100)
                                                 .cast("double"))
                                        & K.quotes(F.col("obj"), F.col("nums"), "change_pct", F.col("chg")))
                    .alias("passed"))


@register("grade_not_number")
def grade_not_number(spark, d):
    """K6: the fan-out figure is not quoted."""
    g = graded(spark, d)
    return g.select("conv_id", "turn", K.not_number(F.col("nums"), (F.col("fan_c") / 100).cast("double"))
                    .alias("passed"))


@register("grade_drivers")
def grade_drivers(spark, d):
    """K7: driver list: nothing required, only the referee's flags tolerated."""
    g = graded(spark, d)
    empty = F.array().cast("array<struct<dimension:string,segment:string>>")
    req = F.array(F.struct(F.lit("acq_source").alias("dimension"), F.lit("BUILDING").alias("segment")))
    return g.select("conv_id", "turn", K.drivers_ok(F.col("obj"), empty, F.col("tolerated")).alias("passed"),
                    K.drivers_ok(F.col("obj"), req, F.col("tolerated")).alias("passed_required"))


@register("grade_fields")
def grade_fields(spark, d):
    """K8: unusual flag and period list."""
    g = graded(spark, d)
    return g.select("conv_id", "turn", K.unusual_is(F.col("obj"), F.col("truth_unusual")).alias("unusual_ok"),
                    K.period_is(F.col("obj_text"), F.col("period3")).alias("period_ok"))


@register("grade_contains_any")
def grade_contains_any(spark, d):
    """K9: mentions returns in any language."""
    g = graded(spark, d)
    return g.select("conv_id", "turn", K.says_any(F.col("norm"), _arr(RETURN_WORDS)).alias("passed"))


@register("grade_all_present")
def grade_all_present(spark, d):
    """Every item present in one of its forms."""
    g = graded(spark, d)
    items = F.array(*[_arr(x) for x in ALL_PRESENT])
    return g.select("conv_id", "turn", K.all_present(F.col("norm"), items).alias("passed"))


@register("grade_exact")
def grade_exact(spark, d):
    """Exact match after strip + lower (against the raw turn text)."""
    g = graded(spark, d)
    return g.select("conv_id", "turn", K.exact_match(F.col("output"), F.col("text")).alias("passed"),
                    K.exact_match(F.concat(F.lit(" \u00a0"), F.col("text"), F.lit("\n")), F.col("text"))
                    .alias("passed_padded"))


@register("grade_no_cause")
def grade_no_cause(spark, d):
    """No invented cause."""
    return answers(spark, d).select("conv_id", "turn", K.no_invented_cause(F.col("output")).alias("passed"))


@register("grade_used_tool")
def grade_used_tool(spark, d):
    """The answer used the script tool."""
    return answers(spark, d).select("conv_id", "turn", K.used_tool(F.col("tool_calls"), "script").alias("passed"))


@register("diagnose")
def diagnose(spark, d):
    """Which known wrong answer a text quotes."""
    g = graded(spark, d)
    wrong = {"revenue_last_month_fanout": (F.col("fan_c") / 100).cast("double"),
             "revenue_last_month_by_item_month": (F.col("item_c") / 100).cast("double"),
             "aov_last_3_months_as_mean_of_monthly": F.col("mean_aov3")}
    return g.select("conv_id", "turn", K.diagnose(F.col("nums"), wrong).alias("mistakes"))


@register("case_set")
def case_set(spark, d):
    """The case set with expected figures from the truth of this data set."""
    cases = spark.createDataFrame(CASES, "case_id string, question string, tags string")
    t = _truth(spark, d).select((F.col("rev_c") / 100).cast("double").alias("expected_revenue"),
                                F.col("chg").alias("expected_change_pct"), "truth_unusual",
                                F.col("rev3").alias("expected_revenue_3m"), F.col("aov3").alias("expected_aov_3m"),
                                F.size("tolerated").alias("tolerated_drivers"))
    return cases.crossJoin(t)


# ---------------------------------------------------------------- K17-K23
OUTCOME = ("case_id", "run_index", "seq", "passed", "tags", "input_tokens", "output_tokens", "cost_usd", "latency_s", "error", "output")


def run_outcomes(spark, d) -> DataFrame:
    """Every answer of every run with its graded verdict."""
    return case_grade(graded(spark, d)).select(*OUTCOME)


def baseline_outcomes(spark, d) -> DataFrame:
    """A baseline run to compare with: the same answers as recorded by the fixture (FIXTURES.md), not graded."""
    return answers(spark, d).withColumn("passed", F.col("fixture_passed")).select(*OUTCOME)


@register("outcomes")
def outcomes(spark, d):
    """One graded outcome per answer."""
    return case_grade(graded(spark, d)).select("conv_id", "turn", "case_id", "run_index", "passed")


@register("run_pass_rate")
def run_pass_rate(spark, d):
    """Pass rate per run, mean and sample sd."""
    return K.pass_rates(run_outcomes(spark, d))


@register("run_costs")
def run_costs(spark, d):
    """Cost, tokens and latency per task."""
    return K.run_costs(run_outcomes(spark, d))


@register("flaky_cases")
def flaky_cases(spark, d):
    """Cases with both outcomes."""
    return K.flaky_cases(run_outcomes(spark, d))


@register("failure_clusters")
def failure_clusters(spark, d):
    """Failed cases per tag."""
    return K.failure_clusters(run_outcomes(spark, d))


@register("first_failures")
def first_failures(spark, d):
    """First failing outcome per case, first 4 cases."""
    return K.first_failures(run_outcomes(spark, d), 4)


@register("compare_runs")
def compare_runs(spark, d):
    """Graded outcomes against the fixture's outcomes as a baseline."""
    return K.compare_runs(run_outcomes(spark, d), baseline_outcomes(spark, d))


# ================================================================ oracle SQL (DuckDB)
WS_RE2 = K.WS


def norm_sql(x: str) -> str:
    t = f"translate(lower({x}), '{K.NORM_FROM}', '{K.NORM_TO.replace(chr(39), chr(39) * 2)}')"
    for _ in range(2):
        t = f"regexp_replace({t}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    for _ in range(2):
        t = f"regexp_replace({t}, '([0-9]){WS_RE2}([0-9]{{3}})\\b', '\\1\\2', 'g')"
    return f"regexp_replace({t}, '{WS_RE2}+', ' ', 'g')"


def nums_sql(x: str) -> str:
    return f"list_transform(regexp_extract_all({norm_sql(x)}, '{K.NUMBER}'), lambda v: CAST(v AS DOUBLE))"


def close_sql(a: str, b: str, rel: str, ab: str) -> str:
    return f"(ABS({a} - {b}) <= GREATEST({rel} * GREATEST(ABS({a}), ABS({b})), {ab}))"


def has_sql(nums: str, v: str, rel: str = "0.005", ab: str = "0.0") -> str:
    return (f"COALESCE(len(list_filter({nums}, lambda n: {close_sql('n', v, rel, ab)} OR "
            f"(ABS({v}) < 1 AND {close_sql('n', f'({v}) * 100', rel, ab)}))) > 0, false)")


def quotes_sql(field: str, v: str, ab: str = "0.0") -> str:
    rel = "0.0" if ab != "0.0" else "0.005"
    got = f"TRY_CAST(json_extract(obj, '$.{field}') AS DOUBLE)"
    return f"(COALESCE({got} IS NOT NULL AND {close_sql(got, v, rel, ab)}, false) OR {has_sql('nums', v, rel, ab)})"


def not_sql(v: str, ab: str = "0.0") -> str:
    return f"NOT {has_sql('nums', v, '0.0' if ab != '0.0' else '0.005', ab)}"


def says_sql(words: list[str]) -> str:
    lst = "[" + ", ".join(f"'{w}'" for w in words) + "]"
    return f"COALESCE(len(list_filter({lst}, lambda p: instr(norm, {norm_sql('p')}) > 0)) > 0, false)"


DRV_T = "'[{\"dimension\":\"VARCHAR\",\"segment\":\"VARCHAR\"}]'"


def drivers_sql(required: str) -> str:
    m = "g.dimension = w.dimension AND contains(lower(g.segment), lower(w.segment))"
    allowed = f"list_concat({required}, tolerated)"
    return (f"COALESCE(drv IS NOT NULL AND len(list_filter({required}, lambda w: len(list_filter(drv, lambda g: {m})) = 0)) = 0"
            f" AND len(list_filter(drv, lambda g: len(list_filter({allowed}, lambda w: {m})) = 0)) = 0, false)")


UNUSUAL_SQL = "(CASE WHEN json_type(obj, '$.unusual') = 'BOOLEAN' THEN CAST(json_extract(obj, '$.unusual') AS BOOLEAN) END)"
PERIOD_SQL = ("(CASE json_type(obj, '$.period') WHEN 'ARRAY' THEN from_json(json_extract(obj, '$.period'), '[\"VARCHAR\"]')"
              " WHEN 'VARCHAR' THEN [json_extract_string(obj, '$.period')] END)")
NO_CAUSE_SQL = ("NOT COALESCE(len(list_filter([" + ", ".join(f"'{w}'" for w in K.INVENTED_CAUSES) +
                "], lambda w: instr(lower(output), w) > 0)) > 0, false)")

_T_SQL = drivers_ctes("prev1", "cur1", "sale_price", "revenue") + ",\n" + rename(
    drivers_ctes("prev1", "cur1", "net_sale_price", "net_revenue"), "_n",
    ("seg", "c1", "c2", "contrib", "guard", "drv")) + """,
ta AS (SELECT SUM(revenue) AS revenue, SUM(orders) AS orders, SUM(revenue) / SUM(orders) AS aov
       FROM monthly JOIN per USING (month) WHERE per.prev1),
tb AS (SELECT SUM(revenue) AS revenue, SUM(orders) AS orders FROM monthly JOIN per USING (month) WHERE per.cur1),
zb AS (SELECT COUNT(m.mom) AS history, AVG(m.mom) AS hist_mean, STDDEV_SAMP(m.mom) AS hist_sd
       FROM monthly m JOIN per USING (month)
       WHERE per.idx < (SELECT idx FROM per WHERE cur1) AND per.idx >= (SELECT idx FROM per WHERE cur1) - 24),
zc AS (SELECT m.mom, zb.* FROM monthly m JOIN per USING (month) CROSS JOIN zb WHERE per.cur1),
t AS (SELECT
  (SELECT month FROM per WHERE cur1) AS last_month,
  (SELECT CAST(ROUND(revenue * 100) AS BIGINT) FROM monthly JOIN per USING (month) WHERE cur1) AS rev_c,
  (SELECT ROUND((tb.revenue - ta.revenue) / ta.revenue, 4) FROM ta CROSS JOIN tb) AS chg,
  (SELECT COALESCE(history >= 6 AND (ABS((mom - hist_mean) / NULLIF(hist_sd, 0)) >= 2.0
                                      OR (hist_sd = 0 AND mom <> hist_mean)), false) FROM zc) AS truth_unusual,
  (SELECT CAST(ROUND(CAST(SUM(oi.sale_price) AS DOUBLE) * 100) AS BIGINT)
     FROM oi JOIN o ON o.order_id = oi.order_id JOIN oi oi2 ON oi2.order_id = oi.order_id
    WHERE strftime(o.created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)) AS fan_c,
  (SELECT CAST(ROUND(CAST(SUM(sale_price) AS DOUBLE) * 100) AS BIGINT) FROM oi
    WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)) AS item_c,
  (SELECT SUM(revenue) FROM monthly JOIN per USING (month) WHERE cur3) AS rev3,
  (SELECT SUM(revenue) / SUM(orders) FROM monthly JOIN per USING (month) WHERE cur3) AS aov3,
  (SELECT ROUND(AVG(aov), 2) FROM monthly JOIN per USING (month) WHERE cur3) AS mean_aov3,
  (SELECT list(month ORDER BY month) FROM per WHERE cur3) AS period3,
  (SELECT list(DISTINCT {'dimension': dimension, 'segment': segment})
     FROM (SELECT dimension, segment FROM drv UNION SELECT dimension, segment FROM drv_n) x) AS tolerated)"""

_PROSE_SQL = "CASE conv_id % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in PROSE.items()) + " ELSE '' END"

_ANS_SQL = """,
a0 AS (SELECT conv_id, turn, text, 'C' || CAST(conv_id % 8 + 1 AS VARCHAR) AS case_id, turn // 2 AS run_index,
              conv_id AS seq, length(text) % 3 <> 0 AS fixture_passed,
              CASE conv_id % 4 WHEN 0 THEN rev_c WHEN 1 THEN rev_c * 1003 // 1000 WHEN 2 THEN rev_c * 102 // 100
                   ELSE fan_c END AS fig_c,
              CAST(ROUND(chg * 1000) AS BIGINT) AS pct_t,
              CASE WHEN conv_id % 7 = 0 THEN CAST(ROUND(mean_aov3 * 100) AS BIGINT) ELSE CAST(ROUND(aov3 * 100) AS BIGINT)
                   END AS aov_c, t.*
       FROM conversations CROSS JOIN t WHERE role = 'assistant'),
a1 AS (SELECT *,
         CASE WHEN conv_id % 3 = 0 THEN format('{:,}', fig_c // 100) ELSE CAST(fig_c // 100 AS VARCHAR) END
           || '.' || lpad(CAST(fig_c % 100 AS VARCHAR), 2, '0') AS fig_txt,
         CAST(fig_c // 100 AS VARCHAR) || '.' || lpad(CAST(fig_c % 100 AS VARCHAR), 2, '0') AS fig_plain,
         CASE WHEN pct_t < 0 THEN '-' ELSE '+' END || CAST(abs(pct_t) // 10 AS VARCHAR) || '.'
           || CAST(abs(pct_t) % 10 AS VARCHAR) || '%' AS pct_txt,
         """ + _PROSE_SQL + """ AS prose,
         CASE WHEN conv_id % 6 = 0 THEN '"' || last_month || '"'
              ELSE '["' || array_to_string(period3, '", "') || '"]' END AS period_txt,
         CASE conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN '{"dimension": "acq_source", "segment": "BUILDING"}'
              ELSE '{"dimension": "dist_center", "segment": "NATION_1"}, {"dimension": "brand", "segment": "Brand#7"}'
              END AS drivers_txt,
         CAST(aov_c // 100 AS VARCHAR) || '.' || lpad(CAST(aov_c % 100 AS VARCHAR), 2, '0') AS aov_txt
       FROM a0),
ans AS (SELECT *,
         text || ' Revenue ' || fig_txt || ' (' || pct_txt || ').' || prose || ' {"period": ' || period_txt
           || ', "measure": "revenue", "value": ' || fig_plain || ', "unusual": '
           || CASE WHEN conv_id % 2 = 0 THEN 'true' ELSE 'false' END || ', "drivers": [' || drivers_txt
           || '], "aov": ' || aov_txt || '}' || CASE WHEN conv_id % 5 = 0 THEN chr(10) || '```' ELSE '' END AS output,
         CASE conv_id % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['query'] WHEN 2 THEN ['query', 'script']
              ELSE ['script'] END AS tool_calls,
         ['t' || CAST(conv_id % 3 AS VARCHAR)] AS tags, length(text) AS input_tokens, 0 AS output_tokens,
         length(text) / 1e6 AS cost_usd, length(text) / 1000.0 AS latency_s, CAST(NULL AS VARCHAR) AS error
       FROM a1),
g0 AS (SELECT *, """ + norm_sql("output") + " AS norm, " + nums_sql("output") + """ AS nums,
         substr(output, strpos(output, '{'), length(output) - strpos(reverse(output), '}') + 1 - strpos(output, '{') + 1)
           AS obj
       FROM ans),
g AS (SELECT *, from_json(json_extract(obj, '$.drivers'), """ + DRV_T + """) AS drv FROM g0)"""

BASE = with_("fact", "per", "monthly", extra=_T_SQL + _ANS_SQL)

ORACLE["text_norm"] = BASE + "SELECT conv_id, turn, norm FROM g"
ORACLE["numbers_in_text"] = BASE + """SELECT conv_id, turn, len(nums) AS n_numbers,
  ROUND(list_reduce(list_prepend(0.0, nums), lambda acc, x: acc + x), 6) AS sum_numbers,
  ROUND(list_max(nums), 6) AS max_number FROM g"""
ORACLE["has_number"] = BASE + f"SELECT conv_id, turn, {has_sql('nums', 'rev_c / 100.0')} AS quotes_revenue FROM g"
ORACLE["last_json_object"] = BASE + "SELECT conv_id, turn, obj AS json_text FROM g"
ORACLE["grade_quotes"] = BASE + f"""SELECT conv_id, turn,
  {quotes_sql('value', 'rev_c / 100.0')} AND {quotes_sql('change_pct', 'chg')} AS passed FROM g"""
ORACLE["grade_not_number"] = BASE + f"SELECT conv_id, turn, {not_sql('fan_c / 100.0')} AS passed FROM g"
ORACLE["grade_drivers"] = BASE + f"""SELECT conv_id, turn,
  {drivers_sql("[]::STRUCT(dimension VARCHAR, segment VARCHAR)[]")} AS passed,
  {drivers_sql("[{'dimension': 'acq_source', 'segment': 'BUILDING'}]")} AS passed_required FROM g"""
ORACLE["grade_fields"] = BASE + f"""SELECT conv_id, turn, COALESCE({UNUSUAL_SQL} = truth_unusual, false) AS unusual_ok,
  COALESCE({PERIOD_SQL} = period3, false) AS period_ok FROM g"""
ORACLE["grade_contains_any"] = BASE + f"SELECT conv_id, turn, {says_sql(RETURN_WORDS)} AS passed FROM g"
ORACLE["grade_all_present"] = BASE + "SELECT conv_id, turn, " + " AND ".join(
    f"({says_sql(forms)})" for forms in ALL_PRESENT) + " AS passed FROM g"
_STRIP = f"regexp_replace(%s, '^{WS_RE2}+|{WS_RE2}+$', '', 'g')"
ORACLE["grade_exact"] = BASE + f"""SELECT conv_id, turn,
  COALESCE(lower({_STRIP % 'output'}) = lower({_STRIP % 'text'}), false) AS passed,
  COALESCE(lower({_STRIP % "(' ' || chr(160) || text || chr(10))"}) = lower({_STRIP % 'text'}), false) AS passed_padded
FROM g"""
ORACLE["grade_no_cause"] = BASE + f"SELECT conv_id, turn, {NO_CAUSE_SQL} AS passed FROM g"
ORACLE["grade_used_tool"] = BASE + "SELECT conv_id, turn, COALESCE(list_contains(tool_calls, 'script'), false) AS passed FROM g"


def _diag_sql() -> str:
    parts = []
    for name, v in sorted({"revenue_last_month_fanout": "fan_c / 100.0",
                           "revenue_last_month_by_item_month": "item_c / 100.0",
                           "aov_last_3_months_as_mean_of_monthly": "mean_aov3"}.items()):
        parts.append(f"CASE WHEN (CASE WHEN {v} >= 1000 THEN {has_sql('nums', v, '0.001', '0.0')} "
                     f"ELSE {has_sql('nums', v, '0.0', '0.005')} END) THEN '{name}' END")
    return f"NULLIF(concat_ws(', ', {', '.join(parts)}), '')"


ORACLE["diagnose"] = BASE + f"SELECT conv_id, turn, {_diag_sql()} AS mistakes FROM g"
ORACLE["case_set"] = BASE + "SELECT c.*, rev_c / 100.0 AS expected_revenue, ROUND(chg, 6) AS expected_change_pct, " \
    "truth_unusual, ROUND(rev3, 6) AS expected_revenue_3m, ROUND(aov3, 6) AS expected_aov_3m, " \
    "len(tolerated) AS tolerated_drivers FROM t CROSS JOIN (VALUES " + ", ".join(
        f"('{c}', '{q}', '{tg}')" for c, q, tg in CASES) + ") c(case_id, question, tags)"

_CASE_SQL = f"""(error IS NULL AND COALESCE(CASE case_id
  WHEN 'C1' THEN {quotes_sql('value', 'rev_c / 100.0')} AND {quotes_sql('change_pct', 'chg')}
       AND COALESCE({UNUSUAL_SQL} = truth_unusual, false) AND {drivers_sql("[]::STRUCT(dimension VARCHAR, segment VARCHAR)[]")}
  WHEN 'C2' THEN {quotes_sql('value', 'rev_c / 100.0')} AND {says_sql(RETURN_WORDS)}
  WHEN 'C3' THEN {quotes_sql('value', 'rev_c / 100.0')} AND COALESCE({UNUSUAL_SQL} = false, false)
       AND {drivers_sql("[]::STRUCT(dimension VARCHAR, segment VARCHAR)[]")} AND {NO_CAUSE_SQL}
  WHEN 'C4' THEN COALESCE({PERIOD_SQL} = period3, false) AND {quotes_sql('value', 'rev3')}
  WHEN 'C5' THEN {says_sql(SOURCE_WORDS)} AND {says_sql(VOCAB_WORDS)}
  WHEN 'C6' THEN {quotes_sql('value', 'rev3')} AND {quotes_sql('aov', 'aov3', '0.02')} AND {not_sql('mean_aov3', '0.02')}
  WHEN 'C7' THEN {says_sql(NO_DATA_WORDS)} AND {not_sql('item_c / 100.0')}
  ELSE {quotes_sql('value', 'rev_c / 100.0')} AND {not_sql('fan_c / 100.0')} AND {not_sql('item_c / 100.0')} END, false))"""

ORACLE["outcomes"] = BASE + f"SELECT conv_id, turn, case_id, run_index, {_CASE_SQL} AS passed FROM g"

_RUN = BASE.rstrip() + f""",
fxo AS (SELECT case_id, run_index, seq, {_CASE_SQL} AS passed, tags, input_tokens, output_tokens, cost_usd,
              latency_s, error, output FROM g)
"""
ORACLE["run_pass_rate"] = _RUN + """SELECT COUNT(*) AS n_runs, ROUND(AVG(rate), 6) AS mean_pass,
  ROUND(COALESCE(STDDEV_SAMP(rate), 0.0), 6) AS stdev_pass
FROM (SELECT run_index, AVG(CAST(passed AS INT)) AS rate FROM fxo GROUP BY 1) r"""
ORACLE["run_costs"] = _RUN + """SELECT COUNT(*) AS outcomes, ROUND(AVG(cost_usd), 6) AS cost_per_task,
  ROUND(AVG(input_tokens + output_tokens), 6) AS tokens_per_task, ROUND(AVG(latency_s), 6) AS mean_latency FROM fxo"""
ORACLE["flaky_cases"] = _RUN + "SELECT case_id FROM fxo GROUP BY case_id HAVING COUNT(DISTINCT passed) > 1"
ORACLE["failure_clusters"] = _RUN + """,
pc AS (SELECT case_id, bool_and(passed) AS ok,
              arg_max(CASE WHEN error IS NOT NULL THEN list_append(tags, 'crash') ELSE tags END, (run_index, seq)) AS t
       FROM fxo GROUP BY case_id)
SELECT tag, SUM(CASE WHEN NOT ok THEN 1 ELSE 0 END) AS failed_cases, COUNT(*) AS cases
FROM (SELECT case_id, ok, UNNEST(CASE WHEN len(t) > 0 THEN t ELSE ['untagged'] END) AS tag FROM pc) x GROUP BY tag"""
ORACLE["first_failures"] = _RUN + f"""SELECT case_id, run_index, seq,
  CASE WHEN error IS NOT NULL THEN 'RAISED: ' || error ELSE trim(regexp_replace(output, '{WS_RE2}+', ' ', 'g')) END AS shown
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY case_id ORDER BY run_index, seq) AS r FROM fxo WHERE NOT passed) f
WHERE r = 1 ORDER BY run_index, seq LIMIT 4"""
ORACLE["compare_runs"] = _RUN.rstrip() + """,
ba AS (SELECT run_index, cost_usd, fixture_passed AS passed FROM ans),
ra AS (SELECT AVG(rate) AS mp, COALESCE(STDDEV_SAMP(rate), 0.0) AS sd
       FROM (SELECT run_index, AVG(CAST(passed AS INT)) AS rate FROM fxo GROUP BY 1) x),
rb AS (SELECT AVG(rate) AS mp FROM (SELECT run_index, AVG(CAST(passed AS INT)) AS rate FROM ba GROUP BY 1) x),
ca AS (SELECT AVG(cost_usd) AS c FROM fxo), cb AS (SELECT AVG(cost_usd) AS c FROM ba)
SELECT ROUND(ra.mp - rb.mp, 6) AS delta_pass, ROUND(CASE WHEN cb.c <> 0 THEN ca.c / cb.c END, 6) AS cost_ratio,
       cb.c = 0 AS cost_ratio_infinite, (ra.mp - rb.mp) <= ra.sd AS within_one_sd
FROM ra CROSS JOIN rb CROSS JOIN ca CROSS JOIN cb"""
