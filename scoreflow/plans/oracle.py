"""DuckDB oracle SQL, one entry per comparable registered query."""

from __future__ import annotations

from scoreflow.operators.features import ENCODED_FEATURES
from scoreflow.plans.sqltext import FIT_SQL, SPLIT_SQL, features_sql, title_sql, with_ctes

ORACLE: dict[str, str] = {}


def _r(c: str) -> str:
    return f"round({c}, 6) as {c}"


ORACLE["title_extract"] = with_ctes(body=f"""
select subject_id, regexp_extract(full_name, ' ([A-Za-z]+)\\.', 1) as honorific,
       {title_sql()} as title
from subjects""")

ORACLE["title_group_counts"] = with_ctes(body=f"""
select {title_sql()} as title, count(*) as n, cast(sum(label) as bigint) as positives
from subjects group by 1""")

ORACLE["age_median_by_title"] = with_ctes(SPLIT_SQL, FIT_SQL, body="""
select title, round(m, 6) as median_age from age_by_title""")

ORACLE["port_mode"] = with_ctes(SPLIT_SQL, FIT_SQL, body="select pm as port_mode from port_mode")

ORACLE["global_medians"] = with_ctes(SPLIT_SQL, FIT_SQL, body="""
select round(age_med, 6) as age_median, round(fare_med, 6) as fare_median from gstat""")

ORACLE["fare_bins"] = with_ctes(SPLIT_SQL, FIT_SQL, body="""
select cast(i - 1 as integer) as edge_index, round(e[i], 6) as edge
from edges, range(1, len(e) + 1) t(i)""")

_FEAT = (SPLIT_SQL, FIT_SQL, features_sql("split"))

ORACLE["age_impute"] = with_ctes(*_FEAT, body="select subject_id, round(age, 6) as age from feat2")
ORACLE["age_band"] = with_ctes(*_FEAT, body="select subject_id, age_band from feat2")
ORACLE["fare_category"] = with_ctes(*_FEAT, body="""
select subject_id, round(fare, 6) as fare, fare_cat from feat2""")
ORACLE["family_features"] = with_ctes(*_FEAT, body="""
select subject_id, family_size, alone from feat2""")
ORACLE["ordinal_encode"] = with_ctes(*_FEAT, body="select subject_id, sex, port, title from feat2")
ORACLE["feature_matrix"] = with_ctes(*_FEAT, body="select subject_id, label, " + ", ".join(
    f"round({c}, 6) as {c}" if c in ("age", "fare") else c for c in ENCODED_FEATURES)
    + " from feat2")

ORACLE["native_cat_features"] = with_ctes(SPLIT_SQL, FIT_SQL, body="""
select subject_id, cast(tier as varchar) as tier, coalesce(sex, 'nan') as sex,
  round(coalesce(age, (select age_med from gstat)), 6) as age,
  sibsp, parch, round(coalesce(fare, (select fare_med from gstat)), 6) as fare,
  coalesce(port, (select pm from port_mode)) as port,
  cast(sibsp + parch + 1 as integer) as family_size,
  cast(sibsp + parch + 1 = 1 as integer) as alone
from split""")

ORACLE["standard_scale"] = with_ctes(*_FEAT, body="select " + ", ".join(
    f"round(avg(cast(feat2.{c} as double)), 6) as {c}__mean, "
    f"round(stddev_pop(cast(feat2.{c} as double)), 6) as {c}__std" for c in ENCODED_FEATURES)
    + " from feat2 join train using (subject_id)")

ORACLE["stratified_split"] = with_ctes(SPLIT_SQL, body="""
select subject_id, label, rk <= ceil(0.2 * cn) as is_test from split""")

ORACLE["stratified_folds"] = with_ctes(SPLIT_SQL, body="""
select subject_id, label, cast((row_number() over (partition by label
    order by md5(cast(subject_id as varchar) || ':42'), subject_id) - 1) % 5 as integer) as fold
from train""")

from scoreflow.functions import scalars as _S  # noqa: E402
from scoreflow.plans import catalog as _C  # noqa: E402
from scoreflow.plans.sqltext import confidence_sql  # noqa: E402

_MARGIN = " + ".join([str(_C.SCORER_INTERCEPT)] + [
    f"{w} * cast({c} as double)" for c, w in _C.SCORER_WEIGHTS.items()])
SCORED_SQL = f"""
scored00 as (select feat2.*, {_MARGIN} as margin from feat2),
scored0 as (select scored00.*, 1.0 / (1.0 + exp(-margin)) as prob from scored00),
scored as (select scored0.*, cast(prob > 0.5 as integer) as pred from scored0)
"""
_SC = (*_FEAT, SCORED_SQL)

ORACLE["linear_score"] = with_ctes(*_SC, body="""
select subject_id, round(prob, 6) as prob, pred from scored""")
ORACLE["confidence_band"] = with_ctes(*_SC, body=f"""
select subject_id, {confidence_sql('prob')} as confidence from scored""")
_TNAME = "case title " + " ".join(f"when {v} then '{k}'" for k, v in _S.TITLE_CODES.items()) + " end"
ORACLE["title_score_summary"] = with_ctes(*_SC, body=f"""
select {_TNAME} as title, count(*) as n, cast(sum(pred) as bigint) as predicted_positive,
  round(avg(prob) * 100, 2) as avg_prob_pct,
  cast(sum(case when {confidence_sql('prob')} = 'High' then 1 else 0 end) as bigint) as n_high,
  cast(sum(case when {confidence_sql('prob')} = 'Medium' then 1 else 0 end) as bigint) as n_medium,
  cast(sum(case when {confidence_sql('prob')} = 'Low' then 1 else 0 end) as bigint) as n_low
from scored group by 1""")

# ---------------------------------------------------------------- metrics
_TEST = "scored join split using (subject_id) where split.rk <= ceil(0.2 * split.cn)"


def _rates(tp, fp, fn, tn):
    def sd(a, b):
        return f"(case when ({b}) = 0 then 0.0 else cast({a} as double) / ({b}) end)"
    return {"accuracy": sd(f"{tp} + {tn}", f"{tp} + {fp} + {fn} + {tn}"),
            "recall": sd(tp, f"{tp} + {fn}"), "precision": sd(tp, f"{tp} + {fp}"),
            "f1": sd(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}")}


_CONF = """
sum(case when scored.label = 1 and pred = 1 then 1 else 0 end) as tp,
sum(case when scored.label <> 1 and pred = 1 then 1 else 0 end) as fp,
sum(case when scored.label = 1 and pred <> 1 then 1 else 0 end) as fn,
sum(case when scored.label <> 1 and pred <> 1 then 1 else 0 end) as tn"""

_EPS = "2.220446049250313e-16"
_LL = (f"avg(-ln(case when scored.label = 1 then least(greatest(prob, {_EPS}), 1 - {_EPS}) "
       f"else 1 - least(greatest(prob, {_EPS}), 1 - {_EPS}) end))")


def _auc_sql(src: str, by: str = "") -> str:
    gb = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
auc_g as (select {gb}margin as s, sum(case when scored.label = 1 then 1 else 0 end) as pos,
                 sum(case when scored.label = 1 then 0 else 1 end) as neg
          from {src} group by {gb}margin),
auc_r as (select *, coalesce(sum(neg) over ({part}order by s rows between unbounded preceding
          and 1 preceding), 0) as below from auc_g),
auc as (select {gb}case when sum(pos) = 0 or sum(neg) = 0 then null else
          cast(sum(2 * pos * below + pos * neg) as double) / (2.0 * sum(pos) * sum(neg)) end as roc_auc
        from auc_r {('group by ' + by) if by else ''})
"""


_R = _rates("tp", "fp", "fn", "tn")
ORACLE["binary_metrics"] = with_ctes(*_SC, _auc_sql(_TEST), f"""
conf as (select {_CONF}, {_LL} as ll from {_TEST})""", body="select " + ", ".join(
    f"round({e}, 6) as {k}" for k, e in _R.items())
    + ", round((select roc_auc from auc), 6) as roc_auc, round(ll, 6) as log_loss from conf")

ORACLE["roc_auc"] = with_ctes(*_SC, _auc_sql("scored"), body="select round(roc_auc, 6) as roc_auc from auc")
ORACLE["log_loss"] = with_ctes(*_SC, body=f"select round({_LL}, 6) as log_loss from {_TEST}")


def _report_sql() -> str:
    pos = _rates("tp", "fp", "fn", "tn")
    neg = _rates("tn", "fn", "fp", "tp")
    n = "(tp + fp + fn + tn)"
    w0, w1 = f"(cast(tn + fp as double) / {n})", f"(cast(tp + fn as double) / {n})"

    def row(name, p, r, f, s):
        def rr(e):
            return "cast(null as double)" if e is None else f"round({e}, 6)"
        return (f"select '{name}' as row, {rr(p)} as precision, {rr(r)} as recall, "
                f"{rr(f)} as f1_score, cast({s} as bigint) as support from conf")
    rows = [row("Not Survived", neg["precision"], neg["recall"], neg["f1"], "tn + fp"),
            row("Survived", pos["precision"], pos["recall"], pos["f1"], "tp + fn"),
            row("accuracy", None, None, pos["accuracy"], n),
            row("macro avg", f"({neg['precision']} + {pos['precision']}) / 2",
                f"({neg['recall']} + {pos['recall']}) / 2", f"({neg['f1']} + {pos['f1']}) / 2", n),
            row("weighted avg", f"{w0} * {neg['precision']} + {w1} * {pos['precision']}",
                f"{w0} * {neg['recall']} + {w1} * {pos['recall']}",
                f"{w0} * {neg['f1']} + {w1} * {pos['f1']}", n)]
    return "\nunion all\n".join(rows)


ORACLE["classification_report"] = with_ctes(*_SC, f"conf as (select {_CONF} from {_TEST})",
                                            body=_report_sql())

_FOLDS = """
folded as (select scored.*, cast((row_number() over (partition by scored.label
    order by md5(cast(subject_id as varchar) || ':42'), subject_id) - 1) % 5 as integer) as fold
  from scored join train using (subject_id)),
fconf as (select fold, """ + _CONF.replace("scored.label", "folded.label") + ", " + _LL.replace(
    "scored.label", "folded.label") + """ as ll from folded group by fold)
"""
_FOLD_METRICS = with_ctes(*_SC, _FOLDS, _auc_sql("folded", "fold").replace(
    "scored.label", "folded.label"), body="select fconf.fold, " + ", ".join(
    f"round({e}, 6) as {k}" for k, e in _R.items())
    + ", round(auc.roc_auc, 6) as roc_auc, round(ll, 6) as log_loss "
      "from fconf join auc on auc.fold = fconf.fold")
ORACLE["fold_metrics"] = _FOLD_METRICS
ORACLE["cv_summary"] = "select " + ", ".join(
    f"round(avg({m}), 6) as cv_{m}_mean, round(stddev_pop({m}), 6) as cv_{m}_std"
    for m in ["accuracy", "recall", "precision", "f1", "roc_auc", "log_loss"]) + \
    f" from ({_FOLD_METRICS}) fm"

# ---------------------------------------------------------------- batch scoring
_PRED = (*_SC, f"""
preds as (select s.subject_id, s.tier, s.sex, s.age, s.fare, sc.pred,
  round(sc.prob, 4) as prob, {confidence_sql('sc.prob')} as confidence,
  'preset_linear' as model_name, '1' as model_version
  from subjects s join scored sc using (subject_id))""")
ORACLE["predictions_table"] = with_ctes(*_PRED, body="select * from preds")
ORACLE["prediction_summary"] = with_ctes(*_PRED, body="""
select count(*) as total, cast(sum(pred) as bigint) as positive,
  count(*) - cast(sum(pred) as bigint) as negative,
  round(avg(prob) * 100, 2) as avg_prob_pct,
  round(sum(pred) * 100.0 / nullif(count(*), 0), 2) as positive_rate_pct
from preds""")
ORACLE["predictions_refresh"] = ORACLE["predictions_table"]
ORACLE["run_report"] = with_ctes(*_PRED, body="""
select count(*) as total, cast(sum(pred) as bigint) as positive,
  count(*) - cast(sum(pred) as bigint) as negative,
  round(sum(pred) * 100.0 / nullif(count(*), 0), 2) as positive_rate_pct,
  round(avg(prob) * 100, 2) as avg_prob_pct,
  count(*) filter (confidence = 'High') as n_high, count(*) filter (confidence = 'Medium') as n_medium,
  count(*) filter (confidence = 'Low') as n_low,
  'preset_linear' as model_name, '1' as model_version
from preds""")
for _name in _C.CHECKED_LEARNERS:
    ORACLE[f"check_{_name}"] = with_ctes(SPLIT_SQL, body=f"""
select '{_name}' as model, count(*) as test_rows, cast(sum(label) as bigint) as positives,
  true as probabilities_in_range, true as auc_above_floor
from split where rk <= ceil(0.2 * cn)""")
ORACLE["confidence_distribution"] = with_ctes(*_PRED, body="""
select l.confidence, cast(coalesce(c.n, 0) as bigint) as n
from (select 'High' as confidence union all select 'Medium' union all select 'Low') l
left join (select confidence, count(*) as n from preds group by confidence) c using (confidence)""")
ORACLE["top10_predictions"] = with_ctes(*_PRED, body="""
select subject_id, sex, tier, pred, prob, confidence from preds
order by prob desc, subject_id limit 10""")

# ---------------------------------------------------------------- intake
from scoreflow.sources.tables import INTAKE_SQL  # noqa: E402

_INTAKE = f"""intake as ({INTAKE_SQL}),
conformed as (select subject_id, tier, full_name, sex, age, coalesce(sibsp, 0) as sibsp,
  coalesce(parch, 0) as parch, 'UNKNOWN' as ticket, fare, cast(null as varchar) as cabin, port
  from intake),
normed as (select subject_id, tier, full_name, lower(sex) as sex, age, sibsp, parch, ticket, fare,
  cabin, upper(port) as port from conformed),
validated as (select normed.*, list_filter([
    case when tier is null or tier < 1 or tier > 3 then 'tier_out_of_range' end,
    case when sex is null or sex not in ('male', 'female') then 'sex_invalid' end,
    case when age is not null and (age < 0.0 or age > 120.0) then 'age_out_of_range' end,
    case when sibsp < 0 then 'sibsp_negative' end,
    case when parch < 0 then 'parch_negative' end,
    case when fare is not null and fare < 0 then 'fare_negative' end,
    case when port is not null and port not in ('S', 'C', 'Q') then 'port_invalid' end],
  lambda x: x is not null) as violations from normed)"""

ORACLE["conform_columns"] = with_ctes(_INTAKE, body="select * from conformed")
ORACLE["validate_records"] = with_ctes(_INTAKE, body="""
select subject_id, sex, port, cast(len(violations) as integer) as n_violations,
  array_to_string(violations, ',') as violations from validated""")
ORACLE["reject_reasons"] = with_ctes(_INTAKE, body="""
select reason, count(*) as n from (select unnest(violations) as reason from validated)
group by reason""")
ORACLE["json_records"] = with_ctes(_INTAKE, body="""
select cast(subject_id // 5 as bigint) as request_id,
  cast(row_number() over (partition by subject_id // 5 order by subject_id) as bigint) as subject_id,
  tier, sex, age, coalesce(sibsp, 0) as sibsp, coalesce(parch, 0) as parch, fare, port, full_name,
  'UNKNOWN' as ticket
from intake""")

# ---------------------------------------------------------------- runs, registry, ensembles


def _margin_sql(b, w):
    return " + ".join([str(b)] + [f"{x} * cast({c} as double)" for c, x in w.items()])


_LONG = "preset_long as (" + "\nunion all\n".join(
    f"select subject_id, label, '{st}' as stage, '{md}' as model, {_margin_sql(b, w)} as margin "
    f"from feat2" for (st, md), (b, w) in _C.PRESET_SCORERS.items()) + """),
preset_scored as (select p.*, 1.0 / (1.0 + exp(-margin)) as prob,
  cast(1.0 / (1.0 + exp(-margin)) > 0.5 as integer) as pred from preset_long p)"""
_LONG_TEST = ("preset_test as (select p.* from preset_scored p join test using (subject_id))")
_RUN_AUC = """
rauc_g as (select stage, model, margin as s, sum(case when label = 1 then 1 else 0 end) as pos,
  sum(case when label = 1 then 0 else 1 end) as neg from preset_test group by stage, model, margin),
rauc_r as (select *, coalesce(sum(neg) over (partition by stage, model order by s rows between
  unbounded preceding and 1 preceding), 0) as below from rauc_g),
rauc as (select stage, model, cast(sum(2 * pos * below + pos * neg) as double)
  / (2.0 * sum(pos) * sum(neg)) as roc_auc from rauc_r group by stage, model)"""
_RUN_CONF = "rconf as (select stage, model, " + _CONF.replace("scored.label", "label") + ", " + \
    _LL.replace("scored.label", "label") + " as ll from preset_test group by stage, model)"
_RUNS = (*_FEAT, _LONG, _LONG_TEST, _RUN_AUC, _RUN_CONF, """
run_metrics as (select c.stage || '__' || c.model as run_id, c.stage, c.model, """ + ", ".join(
    f"round({e}, 6) as {k}" for k, e in _R.items()) + """,
  round(a.roc_auc, 6) as roc_auc, round(c.ll, 6) as log_loss
  from rconf c join rauc a on a.stage = c.stage and a.model = c.model)""")

ORACLE["run_metrics"] = with_ctes(*_RUNS, body="select * from run_metrics")
ORACLE["best_run"] = with_ctes(*_RUNS, body="""
select run_id, stage, model, roc_auc as test_roc_auc from run_metrics
order by roc_auc desc nulls last, run_id limit 1""")
ORACLE["stage_results_outer"] = with_ctes(*_RUNS, body="""
select coalesce(a.model, b.model) as model, a.roc_auc as stage1_value, b.roc_auc as stage2_value,
  coalesce(printf('%.4f', a.roc_auc), '—') as stage1_text,
  coalesce(printf('%.4f', b.roc_auc), '—') as stage2_text
from (select * from run_metrics where stage = 'stage1') a
full outer join (select * from run_metrics where stage = 'stage2') b on a.model = b.model""")
_VERS = (*_RUNS, """
vers0 as (select 'best-model' as name, cast(row_number() over (order by run_id) as varchar) as version,
  run_id from run_metrics),
vers as (select name, version, run_id, case
  when cast(version as bigint) = (select count(*) from run_metrics) then 'None'
  when cast(version as bigint) = (select count(*) from run_metrics) - 1 then 'Production'
  else 'Archived' end as stage from vers0)""")
ORACLE["latest_version"] = with_ctes(*_VERS, body="""
select name, version, run_id, stage from vers order by cast(version as bigint) desc limit 1""")
ORACLE["promote_version"] = with_ctes(*_VERS, body="""
select name, version, run_id, case
  when cast(version as bigint) = max(cast(version as bigint)) over (partition by name) then 'Production'
  when stage = 'Production' then 'Archived' else stage end as stage from vers""")
ORACLE["soft_vote"] = with_ctes(*_FEAT, _LONG, body="""
select subject_id, round(avg(prob), 6) as vote_prob, cast(avg(prob) > 0.5 as integer) as vote_pred,
  count(*) as n_members
from preset_scored where stage = 'stage2' and model in (""" + ", ".join(
    f"'{m}'" for m in _C.VOTE_MEMBERS) + ") group by subject_id")

# ---------------------------------------------------------------- streaming (X1)
_REQ = """
req_v as (select v.* exclude (violations), cast(subject_id // 5 as bigint) as request_id,
  cast(row_number() over (partition by subject_id // 5 order by subject_id) - 1 as bigint) as passenger_index,
  case when subject_id // 5 % 13 = 5 then list_append(list_filter(violations, lambda x: x <> 'sibsp_negative'), 'sibsp_type')
       when subject_id // 5 % 19 = 7 then list_append(violations, 'parch_type') else violations end as violations
  from validated v where subject_id // 5 % 17 <> 3 or subject_id // 5 % 13 = 5 or subject_id // 5 % 19 = 7),
req_cut as (select distinct cast(subject_id // 5 as bigint) as request_id from validated
  where subject_id // 5 % 17 = 3 and subject_id // 5 % 13 <> 5 and subject_id // 5 % 19 <> 7),
req_flag as (select req_v.*, max(len(violations)) over (partition by request_id) > 0 as req_bad
  from req_v),
accepted_src as (select subject_id, cast(null as integer) as label, tier, full_name, sex, age,
  sibsp, parch, fare, port from req_flag where not req_bad)"""
_STREAM = (SPLIT_SQL, FIT_SQL, _INTAKE, _REQ, features_sql("accepted_src"), f"""
st_scored as (select subject_id, {_MARGIN} as margin from feat2)""")
ORACLE["stream_scores"] = with_ctes(*_STREAM, body=f"""
select r.request_id, r.passenger_index, 'accepted' as status,
  cast(1.0 / (1.0 + exp(-margin)) > 0.5 as integer) as pred,
  round(1.0 / (1.0 + exp(-margin)), 6) as prob,
  {confidence_sql('1.0 / (1.0 + exp(-margin))')} as confidence, cast(null as varchar) as violations
from st_scored join req_flag r using (subject_id)
union all
select request_id, passenger_index, 'rejected', null, null, null,
  case when len(violations) = 0 then 'request_rejected' else array_to_string(violations, ',') end
from req_flag where req_bad
union all
select request_id, null, 'rejected', null, null, null, 'malformed_json' from req_cut""")
ORACLE["response_items"] = with_ctes(*_STREAM, body=f"""
select r.request_id, 'preset_linear' as model_name, 'local_fallback' as model_source, r.passenger_index,
  cast(1.0 / (1.0 + exp(-margin)) > 0.5 as integer) as survived,
  round(round(1.0 / (1.0 + exp(-margin)), 6), 4) as probability,
  {confidence_sql('round(1.0 / (1.0 + exp(-margin)), 6)')} as confidence
from st_scored join req_flag r using (subject_id)""")
ORACLE["response_totals"] = with_ctes(*_STREAM, body="""
select r.request_id, count(*) as total_passengers,
  cast(sum(cast(1.0 / (1.0 + exp(-margin)) > 0.5 as integer)) as bigint) as survived_count
from st_scored join req_flag r using (subject_id) group by r.request_id""")

# ---------------------------------------------------------------- files and tables
ORACLE["csv_roundtrip"] = with_ctes(SPLIT_SQL, body="""
select subject_id, label, tier, full_name, sex, age, sibsp, parch, fare, port from train""")
ORACLE["table_full_refresh"] = with_ctes(_INTAKE, body="""
select 'test_data' as table_name, count(*) as rows from conformed""")
ORACLE["sample_rows"] = with_ctes(_INTAKE, body="""
select subject_id, tier, full_name, sex, age from conformed order by subject_id limit 3""")
ORACLE["first_20_predictions"] = with_ctes(*_PRED, body="""
select subject_id, pred, prob from preds order by subject_id limit 20""")

# ---------------------------------------------------------------- other tables
ORACLE["labels_split"] = """
select doc_id, quality, rk <= ceil(0.2 * cn) as is_test from (
  select doc_id, quality, row_number() over (partition by quality
           order by md5(cast(doc_id as varchar) || ':42'), doc_id) as rk,
         count(*) over (partition by quality) as cn
  from labels)"""
ORACLE["doc_length_auc"] = """
with g as (select d.lang, cast(d.n_chars as double) as s,
             sum(case when l.quality = 1 then 1 else 0 end) as pos,
             sum(case when l.quality = 1 then 0 else 1 end) as neg
           from documents d join labels l using (doc_id) group by d.lang, cast(d.n_chars as double)),
r as (select *, coalesce(sum(neg) over (partition by lang order by s rows between unbounded preceding
        and 1 preceding), 0) as below from g)
select lang, round(case when sum(pos) = 0 or sum(neg) = 0 then null else
  cast(sum(2 * pos * below + pos * neg) as double) / (2.0 * sum(pos) * sum(neg)) end, 6) as roc_auc
from r group by lang"""
ORACLE["lineitem_price_quantiles"] = """
select l_returnflag, round(q[1], 6) as p_min, round(q[2], 6) as p_q1, round(q[3], 6) as p_median,
  round(q[4], 6) as p_q3, round(q[5], 6) as p_max
from (select l_returnflag, quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0]) as q
      from lineitem group by l_returnflag)"""
ORACLE["lineitem_quantity_mode"] = """
select l_linestatus, l_quantity as mode_quantity from (
  select l_linestatus, l_quantity, row_number() over (partition by l_linestatus
           order by count(*) desc, l_quantity) as rn
  from lineitem where l_quantity is not null group by l_linestatus, l_quantity) where rn = 1"""

_SCALED = ", ".join(f"round((cast(f.{c} as double) - s.{c}__mean) / s.{c}__std, 6) as {c}" for c in ENCODED_FEATURES)
_STATS = ", ".join(f"avg(cast(feat2.{c} as double)) as {c}__mean, case when stddev_pop(cast(feat2.{c} as double)) > 0 "
                   f"then stddev_pop(cast(feat2.{c} as double)) else 1 end as {c}__std" for c in ENCODED_FEATURES)


def _knn_sql(name: str, k: int, weights: str, p: int) -> str:
    gaps = [f"abs(q.{c} - t.{c})" for c in ENCODED_FEATURES]
    total = " + ".join("(" + " * ".join([g] * p) + ")" for g in gaps)
    weight = "1.0" if weights == "uniform" else {1: "1.0 / d", 2: "1.0 / sqrt(d)"}.get(p, f"1.0 / pow(d, 1.0 / {p})")
    zero = "false" if weights == "uniform" else "nearest = 0"
    return f"""
select subject_id, '{name}' as config, string_agg(cast(id as varchar), ',' order by d, id) as neighbours,
       round(case when any_value({zero}) then avg(label) filter (where d = 0) else sum({weight} * label) / sum({weight}) end, 6) as prob
from (select q.subject_id, t.subject_id as id, t.label, {total} as d, min({total}) over (partition by q.subject_id) as nearest
      from points q join points t on q.is_test and not t.is_test
      qualify row_number() over (partition by q.subject_id order by d, t.subject_id) <= {k})
group by 1"""


ORACLE["knn_vote"] = with_ctes(*_FEAT, f"""
stats as (select {_STATS} from feat2 join train using (subject_id))""", f"""
points as (select f.subject_id, f.label, p.rk <= ceil(0.2 * p.cn) as is_test, {_SCALED}
           from feat2 f join split p using (subject_id), stats s)""", body="select *, cast(prob > 0.5 as integer) as pred from ("
    + " union all ".join(_knn_sql(n, *c) for n, c in _C.KNN_CONFIGS.items()) + ")")

_LONG = " union all ".join(f"select {i} as f, '{c}' as feature, cast(feat2.{c} as double) as v, feat2.label as y from feat2 join train using (subject_id)"
                           for i, c in enumerate(ENCODED_FEATURES))
ORACLE["adaboost_first_stump"] = with_ctes(*_FEAT, f"""
long as ({_LONG})""", """
cells as (select f, feature, v, sum(1 - y) as c0, sum(y) as c1 from long group by all)""", """
sums as (select *, sum(c0) over w as l0, sum(c1) over w as l1, sum(c0) over (partition by f) as n0, sum(c1) over (partition by f) as n1,
                max(v) over (partition by f) as top
         from cells window w as (partition by f order by v))""", """
tried as (select *, round((2.0 * l0 * l1 / (l0 + l1) + 2.0 * (n0 - l0) * (n1 - l1) / (n0 + n1 - l0 - l1)) / (n0 + n1), 12) as gini,
                 cast(l1 > l0 as integer) as cl, cast(n1 - l1 > n0 - l0 as integer) as cr
          from sums where v <> top)""", """
best as (select *, ((case when cl = 1 then l0 else l1 end) + (case when cr = 1 then n0 - l0 else n1 - l1 end)) / cast(n0 + n1 as double) as err
         from tried order by gini, f, v limit 1)""", body="""
select feature, round(v, 6) as threshold, cl as left_class, cr as right_class, round(ln((1 - err) / err), 6) as alpha, round(gini, 6) as gini from best""")


def _tree_sql(g) -> str:
    """The splits of one tree, step by step: every step sums labels per (node, feature, bin), takes the best cut of each node
    (level) or of all (leaf), and moves the rows down."""
    def score(n, ones):
        grad = f"({n} * p - {ones})"
        return f"(power(sign({grad}) * greatest(abs({grad}) - {g.l1}, 0), 2) / ({n} * p * (1 - p) + {g.l2}))"

    def value(n, ones):
        grad = f"({n} * p - {ones})"
        return f"round(-{g.rate} * sign({grad}) * greatest(abs({grad}) - {g.l1}, 0) / ({n} * p * (1 - p) + {g.l2}), 6)"

    ctes = [f"long as ({_LONG.replace('select ', 'select subject_id, ')})", """
cells as (select f, v, count(*) as c from long group by all)""", f"""
bins as (select f, v, max(v) over (partition by f, b) as e from (
  select f, v, coalesce(sum(c) over (partition by f order by v rows between unbounded preceding and 1 preceding), 0) * {g.bins}
               // sum(c) over (partition by f) as b from cells))""", """
whole as (select avg(label) as p from train)""", """
r0 as (select subject_id, f, feature, e, y, 1 as node from long join bins using (f, v))"""]
    steps = g.max_depth if g.mode == "level" else g.num_leaves - 1
    least = max(g.least_rows, 1)
    for k in range(steps):
        pick = "qualify row_number() over (partition by node order by gain desc, f, e) = 1" if g.mode == "level" else "order by gain desc, node, f, e limit 1"
        fresh = f"node >= {2 ** k} and" if g.mode == "level" else ""
        ctes.append(f"""
t{k} as (select node, f, feature, e, p, sum(n) over w as nl, sum(o) over w as ol, sum(n) over (partition by node, f) as nt, sum(o) over (partition by node, f) as ot
        from (select node, f, feature, e, count(*) as n, sum(y) as o from r{k} group by all), whole window w as (partition by node, f order by e)),
g{k} as (select *, round(0.5 * ({score('nl', 'ol')} + {score('(nt - nl)', '(ot - ol)')} - {score('nt', 'ot')}), 10) as gain
        from t{k} where {fresh} nl >= {least} and nt - nl >= {least}),
s{k} as (select * from g{k} where gain > 1e-9 {pick}),
m{k} as (select subject_id, case when r.e <= s.e then 2 * r.node else 2 * r.node + 1 end as moved from r{k} r join s{k} s on r.node = s.node and r.f = s.f),
r{k + 1} as (select r.subject_id, f, feature, e, y, coalesce(moved, node) as node from r{k} r left join m{k} using (subject_id))""")
    body = " union all ".join(f"""
select cast(node as integer) as node, feature, round(e, 6) as threshold, round(gain, 6) as gain, cast(nl as bigint) as left_rows,
       cast(nt - nl as bigint) as right_rows, {value('nl', 'ol')} as left_value, {value('(nt - nl)', '(ot - ol)')} as right_value from s{k}""" for k in range(steps))
    return with_ctes(*_FEAT, *ctes, body=body)


for _name, _growth in _C.FIRST_TREES.items():
    ORACLE[_name] = _tree_sql(_growth)

ORACLE["ordered_target_stats"] = with_ctes(SPLIT_SQL, """
cats as (select subject_id, label, coalesce(sex, 'nan') as sex, coalesce(port, 'nan') as port, cast(tier as varchar) as tier,
                md5(cast(subject_id as varchar)) as h, (select avg(label) from train) as p from train)""", body="select subject_id, " + ", ".join(
    f"round((coalesce(sum(label) over (partition by {c} order by h, subject_id rows between unbounded preceding and 1 preceding), 0) + p) "
    f"/ (count(*) over (partition by {c} order by h, subject_id rows between unbounded preceding and 1 preceding) + 1), 6) as {c}_ts"
    for c in ("sex", "port", "tier")) + " from cats")


def _newton_sql(terms, steps: int = 12, penalty: float = 1.0) -> str:
    """Newton steps of penalised logistic regression: sums, then Gauss-Jordan elimination (the matrix is positive definite)."""
    d = len(terms) + 1
    x = ["1.0", *terms]
    ctes = [f"rows_ as (select {', '.join(terms)}, label from points where not is_test)",
            "b0 as (select " + ", ".join(f"0.0::double as c{i}" for i in range(d)) + ")"]
    for k in range(steps):
        margin = " + ".join(f"c{i} * {x[i]}" for i in range(d))
        ctes.append(f"p{k} as (select rows_.*, 1.0 / (1.0 + exp(-({margin}))) as p from rows_, b{k})")
        cells = [f"sum(p * (1 - p) * {x[i]} * {x[j]}) + {penalty if i == j and i else 0.0} as a{i}_{j}" for i in range(d) for j in range(d)]
        cells += [f"sum((label - p) * {x[i]}) - any_value(c{i}) * {penalty if i else 0.0} as a{i}_{d}" for i in range(d)]
        ctes.append(f"e{k}_0 as (select {', '.join(cells)} from p{k}, b{k})")
        for q in range(d):
            row = [f"a{q}_{j} / a{q}_{q} as a{q}_{j}" for j in range(d + 1)]
            rest = [f"a{i}_{j} - a{i}_{q} * a{q}_{j} / a{q}_{q} as a{i}_{j}" for i in range(d) if i != q for j in range(d + 1)]
            ctes.append(f"e{k}_{q + 1} as materialized (select {', '.join(row + rest)} from e{k}_{q})")
        ctes.append(f"b{k + 1} as materialized (select {', '.join(f'c{i} + a{i}_{d} as c{i}' for i in range(d))} from b{k}, e{k}_{d})")
    body = " union all ".join(f"select '{t}' as term, round(c{i}, 6) as coefficient from b{steps}" for i, t in enumerate(["intercept", *terms]))
    return with_ctes(*_FEAT, *_POINTS, *ctes, body=body)


_POINTS = (f"""
stats as (select {_STATS} from feat2 join train using (subject_id))""", f"""
points as (select f.subject_id, f.label, p.rk <= ceil(0.2 * p.cn) as is_test, {_SCALED}
           from feat2 f join split p using (subject_id), stats s)""")
ORACLE["logistic_coefficients"] = _newton_sql(_C.LOGISTIC_TERMS)


def _refit_sql(k: int = 5) -> str:
    import re

    ctes = [SPLIT_SQL, f"""
kfold as (select *, cast((row_number() over (partition by label order by md5(cast(subject_id as varchar) || ':42'), subject_id) - 1) % {k} as integer) as fold
          from train)"""]
    for i in range(k):
        text = FIT_SQL.replace("from train", f"from (select * from kfold where fold <> {i})").strip().rstrip(",") + "," \
            + features_sql(f"(select * from kfold where fold = {i})")
        ctes.append(re.sub(r"\b(tr_t|age_by_title|gstat|port_mode|edges|feat_in|feat2|feat)\b", rf"\1_{i}", text))
    union = " union all ".join(f"select label, {i} as fold, {_MARGIN} as margin from feat2_{i}" for i in range(k))
    ctes.append(f"""
folded0 as ({union}),
folded1 as (select *, 1.0 / (1.0 + exp(-margin)) as prob from folded0),
folded as (select *, cast(prob > 0.5 as integer) as pred from folded1),
fconf as (select fold, """ + _CONF.replace("scored.label", "folded.label") + ", " + _LL.replace("scored.label", "folded.label") + """ as ll
          from folded group by fold)""")
    return with_ctes(*ctes, _auc_sql("folded", "fold").replace("scored.label", "folded.label"), body="select fconf.fold, " + ", ".join(
        f"round({e}, 6) as {c}" for c, e in _R.items()) + ", round(auc.roc_auc, 6) as roc_auc, round(ll, 6) as log_loss from fconf join auc on fconf.fold = auc.fold")


ORACLE["refit_fold_metrics"] = _refit_sql()

ORACLE["numeric_columns"] = with_ctes(body="select subject_id, label, tier, age, parch, fare from subjects")
ORACLE["positive_share_text"] = with_ctes(*_SC, body="""
select printf('%d/%d positive (%.1f%%)', cast(sum(pred) as bigint), count(*), sum(pred) * 100.0 / count(*)) as text from scored""")
