"""ANSI SQL text for the oracle side, generated from the same fixed values.

Each oracle query is a CTE chain over the driver tables; ``subjects`` is the
adapter view from ``scoreflow.sources.tables``.
"""

from __future__ import annotations

from scoreflow.functions import scalars as S
from scoreflow.sources.tables import SUBJECTS_SQL


def case_map(expr: str, mapping: dict, default) -> str:
    lit = (lambda v: f"'{v}'" if isinstance(v, str) else str(v))
    whens = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in mapping.items())
    return f"coalesce(case {expr} {whens} end, {lit(default)})"


def title_sql(name: str = "full_name") -> str:
    return case_map(f"regexp_extract({name}, ' ([A-Za-z]+)\\.', 1)", S.TITLE_GROUPS,
                    S.DEFAULT_TITLE)


def age_band_sql(age: str) -> str:
    e = S.AGE_BAND_EDGES
    parts = [f"when {age} >= {e[0]} and {age} <= {e[1]} then 0"]
    parts += [f"when {age} > {e[i]} and {age} <= {e[i + 1]} then {i}" for i in range(1, len(e) - 1)]
    return f"(case {' '.join(parts)} end)"


def fare_cat_sql(fare: str, edges: str) -> str:
    """Right-closed bins on a sorted list of distinct edges, lowest included."""
    return (f"cast(case when len({edges}) >= 2 and {fare} >= {edges}[1] "
            f"and {fare} <= {edges}[len({edges})] then "
            f"len(list_filter({edges}[2:len({edges})-1], lambda x: x < {fare})) else 0 end as integer)")


def confidence_sql(p: str) -> str:
    hi, lo = S.CONFIDENCE_HIGH
    mhi, mlo = S.CONFIDENCE_MEDIUM
    return (f"(case when {p} >= {hi} or {p} <= {lo} then 'High' "
            f"when {p} >= {mhi} or {p} <= {mlo} then 'Medium' else 'Low' end)")


SPLIT_SQL = """
split as (
  select *, row_number() over (partition by label
              order by md5(cast(subject_id as varchar) || ':42'), subject_id) as rk,
         count(*) over (partition by label) as cn
  from subjects),
train as (select * from split where rk > ceil(0.2 * cn)),
test as (select * from split where rk <= ceil(0.2 * cn))
"""

FIT_SQL = f"""
tr_t as (select {title_sql()} as title, age, fare, port from train),
age_by_title as (select title, median(age) as m from tr_t where age is not null group by title),
gstat as (select median(age) as age_med, median(fare) as fare_med from tr_t),
port_mode as (select port as pm from tr_t where port is not null
              group by port order by count(*) desc, port limit 1),
edges as (select list_sort(list_distinct(quantile_cont(coalesce(fare, (select fare_med from gstat)),
          [0.0, 0.25, 0.5, 0.75, 1.0]))) as e from tr_t)
"""


def features_sql(src: str = "split") -> str:
    """Encoded features of every row of ``src`` with statistics fit on train."""
    return f"""
feat_in as (select s.*, {title_sql('s.full_name')} as title_g from {src} s),
feat as (
  select f.subject_id, f.label,
    cast(f.tier as integer) as tier,
    cast(coalesce(case f.sex when 'male' then 0 when 'female' then 1 end, 0) as integer) as sex,
    coalesce(f.age, a.m, (select age_med from gstat), 0.0) as age,
    cast(f.sibsp as integer) as sibsp, cast(f.parch as integer) as parch,
    coalesce(f.fare, (select fare_med from gstat)) as fare,
    cast({case_map("coalesce(f.port, (select pm from port_mode))", S.PORT_CODES, 0)} as integer) as port,
    cast({case_map('f.title_g', S.TITLE_CODES, 0)} as integer) as title,
    cast(f.sibsp + f.parch + 1 as integer) as family_size,
    cast(f.sibsp + f.parch + 1 = 1 as integer) as alone
  from feat_in f left join age_by_title a on a.title = f.title_g),
feat2 as (
  select feat.*, {age_band_sql('age')} as age_band,
         {fare_cat_sql('fare', '(select e from edges)')} as fare_cat
  from feat)
"""


def with_ctes(*ctes: str, body: str) -> str:
    parts = [f"subjects as ({SUBJECTS_SQL})"] + [c.strip().rstrip(",") for c in ctes]
    return "with " + ",\n".join(parts) + "\n" + body
