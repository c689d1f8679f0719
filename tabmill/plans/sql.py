"""DuckDB text of the derived tables, for the correctness oracle only.

Each oracle query is ``WITH <named derived tables> <body>``; :func:`with_tables`
pulls in the derived tables a body needs, in dependency order.
"""

from __future__ import annotations

from ..operators.split import bijection_keys
from ..sources.fixtures import ASSESSMENTS_RAW_SQL, HOUSES_RAW_SQL

_DEFS: dict[str, tuple[list[str], str]] = {}


def define(name: str, deps: list[str], body: str) -> None:
    _DEFS[name] = (deps, body)


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in _DEFS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_tables(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} as ({_DEFS[n][1]})" for n in _order(names))
    return f"with {ctes}\n{body}"


define("assessments_raw", [], ASSESSMENTS_RAW_SQL)
define("houses_raw", [], HOUSES_RAW_SQL)

define("assessments", ["assessments_raw"], """
select "Person_ID" as person_id, "AssessmentID" as assessment_id, "ScaleSet" as scale_set,
  "Sex_Code_Text" as sex_code_text, "Ethnic_Code_Text" as ethnic_code_text,
  case when age >= 25 and age <= 45 then '25 to 45' when age < 25 then 'Younger than 25'
       when age > 45 then 'Older than 45' end as date_of_birth,
  "CustodyStatus" as custody_status, "DisplayText" as display_text,
  "MaritalStatus" as marital_status, "ScoreText" as score_text
from (select *, 2014 - try_cast(regexp_replace(cast(year(coalesce(try_strptime("DateOfBirth", '%m/%d/%y'),
        try_strptime("DateOfBirth", '%m/%d/%Y'))) as varchar), '^20', '19') as double) as age
      from assessments_raw)
""")

define("risk_filtered", ["assessments"], """
select person_id, assessment_id, sex_code_text, ethnic_code_text, date_of_birth, custody_status,
  display_text, marital_status, score_text
from assessments
where ethnic_code_text in ('African-American', 'Caucasian', 'Hispanic')
  and custody_status in ('Jail Inmate', 'Probation', 'Pretrial Defendant')
  and marital_status in ('Single', 'Married')
""")

define("risk_split", ["risk_filtered"], """
select *, case when substr(md5(concat_ws('|', cast(assessment_id as varchar), display_text, '42')), 1, 8) < 'cccccccc'
  then 'train' else 'test' end as set
from risk_filtered
""")

define("rule_preds", ["risk_split"], """
select display_text as task, 'rule' as model, set, assessment_id, score_text as truth,
  case when date_of_birth = 'Younger than 25' then 'High' when custody_status = 'Jail Inmate' then 'Medium'
       else 'Low' end as estimate
from risk_split where set = 'test'
""")

define("rule_conf", ["rule_preds"], """
select task, model, truth, estimate, cast(count(*) as bigint) as n from rule_preds group by all
""")

define("rule_acc", ["rule_conf"], """
select task, model, sum(case when truth = estimate then n else 0 end) / sum(n) as accuracy
from rule_conf group by task, model
""")

define("rule_kappa", ["rule_conf"], """
select t.task, t.model,
  case when 1.0 - pe = 0 then null else (po - pe) / (1.0 - pe) end as kappa
from (
  select a.task, a.model, cast(a.n_agree as double) / cast(a.n_total as double) as po,
    cast(coalesce(b.rc, 0) as double) / (cast(a.n_total as double) * cast(a.n_total as double)) as pe
  from (select task, model, sum(n) as n_total, sum(case when truth = estimate then n else 0 end) as n_agree
        from rule_conf group by task, model) a
  left join (select r.task, r.model, sum(r.r * c.c) as rc
             from (select task, model, truth as level, sum(n) as r from rule_conf group by all) r
             join (select task, model, estimate as level, sum(n) as c from rule_conf group by all) c
               on r.task = c.task and r.model = c.model and r.level = c.level
             group by r.task, r.model) b
  on a.task = b.task and a.model = b.model
) t
""")

AGE_BUCKET_SQL = """case when age >= 25 and age <= 45 then '25 to 45' when age < 25 then 'Younger than 25'
       when age > 45 then 'Older than 45' end"""
AGE_SQL = """2014 - try_cast(regexp_replace(cast(year(coalesce(try_strptime(date_of_birth, '%m/%d/%y'),
        try_strptime(date_of_birth, '%m/%d/%Y'))) as varchar), '^20', '19') as double)"""

define("assessments_named", ["assessments_raw"], """
select "Person_ID" as person_id, "AssessmentID" as assessment_id, "ScaleSet" as scale_set,
  "Sex_Code_Text" as sex_code_text, "Ethnic_Code_Text" as ethnic_code_text, "DateOfBirth" as date_of_birth,
  "CustodyStatus" as custody_status, "DisplayText" as display_text,
  "MaritalStatus" as marital_status, "ScoreText" as score_text
from assessments_raw
""")

def nth_sql(n: int, with_task: bool = True, with_scale: bool = False) -> str:
    """The n-th scale row of each assessment, age bucketed, levels filtered."""
    return f"""
select assessment_id, {"scale_set, " if with_scale else ""}sex_code_text, ethnic_code_text,
  {AGE_BUCKET_SQL} as date_of_birth, custody_status, {"display_text, " if with_task else ""}marital_status, score_text
from (select *, {AGE_SQL} as age,
        row_number() over (partition by assessment_id order by scale_set) as rn
      from assessments_named) t
where rn = {n}
  and ethnic_code_text in ('African-American', 'Caucasian', 'Hispanic')
  and custody_status in ('Jail Inmate', 'Probation', 'Pretrial Defendant')
  and marital_status in ('Single', 'Married')
"""


define("risk_nth2", ["assessments_named"], nth_sql(2, with_scale=True))

# ------------------------------------------------------------------ houses

define("houses_named", ["houses_raw"], """
select "Id" as id, "SalePrice" as sale_price, "GrLivArea" as gr_liv_area, "LotFrontage" as lot_frontage,
  "OverallQual" as overall_qual, "MoSold" as mo_sold, "YrSold" as yr_sold, "MSSubClass" as ms_sub_class,
  "Neighborhood" as neighborhood, "GarageType" as garage_type, "Street" as street, "PoolQC" as pool_qc,
  "Utilities" as utilities
from houses_raw
""")

define("houses_typed", ["houses_named"], """
select id, sale_price, gr_liv_area, lot_frontage, cast(overall_qual as varchar) as overall_qual,
  cast(mo_sold as varchar) as mo_sold, cast(yr_sold as varchar) as yr_sold, ms_sub_class, neighborhood,
  garage_type, street, pool_qc, utilities
from houses_named
""")

HOUSE_FACTORS = ["overall_qual", "mo_sold", "yr_sold", "ms_sub_class", "neighborhood", "garage_type", "street",
                 "utilities"]
_not_null = " and ".join(f"{c} is not null" for c in ["sale_price", "gr_liv_area", "lot_frontage"] + HOUSE_FACTORS)

define("houses_complete", ["houses_typed"], f"""
select id, sale_price, gr_liv_area, lot_frontage, {", ".join(HOUSE_FACTORS)}
from houses_typed
where {_not_null} and not isnan(gr_liv_area) and not isnan(lot_frontage) and not isnan(sale_price)
""")

_rare = ",\n  ".join(
    f"case when cast(count(*) over (partition by {c}) as double) / count(*) over () > 0.1 then {c} else 'Other' end as {c}"
    for c in HOUSE_FACTORS)
define("houses_rare", ["houses_complete"], f"""
select id, sale_price, gr_liv_area, lot_frontage,
  {_rare}
from houses_complete
""")

_dom = ",\n  ".join(
    f"case when cast(count(*) over (partition by {c}) as double) / count(*) over () > 0.89 then 'Other' else {c} end as {c}"
    for c in HOUSE_FACTORS)
define("houses_lumped", ["houses_rare"], f"""
select id, sale_price, gr_liv_area, lot_frontage,
  {_dom}
from houses_rare
""")

# the survivors of the single-level check at these tables' parameters
HOUSE_KEPT_FACTORS = ["overall_qual", "yr_sold", "ms_sub_class", "neighborhood", "garage_type"]
define("houses_clean", ["houses_lumped"], f"""
select id, sale_price, gr_liv_area, lot_frontage, {", ".join(HOUSE_KEPT_FACTORS)} from houses_lumped
""")

# ------------------------------------------------------------------ risk recipe

# The dummy columns of the prepared frame; which rows are known is learned in known_sql.
RISK_LEVELS = {
    "sex_code_text": ["Female", "Male"],
    "ethnic_code_text": ["African-American", "Caucasian", "Hispanic"],
    "date_of_birth": ["25 to 45", "Older than 45", "Younger than 25"],
    "custody_status": ["Jail Inmate", "Pretrial Defendant", "Probation"],
    "marital_status": ["Married", "Single"],
}


def _slug(level: str) -> str:
    import re
    return re.sub(r"[^0-9a-zA-Z]+", "_", level).strip("_").lower()


RISK_DUMMIES_SQL = ",\n  ".join(
    f"cast({c} = '{lv}' as int) as {c}_{_slug(lv)}" for c, lvs in RISK_LEVELS.items() for lv in lvs)


def known_sql(task: str = "display_text") -> str:
    """TRUE where every nominal value is a level of the task's training rows (learned here, not listed)."""
    return " and ".join(
        f"({task}, {c}) in (select (display_text, {c}) from risk_split where set = 'train' and {c} is not null)"
        for c in RISK_LEVELS)


RISK_KNOWN_SQL = known_sql()

define("risk_juiced", ["risk_split"], f"""
select assessment_id, display_text, score_text,
  {RISK_DUMMIES_SQL}
from risk_split where set = 'train' and {RISK_KNOWN_SQL}
""")

define("risk_baked", ["risk_split"], f"""
select assessment_id, display_text, score_text,
  {RISK_DUMMIES_SQL}
from risk_split where set = 'test' and {RISK_KNOWN_SQL}
""")


def class_metrics_sql(preds: str, group: list[str]) -> str:
    """Accuracy and multiclass kappa in long form from a predictions table (oracle text)."""
    g = ", ".join(group)
    on = " and ".join(f"r.{c} = c.{c}" for c in group + ["level"])
    on2 = " and ".join(f"a.{c} = b.{c}" for c in group)
    return f"""
select {", ".join("t." + c for c in group)}, m.metric, 'multiclass' as estimator,
  case when m.metric = 'accuracy' then po
       else case when 1.0 - pe = 0 then null else (po - pe) / (1.0 - pe) end end as estimate
from (select {", ".join("a." + c for c in group)}, cast(a.n_agree as double) / cast(a.n_total as double) as po,
        cast(coalesce(b.rc, 0) as double) / (cast(a.n_total as double) * cast(a.n_total as double)) as pe
      from (select {g}, count(*) as n_total, sum(case when truth = estimate then 1 else 0 end) as n_agree
            from {preds} group by {g}) a
      left join (select {", ".join("r." + c for c in group)}, sum(r.r * c.c) as rc
                 from (select {g}, truth as level, count(*) as r from {preds} group by all) r
                 join (select {g}, estimate as level, count(*) as c from {preds} group by all) c on {on}
                 group by {", ".join("r." + c for c in group)}) b on {on2}) t
cross join (select 'accuracy' as metric union all select 'kap') m
"""


define("rule_preds_all", ["risk_split"], """
select display_text as task, 'rule' as model, set, assessment_id, score_text as truth,
  case when date_of_birth = 'Younger than 25' then 'High' when custody_status = 'Jail Inmate' then 'Medium'
       else 'Low' end as estimate
from risk_split
""")

# ------------------------------------------------------------------ k-fold CV of the one-feature line

define("cv_d", ["houses_clean"], """
select id, gr_liv_area as x, sale_price as y,
  ('0x' || substr(md5(concat_ws('|', cast(id as varchar), '4')), 1, 8))::bigint % 4 as fold
from houses_clean
""")

define("cv_m", ["cv_d"], """
select fold as k, slope, (sy - slope * sx) / n as intercept
from (select fold, n, sx, sy, (n * sxy - sx * sy) / (n * sxx - sx * sx) as slope
      from (select fold, cast(sum(n) over () - n as double) as n, sum(sx) over () - sx as sx,
              sum(sy) over () - sy as sy, sum(sxx) over () - sxx as sxx, sum(sxy) over () - sxy as sxy
            from (select fold, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(x * y) as sxy
                  from cv_d group by fold) f) t) u
""")

define("cv_losses", ["cv_d", "cv_m"], """
select 'lm_1d' as learner, fold, set, avg(pow(label - prediction, 2)) as mse,
  avg(abs(case when label = 0 then null else (label - prediction) / label end)) as mape
from (select m.k as fold, case when d.fold = m.k then 'test' else 'train' end as set, d.y as label,
        m.intercept + m.slope * d.x as prediction
      from cv_d d cross join cv_m m) s
group by fold, set
""")

# ------------------------------------------------------------------ explanations with the pinned house formula

EXPLAIN_FEATURES = ["gr_liv_area", "lot_frontage", "overall_qual", "yr_sold", "ms_sub_class", "neighborhood",
                    "garage_type"]


def rule_sql(gr_liv_area: str = "gr_liv_area", lot_frontage: str = "lot_frontage",
             neighborhood: str = "neighborhood") -> str:
    """The pinned house formula with column expressions substituted (same operation order as in Spark)."""
    g, lf, nb = gr_liv_area, lot_frontage, neighborhood
    return (f"(50000.0 + 900.0 * {g} + 100.0 * {lf} + 0.5 * {g} * {lf}"
            f" + case when {nb} = 'BUILDING' then 4000.0 when {nb} = 'MACHINERY' then -2500.0 else 0.0 end)")


define("ex_grid", ["houses_clean"], """
select lo + cast(i as double) * ((hi - lo) / cast(19 as double)) as v
from (select min(gr_liv_area) as lo, max(gr_liv_area) as hi from houses_clean), (select unnest(range(0, 20)) as i)
""")

define("ex_ice", ["houses_clean", "ex_grid"], f"""
select 'gr_liv_area' as feature, g.v as feature_val, {rule_sql(gr_liv_area="g.v")} as prediction, h.id
from houses_clean h, ex_grid g
""")

def define_ale(feature: str, name: str) -> None:
    """Tables of the accumulated effects of one numeric feature; ``{name}_out`` is the result."""
    define(f"{name}_ranked", ["houses_clean"], f"""
select {feature} as x, row_number() over (order by {feature}) as rn, count(*) over () as n
from houses_clean where {feature} is not null
""")
    define(f"{name}_breaks", [f"{name}_ranked"], f"""
select x as b, row_number() over (order by x) as j
from (select distinct r.x from {name}_ranked r join (select unnest(range(0, 21)) as k) g
        on r.rn = greatest(1, (r.n * g.k + 19) // 20))
""")
    define(f"{name}_per", ["houses_clean", f"{name}_breaks"], f"""
select k, (sum(f_hi) - sum(f_lo)) / count(*) as delta, count(*) as n
from (select r.k, {rule_sql(**{feature: "bhi.b"})} as f_hi, {rule_sql(**{feature: "blo.b"})} as f_lo
      from (select h.*, greatest(1, (select count(*) from {name}_breaks b where b.b < h.{feature})) as k
            from houses_clean h where h.{feature} is not null) r
      join {name}_breaks blo on blo.j = r.k join {name}_breaks bhi on bhi.j = r.k + 1) s
group by k
""")
    define(f"{name}_out", [f"{name}_per", f"{name}_breaks"], f"""
select '{feature}' as feature, b.b as feature_val, v - c as ale
from (select k, f_lo, f_hi, sum(n * (f_lo + f_hi) / 2.0) over () / sum(n) over () as c
      from (select k, n, f_hi, coalesce(lag(f_hi) over (order by k), 0) as f_lo
            from (select k, n, sum(delta) over (order by k rows between unbounded preceding and current row) as f_hi
                  from {name}_per) a) a2) t,
     lateral (select 1 as j, f_lo as v where t.k = 1 union all select t.k + 1 as j, f_hi as v) e
join {name}_breaks b on b.j = e.j
""")


define_ale("gr_liv_area", "ale")
define_ale("lot_frontage", "ale_lot")


def _perm_sql(reps: int = 5, seed: int = 1) -> str:
    parts = []
    for f in EXPLAIN_FEATURES:
        cols = {c: (f"g.{c}" if c == f else f"h.{c}") for c in ["gr_liv_area", "lot_frontage", "neighborhood"]}
        rule = rule_sql(cols["gr_liv_area"], cols["lot_frontage"], cols["neighborhood"])
        parts.append(f"select p.rep, '{f}' as feature, abs(h.sale_price - {rule}) as e "
                     f"from pi_pairs p join houses_clean h on h.id = p.id join houses_clean g on g.id = p.donor")
    return " union all ".join(parts)


def bijection_sql(v: str, seeds: list, which: str = "0") -> str:
    """One turn of the keyed bijection over the grid of ``grid_rows`` x ``grid_cols`` cells (columns of the row)."""
    keys = [bijection_keys(s) for s in seeds]

    def mixed(x, k):
        a, b = (f"{[ks[k][part] for ks in keys]}[{which} + 1]" for part in (0, 1))
        t = f"((({x}) * {a} + {b}) % 2147483647)"
        return f"(({t} * {t}) % 2147483647)"

    left, right = f"({v} // grid_cols)", f"({v} % grid_cols)"
    for k in range(4):
        if k % 2 == 0:
            left = f"(({left} + {mixed(right, k)}) % grid_rows)"
        else:
            right = f"(({right} + {mixed(left, k)}) % grid_cols)"
    return f"{left} * grid_cols + {right}"


def permutation_sql(table: str, seeds: list) -> str:
    """``rep, i, j``: the donor's place of every row and seed; values beyond the table walk on."""
    return f"""
with recursive size as (select n, grid_rows, (n + grid_rows - 1) // grid_rows as grid_cols
    from (select n, cast(ceil(sqrt(n)) as bigint) as grid_rows from (select count(*) as n from {table}))),
walk as (select rep, i, i as v, 0 as step, n, grid_rows, grid_cols from (select unnest(range(0, {len(seeds)})) as rep),
    (select unnest(range(0, n)) as i, * from size)
  union all select rep, i, {bijection_sql("v", seeds, "rep")}, step + 1, n, grid_rows, grid_cols from walk where step = 0 or v >= n)
select rep, i, v as j from walk where step > 0 and v < n
"""


define("pi_moves", ["houses_clean"], permutation_sql("houses_clean", [f"1:{r}" for r in range(5)]))
define("pi_pairs", ["houses_clean", "pi_moves"], """
select m.rep, a.id, d.id as donor from pi_moves m
join (select id, row_number() over (order by id) - 1 as i from houses_clean) a on a.i = m.i
join (select id, row_number() over (order by id) - 1 as i from houses_clean) d on d.i = m.j
""")
define("pc_moves", ["houses_clean"], permutation_sql("houses_clean", [1]))

define("pi_err", ["pi_pairs", "houses_clean"], f"""
select feature, rep, avg(e) as err from ({_perm_sql()}) u group by feature, rep
""")

define("pi_out", ["pi_err", "houses_clean"], f"""
select feature, round(quantile_cont(err / base, 0.05), 6) as importance_05,
  round(quantile_cont(err / base, 0.5), 6) as importance, round(quantile_cont(err / base, 0.95), 6) as importance_95,
  quantile_cont(err, 0.5) as permutation_error
from pi_err, (select avg(abs(sale_price - {rule_sql()})) as base from houses_clean) b
group by feature
""")


def _shapley_sql(m: int = 100, seed: int = 3, obs: int = 122) -> str:
    feats = EXPLAIN_FEATURES
    p = len(feats)
    val = {f: f"case when o.p_{f} <= t.t then x.{f} else z.{f} end" for f in feats}
    rule = rule_sql(val["gr_liv_area"], val["lot_frontage"], val["neighborhood"])
    joined = "case t.t " + " ".join(f"when o.p_{f} then '{f}'" for f in feats) + " end"
    pos = ", ".join(f"max(case when f = '{f}' then pos end) as p_{f}" for f in feats)
    fv = " union all ".join(f"select '{f}' as feature, '{f}=' || cast({f} as varchar) as feature_value from sh_x"
                            for f in feats)
    return f"""
sh_z as (select row_number() over (order by md5(concat_ws('|', cast(id as varchar), '{seed}')), id) - 1 as s, *
         from houses_clean order by md5(concat_ws('|', cast(id as varchar), '{seed}')), id limit {m}),
sh_x as (select * exclude (rn) from (select *, row_number() over (order by id) as rn from houses_clean) where rn = {obs}),
sh_o as (select s, {pos}
         from (select z.s, f.f, row_number() over (partition by z.s order by md5(concat_ws('|', cast(z.s as varchar), f.f, '{seed}'))) as pos
               from sh_z z, (select unnest({feats!r}) as f) f) q group by s),
sh_chain as (select x.id, z.s, t.t, case when t.t = 0 then null else {joined} end as joined, {rule} as prediction
             from sh_x x, sh_z z join sh_o o on o.s = z.s, (select unnest(range(0, {p + 1})) as t) t),
sh_c as (select id, s, joined, prediction - lag(prediction) over (partition by id, s order by t) as c from sh_chain)
select c.id, c.joined as feature, v.feature_value, round(avg(c), 4) as phi, round(var_samp(c), 4) as phi_var
from sh_c c join ({fv}) v on v.feature = c.joined
where c.joined is not null group by c.id, c.joined, v.feature_value
"""


def lime_gram_sql(numeric: list[str], nominal: list[str], obs: int = 122) -> str:
    """Weighted design sums of the local surrogate at one observation (oracle text)."""
    cols = numeric + nominal
    q = len(cols)
    z = ["1.0", *[f"cast(h.{c} as double)" for c in numeric],
         *[f"case when h.{c} = o.{c} then 1.0 else 0.0 end" for c in nominal], "h.y"]
    far = [f"abs(cast(h.{c} as double) - o.{c}) / r.{c}" for c in numeric]
    far += [f"case when h.{c} = o.{c} then 0.0 else 1.0 end" for c in nominal]
    cells = [(i, j) for i in range(q + 2) for j in range(i, q + 2)]
    return f"""
h as (select *, {rule_sql()} as y from houses_clean),
o as (select * from houses_clean qualify row_number() over (order by id) = {obs}),
r as (select {", ".join(f"cast(max({c}) - min({c}) as double) as {c}" for c in numeric)} from houses_clean),
z as (select o.id, {", ".join(f"{e} as z{i}" for i, e in enumerate(z))},
      1.0 - ({" + ".join(far)}) / {float(q)} as w from h cross join o cross join r),
s as (select id, {", ".join(f"sum(w * z{i} * z{j}) as s_{i}_{j}" for i, j in cells)} from z group by id)
""" + " union all ".join(f"select id, {i} as i, {j} as j, printf('%.7e', s_{i}_{j}) as value from s" for i, j in cells)


def lime_pair_sql(numeric: list[str], nominal: list[str], obs: int = 122) -> str:
    """The local surrogate of two features at one observation (oracle text): its lasso path in closed form.

    The first feature has the largest correlation; the second joins at step ``g1``, and the path stops at step ``g2``, where a third would."""
    cols = numeric + nominal
    y = len(cols) + 1
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(cols, 1))
    value = " ".join(f"when '{c}' then o.{c}" for c in numeric)
    head = lime_gram_sql(numeric, nominal, obs).rsplit("\nselect id, 0 as i", 1)[0]
    pairs = " union all ".join(f"select id, {i} as i, {j} as j, s_{i}_{j} as v from s" for i in range(y + 1) for j in range(i, y + 1))
    return head.rstrip() + f""",
half as ({pairs}),
m as (select * from half union all select id, j, i, v from half where i < j),
n as (select v from m where i = 0 and j = 0),
c as (select a.i, a.j, a.v / n.v - (b.v / n.v) * (d.v / n.v) as v from m a join m b on b.i = 0 and b.j = a.i
  join m d on d.i = 0 and d.j = a.j cross join n where a.i > 0 and a.j > 0),
sd as (select i, sqrt(v) as sd from c where i = j and i < {y} and v > 1e-24),
corr as (select c.i, c.j, c.v / (a.sd * b.sd) as v from c join sd a on a.i = c.i join sd b on b.i = c.j),
ry as (select c.i, c.v / a.sd as v from c join sd a on a.i = c.i where c.j = {y}),
k1 as (select i, abs(v) as penalty, sign(v) as s from ry order by abs(v) desc, i limit 1),
e1 as (select ry.i, ry.v, corr.v as rho, corr.v * k1.s as a, k1.penalty, k1.i as i1, k1.s as s1 from ry join k1 on ry.i <> k1.i
  join corr on corr.i = ry.i and corr.j = k1.i),
t1 as (select *, (penalty - v) / (1 - a) as up, (penalty + v) / (1 + a) as down from e1),
k2 as (select i1, s1, i as i2, case when up <= down then 1.0 else -1.0 end as s2, least(up, down) as g1, rho, penalty from t1
  order by least(up, down), i limit 1),
d as (select *, (s1 - rho * s2) / (1 - rho * rho) as d1, (s2 - rho * s1) / (1 - rho * rho) as d2, penalty - g1 as rest from k2),
e2 as (select ry.i, ry.v - d.g1 * d.s1 * x.v as v, x.v * d.d1 + z.v * d.d2 as a, d.rest from ry join d on ry.i <> d.i1 and ry.i <> d.i2
  join corr x on x.i = ry.i and x.j = d.i1 join corr z on z.i = ry.i and z.j = d.i2),
g2 as (select least(min(rest), min(case when a < 1 then (rest - v) / (1 - a) end), min(case when a > -1 then (rest + v) / (1 + a) end)) as g2 from e2),
beta as (select i1 as i, s1 * g1 + g2 * d1 as b from d cross join g2 union all select i2, g2 * d2 from d cross join g2)
select o.id, f.name as feature, printf('%.6e', b / sd.sd) as beta, printf('%.6e', b / sd.sd * case f.name {value} else 1.0 end) as effect
from beta join sd on sd.i = beta.i join (values {names}) as f(i, name) on f.i = beta.i cross join o
"""


def pdp_all_sql(numeric: list[str], nominal: list[str]) -> str:
    """Mean prediction over the grid of every feature (oracle text)."""
    def rule(f, v):
        return rule_sql(**{f: v}) if f in ("gr_liv_area", "lot_frontage", "neighborhood") else rule_sql()

    parts = [f"""
select '{f}' as feature, v as feature_val, cast(null as varchar) as feature_level, round(avg({rule(f, "v")}), 4) as y_hat
from houses_clean, (select lo + cast(i as double) * ((hi - lo) / cast(19 as double)) as v
  from (select min({f}) as lo, max({f}) as hi from houses_clean), (select unnest(range(0, 20)) as i)) group by v
""" for f in numeric]
    parts += [f"""
select '{f}', cast(null as double), level, round(avg({rule(f, "level")}), 4)
from houses_clean, (select distinct {f} as level from houses_clean) group by level
""" for f in nominal]
    return " union all ".join(parts)


# ------------------------------------------------------------------ effects of categorical features

def level_rule_sql(**cols: str) -> str:
    """The pinned formula in which every category counts, with column expressions substituted."""
    def code(c):
        return f"cast(ascii(right({cols.get(c, c)}, 1)) as double)"

    numeric = {c: v for c, v in cols.items() if c in ("gr_liv_area", "lot_frontage", "neighborhood")}
    return (f"({rule_sql(**numeric)} + 3.0 * {code('overall_qual')} * {cols.get('lot_frontage', 'lot_frontage')} + 11.0 * {code('yr_sold')}"
            f" + 7.0 * {code('ms_sub_class')} * {code('garage_type')})")


_NUMBERS = ["gr_liv_area", "lot_frontage"]
_OTHERS = HOUSE_KEPT_FACTORS + _NUMBERS

for _c in _NUMBERS:
    define(f"lv_breaks_{_c}", ["houses_clean"], f"""
select distinct r.x as b from (select {_c} as x, row_number() over (order by {_c}) as rn, count(*) over () as n from houses_clean
  where {_c} is not null) r join (select unnest(range(0, 101)) as k) g on r.rn = greatest(1, (r.n * g.k + 99) // 100)
""")
define("lv_binned", ["houses_clean", *(f"lv_breaks_{c}" for c in _NUMBERS)], "select h.*, " + ", ".join(
    f"(select count(*) from lv_breaks_{c} where b < h.{c}) + 1 as bin_{c}" for c in _NUMBERS) + " from houses_clean h")
define("lv_shares", ["houses_clean"], "select *, n / sum(n) over (partition by feature, level, other) as p from (" + " union all ".join(
    f"select '{f}' as feature, {f} as level, '{o}' as other, {o} as bin, count(*) as n from houses_clean group by all"
    for f in HOUSE_KEPT_FACTORS for o in HOUSE_KEPT_FACTORS if o != f) + ")")
define("lv_bins", ["lv_binned"], " union all ".join(
    f"select '{f}' as feature, {f} as level, '{c}' as other, bin_{c} as bin, count(*) as n from lv_binned group by all"
    for f in HOUSE_KEPT_FACTORS for c in _NUMBERS))
define("lv_upto", ["lv_bins"], """
select feature, level, other, k, sum(case when bin <= k then n else 0 end) / sum(n) as u
from lv_bins, (select unnest(range(1, 102)) as k) group by all
""")
define("lv_apart", ["lv_shares", "lv_upto"], """
select a.feature, a.level as level_a, b.level as level_b, a.other, 1 - sum(least(a.p, b.p)) as apart
from lv_shares a join lv_shares b on a.feature = b.feature and a.other = b.other and a.bin = b.bin and a.level < b.level group by all
union all
select a.feature, a.level, b.level, a.other, max(abs(a.u - b.u))
from lv_upto a join lv_upto b on a.feature = b.feature and a.other = b.other and a.k = b.k and a.level < b.level group by all
""")
define("lv_levels", ["houses_clean"], " union ".join(f"select '{f}' as feature, {f} as level from houses_clean" for f in HOUSE_KEPT_FACTORS))
define("lv_distance", ["lv_levels", "lv_apart"], f"""
select a.feature, a.level as level_a, b.level as level_b, sum(coalesce(p.apart, 1)) as distance
from lv_levels a join lv_levels b on a.feature = b.feature and a.level < b.level
join (select unnest({_OTHERS!r}) as other) o on o.other <> a.feature
left join lv_apart p on p.feature = a.feature and p.level_a = a.level and p.level_b = b.level and p.other = o.other
group by all
""")
# classical scaling: the leading vector of the centred squares, by repeated squaring of the matrix shifted to be positive
define("lv_squares", ["lv_distance", "lv_levels"], """
select feature, list(a order by a) as names, list(r order by a) as d from (
  select feature, a, list(d * d order by b) as r from (
    select feature, level_a as a, level_b as b, distance as d from lv_distance union all
    select feature, level_b, level_a, distance from lv_distance union all
    select feature, level, level, 0.0 from lv_levels) group by feature, a) group by feature
""")
define("lv_centred", ["lv_squares"], """
select feature, names, list_transform(range(1, len(d) + 1), lambda i: list_transform(range(1, len(d) + 1),
    lambda j: -0.5 * (d[i][j] - m[i] - m[j] + list_avg(m)))) as b
from (select *, list_transform(d, lambda r: list_avg(r)) as m from lv_squares)
""")
define("lv_power", ["lv_centred"], """
with recursive power as (
  select feature, names, 0 as i, list_transform(range(1, len(b) + 1), lambda x: list_transform(range(1, len(b) + 1),
      lambda y: b[x][y] + case when x = y then c else 0 end)) as a
  from (select *, list_max(list_transform(b, lambda r: list_sum(list_transform(r, lambda x: abs(x))))) as c from lv_centred)
  union all
  select feature, names, i + 1, list_transform(a, lambda r: list_transform(a, lambda q: list_dot_product(r, q) / t))
  from (select *, greatest(list_sum(list_transform(range(1, len(a) + 1), lambda x: a[x][x] * a[x][x])), 1e-300) as t from power where i < 45))
select * from power where i = 45
""")
define("lv_order", ["lv_power"], """
select feature, level, cast(row_number() over (partition by feature order by place, level) as int) as k from (
  select feature, unnest(names) as level, unnest(list_transform(v, lambda x: case when lead > 0 then -x else x end)) as place from (
    select *, list_filter(v, lambda x: abs(x) > 1e-9)[1] as lead from (
      select feature, names, a[list_position(diag, list_max(diag))] as v from (
        select *, list_transform(range(1, len(a) + 1), lambda x: a[x][x]) as diag from lv_power))))
""")
define("lv_steps", ["houses_clean", "lv_order"], " union all ".join(f"""
select '{f}' as feature, lo.k as step, sum({level_rule_sql(**{f: "hi.level"})} - {level_rule_sql(**{f: "lo.level"})}) / count(*) as delta
from houses_clean h join lv_order p on p.feature = '{f}' and p.level = h.{f}, (select unnest([0, 1]) as back)
join lv_order lo on lo.feature = '{f}' and lo.k = p.k - back join lv_order hi on hi.feature = '{f}' and hi.k = lo.k + 1
group by all
""" for f in HOUSE_KEPT_FACTORS))
define("lv_counts", ["houses_clean"], " union all ".join(
    f"select '{f}' as feature, {f} as level, count(*) as n from houses_clean group by all" for f in HOUSE_KEPT_FACTORS))
define("lv_ale", ["lv_order", "lv_steps", "lv_counts"], """
select feature, level, k as position, effect - sum(effect * n) over (partition by feature) / sum(n) over (partition by feature) as ale
from (select o.feature, o.level, o.k, any_value(c.n) as n, coalesce(sum(s.delta), 0) as effect
      from lv_order o join lv_counts c using (feature, level) left join lv_steps s on s.feature = o.feature and s.step < o.k
      group by all)
""")
define("lv_ice", ["houses_clean", "lv_levels"], " union all ".join(
    f"select '{f}' as feature, l.level as feature_level, {level_rule_sql(**{f: 'l.level'})} as prediction, h.id "
    f"from houses_clean h join lv_levels l on l.feature = '{f}'" for f in HOUSE_KEPT_FACTORS))

define("lv_number_ice", ["houses_clean"], " union all ".join(f"""
select '{f}' as feature, v as feature_val, {level_rule_sql(**{f: "v"})} as prediction, id from houses_clean,
  (select lo + cast(i as double) * ((hi - lo) / cast(19 as double)) as v
   from (select min({f}) as lo, max({f}) as hi from houses_clean), (select unnest(range(0, 20)) as i))
""" for f in _NUMBERS))


# ------------------------------------------------------------------ class probabilities of a pinned formula

define("rule_probs", ["risk_split"], """
select display_text as task, 'rule' as model, assessment_id, score_text as truth,
  wh::double / (wh + wm + wl)::double as p_high, wm::double / (wh + wm + wl)::double as p_medium, wl::double / (wh + wm + wl)::double as p_low
from (select *, 10 + case when date_of_birth = 'Younger than 25' then 40 else 0 end + h as wh,
        20 + case when custody_status = 'Jail Inmate' then 30 else 0 end + (h * 7) % 31 as wm, 30 + (h * 13) % 53 as wl
      from (select *, ('0x' || substr(md5(concat_ws('|', cast(assessment_id as varchar), 'p')), 1, 8))::bigint % 97 as h
            from risk_split where set = 'test'))
""")
define("rule_probs_long", ["rule_probs"], """
select task, model, truth, 'High' as c, p_high as p from rule_probs union all
select task, model, truth, 'Medium', p_medium from rule_probs union all select task, model, truth, 'Low', p_low from rule_probs
""")
define("rule_pairs", ["rule_probs_long"], """
select a.task, a.model, a.c as class_a, b.truth as class_b, any_value(na) as n_a, any_value(nb) as n_b,
  (sum(a.rank) - any_value(na) * (any_value(na) + 1) / 2.0) / (any_value(na)::double * any_value(nb)) as auc
from (select l.task, l.model, l.c, o.truth as other, l.truth,
        avg(rn) over (partition by l.task, l.model, l.c, o.truth, l.p) as rank,
        count(*) filter (where l.truth = l.c) over (partition by l.task, l.model, l.c, o.truth) as na,
        count(*) filter (where l.truth = o.truth) over (partition by l.task, l.model, l.c, o.truth) as nb
      from (select l.*, o.truth as ot, row_number() over (partition by l.task, l.model, l.c, o.truth order by l.p) as rn
            from rule_probs_long l join (select distinct truth from rule_probs) o on o.truth <> l.c and l.truth in (l.c, o.truth)) l
      join (select distinct truth from rule_probs) o on o.truth = l.ot) a
join (select distinct truth from rule_probs) b on b.truth = a.other
where a.truth = a.c group by all
""")

define("group_share", ["risk_juiced"], """
select *, n / sum(n) over (partition by task, female) as p
from (select display_text as task, sex_code_text_female as female, score_text as class, count(*) as n from risk_juiced group by all)
""")
define("group_majority", ["group_share"], """
select task, female, class as estimate from group_share qualify row_number() over (partition by task, female order by p desc, class) = 1
""")
define("majority_preds", ["risk_baked", "group_majority"], """
select b.display_text as task, b.score_text as truth, m.estimate
from risk_baked b join group_majority m on m.task = b.display_text and m.female = b.sex_code_text_female
""")
define("majority_metrics", ["majority_preds"], class_metrics_sql("majority_preds", ["task"]))


# ------------------------------------------------------------------ tuning: trees of depth 0 and 1 on one 0/1 predictor

define("tune_cells", ["risk_juiced"], """
select display_text as task, sex_code_text_female as x, score_text as y, count(*) as n,
  ('0x' || substr(md5(concat_ws('|', cast(assessment_id as varchar), '4')), 1, 8))::bigint % 4 as fold
from risk_juiced group by all
""")
define("tune_out", ["tune_cells"], "select c.*, k from tune_cells c, (select unnest(range(0, 4)) as k)")
define("tune_most", ["tune_out"], """
select task, k, y as most from tune_out where fold <> k group by task, k, y
qualify row_number() over (partition by task, k order by sum(n) desc, y) = 1
""")
define("tune_most_by_x", ["tune_out"], """
select task, k, x, y as most from tune_out where fold <> k group by task, k, x, y
qualify row_number() over (partition by task, k, x order by sum(n) desc, y) = 1
""")
define("tune_means", ["tune_out", "tune_most", "tune_most_by_x"], """
select task, setting, count(*) as n_folds, round(avg(train), 12) as train, round(avg(test), 12) as test from (
  select c.task, s.setting, c.k,
    sum(n) filter (where y = if(setting = 0, a.most, coalesce(b.most, a.most)) and fold <> c.k) / sum(n) filter (where fold <> c.k) as train,
    coalesce(sum(n) filter (where y = if(setting = 0, a.most, coalesce(b.most, a.most)) and fold = c.k), 0) / sum(n) filter (where fold = c.k) as test
  from tune_out c join tune_most a on a.task = c.task and a.k = c.k left join tune_most_by_x b on b.task = c.task and b.k = c.k and b.x = c.x,
    (select unnest(range(0, 2)) as setting) s
  group by all) group by all
""")


# ------------------------------------------------------------------ least squares from fold moments

def fold_gram_sql(numeric: list[str], nominal: list[str]) -> str:
    """Sums of products per fold over the intercept, numbers, a 0/1 column per level (in name order) and the target."""
    long = ["select id, fold, '0' as c, '' as v, 1.0 as x from gram_d"]
    long += [f"select id, fold, '1{i}', '', cast({c} as double) from gram_d" for i, c in enumerate(numeric)]
    long += [f"select id, fold, '2{i}', cast({c} as varchar), 1.0 from gram_d where {c} is not null" for i, c in enumerate(nominal)]
    long += ["select id, fold, '3', '', cast(sale_price as double) from gram_d"]
    return f"""
gram_d as (select *, ('0x' || substr(md5(concat_ws('|', cast(id as varchar), '4')), 1, 8))::bigint % 4 as fold from houses_clean),
gram_long as ({" union all ".join(long)}),
gram_at as (select c, v, cast(row_number() over (order by c, v) - 1 as int) as i from (select distinct c, v from gram_long)),
gram_x as (select id, fold, i, x from gram_long join gram_at using (c, v)),
gram_s as (select a.fold, a.i, b.i as j, sum(a.x * b.x) as value from gram_x a join gram_x b on a.id = b.id and a.i <= b.i group by all)
select f.fold, a.i, b.i as j, printf('%.7e', coalesce(s.value, 0.0)) as value
from (select distinct fold from gram_d) f cross join gram_at a join gram_at b on a.i <= b.i
left join gram_s s on s.fold = f.fold and s.i = a.i and s.j = b.i
"""


# one number, penalties: the slope shrinks by 1 + penalty; errors from the fold's own moments
define("ridge_m", ["cv_d"], """
select p as penalty, k as fold, n, mx, my, cxy / (cxx * (1 + p)) as slope from (
  select o.k, sum(d.one) as n, avg(d.x) as mx, avg(d.y) as my, covar_pop(d.x, d.y) as cxy, var_pop(d.x) as cxx
  from (select *, 1 as one from cv_d) d, (select unnest(range(0, 4)) as k) o where d.fold <> o.k group by o.k),
  (select unnest([0.0, 0.001, 0.01, 0.1, 0.3, 1.0])::double as p)
""")
define("ridge_path", ["cv_d", "ridge_m"], """
select m.penalty, m.fold, case when d.fold = m.fold then 'test' else 'train' end as set, avg(pow(d.y - (my + slope * (d.x - mx)), 2)) as mse
from cv_d d, ridge_m m group by all
""")
define("ridge_chosen", ["ridge_path"], """
select penalty from ridge_path where set = 'test' group by penalty order by avg(mse), penalty desc limit 1
""")
define("building_losses", ["houses_clean"], """
select m.fold, case when d.fold = m.fold then 'test' else 'train' end as set, avg(pow(d.y - m.p, 2)) as mse, avg(abs((d.y - m.p) / nullif(d.y, 0))) as mape
from (select neighborhood = 'BUILDING' as b, sale_price as y,
        ('0x' || substr(md5(concat_ws('|', cast(id as varchar), '4')), 1, 8))::bigint % 4 as fold from houses_clean) d
join (select k as fold, b, avg(y) as p from (select neighborhood = 'BUILDING' as b, sale_price as y,
        ('0x' || substr(md5(concat_ws('|', cast(id as varchar), '4')), 1, 8))::bigint % 4 as fold from houses_clean) h,
        (select unnest(range(0, 4)) as k) o where h.fold <> o.k group by k, b) m on m.b = d.b
group by all
""")


# ------------------------------------------------------------------ importance per task with the pinned rule

RISK_TASKS = ["Risk of Failure to Appear", "Risk of Recidivism", "Risk of Violence"]
RISK_PREDICTORS = ["sex_code_text", "ethnic_code_text", "date_of_birth", "custody_status", "marital_status"]

define("ri_rows", ["risk_split"], """
select *, row_number() over (partition by display_text order by assessment_id) - 1 as i from risk_split where set = 'test'
""")
for _k, _t in enumerate(RISK_TASKS):
    define(f"ri_rows_{_k}", ["ri_rows"], f"select * from ri_rows where display_text = '{_t}'")
    define(f"ri_moves_{_k}", [f"ri_rows_{_k}"], permutation_sql(f"ri_rows_{_k}", [f"1:{_t}:{r}" for r in range(5)]))
define("ri_moves", [f"ri_moves_{k}" for k in range(len(RISK_TASKS))], " union all ".join(
    f"select '{t}' as task, * from ri_moves_{k}" for k, t in enumerate(RISK_TASKS)))


def _risk_rule(dob: str, custody: str) -> str:
    return f"case when {dob} = 'Younger than 25' then 'High' when {custody} = 'Jail Inmate' then 'Medium' else 'Low' end"


define("ri_out", ["ri_rows", "ri_moves"], f"""
select task, feature, quantile_cont(err / base, 0.05) as importance_05, quantile_cont(err / base, 0.5) as importance,
  quantile_cont(err / base, 0.95) as importance_95, quantile_cont(err, 0.5) as permutation_error
from (select m.task, f.feature, m.rep, avg(case when a.score_text <> {_risk_rule("case when f.feature = 'date_of_birth' then d.date_of_birth else a.date_of_birth end",
        "case when f.feature = 'custody_status' then d.custody_status else a.custody_status end")} then 1 else 0 end) as err
      from ri_moves m join ri_rows a on a.display_text = m.task and a.i = m.i join ri_rows d on d.display_text = m.task and d.i = m.j
      cross join (select unnest({RISK_PREDICTORS!r}) as feature) f group by all) e
join (select display_text as task, avg(case when score_text <> {_risk_rule("date_of_birth", "custody_status")} then 1 else 0 end) as base
      from ri_rows group by 1) using (task)
group by all
""")
