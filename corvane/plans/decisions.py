"""Transition-model, Q-value and policy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import decisions as dc
from corvane.operators import rows as rw
from corvane.plans import query
from corvane.plans.sequences import TRANSITIONS, event_transitions

GAMMA, ROUNDS = 0.9, 3


def _q_sql(rounds: int, backup: str = "max", name: str = "q") -> str:
    """Unrolled rounds as common table expressions; the last one is ``name``."""
    parts = [f"tr AS {TRANSITIONS}" if backup == "max" else f"tr AS (SELECT * FROM {TRANSITIONS} WHERE s_next IS NOT NULL)",
             "q0 AS (SELECT DISTINCT s, a, 0.0::DOUBLE AS q FROM tr)"]
    for i in range(rounds):
        if backup == "max":
            look = f"LEFT JOIN (SELECT s AS sn, max(q) AS v FROM q{i} GROUP BY s) b ON sn = s_next"
        else:
            look = f"LEFT JOIN (SELECT s AS sn, a AS an, q AS v FROM q{i}) b ON sn = s_next AND an = tr.a"
        parts.append(f"q{i + 1} AS (SELECT tr.s, tr.a, avg(r + {GAMMA}::DOUBLE * coalesce(v, 0)) AS q FROM tr {look} GROUP BY tr.s, tr.a)")
    parts.append(f"{name} AS (SELECT * FROM q{rounds})")
    return ", ".join(parts)


def _q(t, backup="max"):
    return dc.fitted_q(event_transitions(t), GAMMA, ROUNDS, backup)


@query("a20_transition_model", f"""
    WITH c AS (SELECT s, a, s_next, count(*) AS n, avg(r) AS m FROM {TRANSITIONS} GROUP BY ALL)
    SELECT s, a, s_next, n, round(n / sum(n) OVER (PARTITION BY s, a), 6) AS p, round(m, 9) AS mean_r FROM c""")
def a20(t):
    model = dc.transition_model(event_transitions(t))
    return model.withColumns({"p": F.round("p", 6), "mean_r": F.round("mean_r", 9)})


@query("a21_q_score", f"""
    WITH w AS (SELECT s || '|' || a AS feature, avg(r) AS w FROM {TRANSITIONS} WHERE s_next IS NOT NULL GROUP BY 1)
    SELECT s, a, round(sum(coalesce(w, 0)), 2) AS q FROM {TRANSITIONS} LEFT JOIN w ON feature = s || '|' || a GROUP BY s, a""")
def a21(t):
    tr = event_transitions(t)
    weights = tr.filter("s_next is not null").groupBy(F.concat_ws("|", "s", "a").alias("feature")).agg(F.avg("r").alias("w"))
    return dc.q_score(rw.with_features(tr, rw.identity_features), weights).withColumn("q", F.round("q", 2))


@query("a22_greedy", f"WITH {_q_sql(ROUNDS)} SELECT s, arg_max(a, (q, a)) AS a, round(max(q), 4) AS q FROM q GROUP BY s")
def a22(t):
    return dc.greedy(_q(t)).withColumn("q", F.round("q", 4))


_TD = f"""{_q_sql(ROUNDS)}, td AS (SELECT event_id, r + {GAMMA}::DOUBLE * coalesce(v, 0) - coalesce(q.q, 0) AS td FROM tr
    LEFT JOIN q ON q.s = tr.s AND q.a = tr.a LEFT JOIN (SELECT s, max(q) AS v FROM q GROUP BY s) b ON b.s = tr.s_next)"""


@query("a23_td_error", f"WITH {_TD} SELECT event_id, round(td, 4) AS td FROM td")
def a23(t):
    tr = event_transitions(t)
    return dc.td_error(tr, dc.fitted_q(tr, GAMMA, ROUNDS), GAMMA).select("event_id", F.round("td", 4).alias("td"))


@query("a23_td_mse", f"WITH {_TD} SELECT round(avg(td * td), 3) AS mse FROM td")
def a23_mse(t):
    tr = event_transitions(t)
    return dc.td_mse(dc.td_error(tr, dc.fitted_q(tr, GAMMA, ROUNDS), GAMMA)).select(F.round("mse", 3).alias("mse"))


@query("g5_fitted_q", f"WITH {_q_sql(ROUNDS)} SELECT s, a, round(q, 4) AS q FROM q")
def g5(t):
    return _q(t).withColumn("q", F.round("q", 4))


@query("g6_fitted_q_same_action", f"WITH {_q_sql(ROUNDS, 'same')} SELECT s, a, round(q, 4) AS q FROM q")
def g6(t):
    return _q(t, "same").withColumn("q", F.round("q", 4))


def _u(seed: int) -> str:
    return f"(('0x' || substr(md5(event_id || ':{seed}'), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE)"


@query("g7_policy", f"""
    WITH {_q_sql(ROUNDS)}, pick AS (SELECT s, list_sort(list(DISTINCT a)) AS acts, arg_max(a, (q, a)) AS best FROM q GROUP BY s)
    SELECT event_id, event_type AS s, {_u(11)} < 0.2 AS explore,
      CASE WHEN {_u(11)} < 0.2 THEN acts[floor({_u(12)} * len(acts))::INT + 1] ELSE best END AS a
    FROM events JOIN pick ON s = event_type""")
def g7(t):
    rows = t("events").select("event_id", F.col("event_type").alias("s"))
    return dc.policy(rows, _q(t), 0.2, 11, ["event_id"])
