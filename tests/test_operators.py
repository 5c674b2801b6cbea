"""Golden cases and properties of row, statistic, graph and decision operators."""

import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.operators import decisions as dc
from corvane.operators import graph as gr
from corvane.operators import lookup as lk
from corvane.operators import retrieval as rt
from corvane.operators import rouge as rg
from corvane.operators import rows as rw
from corvane.operators import sequences as sq
from corvane.operators import stats as st


def test_require_rows(spark):
    assert rw.require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError):
        rw.require_rows(spark.range(0))


def test_colour(spark):
    df = spark.createDataFrame([(["azul"],), (["azul", "verde"],), (["nope"],)], "line array<string>")
    assert [r[0] for r in df.select(rw.colour(F.col("line"))).collect()] == ["darkblue", "black", None]


def test_resolve_side(spark):
    df = spark.createDataFrame([("Kasparov, G", "Karpov, A"), ("Short, N", "Kasparov, G"), ("X", "Y")], "white string, black string")
    good, bad = rw.split_inconsistent(rw.resolve_side(df, "kasparov"))
    assert sorted((r["side"], r["opponent"]) for r in good.collect()) == [("B", "short"), ("W", "karpov")]
    assert [(r["white"], r["opponent"]) for r in bad.collect()] == [("X", None)]


def test_arrays_and_columns(spark):
    df = spark.createDataFrame([(1, [3, 4])], "id int, s array<int>")
    wide = rw.widen_array(df, "s", 3, "f")
    assert wide.first().asDict() == {"id": 1, "f0": 3, "f1": 4, "f2": None}
    assert rw.narrow_array(wide, ["f0", "f1"], "s").first()["s"] == [3, 4]
    x, y = rw.xy(wide, ["f1"])
    assert x.columns == ["id", "f0", "f2"] and y.columns == ["f1"]


def test_versions_and_metrics(spark):
    df = spark.createDataFrame([("checkpoint-50",), ("checkpoint-100",), ("other-900",), ("checkpoint-x",)], "n string")
    assert st.latest_version(df, "n").first()["latest"] == "checkpoint-100"
    assert st.latest_version(df.filter("n like 'other%'"), "n").first()["latest"] is None
    log = spark.createDataFrame([(1, "a"), (3, "c"), (2, "b")], "step int, m string")
    assert st.last_metric(log, "step", F.col("m")).first()[0] == "c"
    assert st.last_metric(log.limit(0), "step", F.col("m")).first()[0] == "No metrics available"


def test_minmax_mirrored(spark):
    df = spark.createDataFrame([(w,) for w in ar.BOARD_WEIGHTS], "w int")
    got = {r["w"]: r["scaled"] for r in st.mirrored(st.minmax(df, "w"), "w", "scaled").collect()}
    assert got == {k: pytest.approx(v) for k, v in ar.scaled_weights().items()}


def test_classification_report_golden(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2 + [(2, 0)]
    df = spark.createDataFrame(pairs, "y int, p int").repartition(3)
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in st.classification_report(df, "y", "p").collect()}
    assert got["0"] == (pytest.approx(3 / 6), pytest.approx(3 / 4), pytest.approx(0.6), 4)
    assert got["1"] == (pytest.approx(2 / 3), pytest.approx(1 / 2), pytest.approx(4 / 7), 4)
    assert got["2"] == (0, 0, 0, 1)
    assert got["accuracy"][0] == pytest.approx(5 / 9)
    assert got["macro avg"][2] == pytest.approx((0.6 + 4 / 7) / 3)
    assert got["weighted avg"][1] == pytest.approx((3 + 2) / 9)
    assert st.balanced_accuracy(df, "y", "p").first()[0] == pytest.approx((0.75 + 0.5) / 3)


def test_auc_with_ties(spark):
    data = [(1, 3), (0, 3), (1, 5), (0, 1), (1, 1), (0, 0)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert st.auc(spark.createDataFrame(data, "y int, s int"), "y", "s").first()[0] == pytest.approx(want)


def test_reigns(spark):
    lines = [" 1901, 1903, 1911 (Alder)", "            1917 (Birch)", "            1920 (Alder)", "no name"]
    got = st.union_sets(lk.parse_reigns(spark.createDataFrame([(x,) for x in lines], "line string"), "line"), "alias", "year")
    assert {r["alias"]: r["members"] for r in got.collect()} == {"Alder": ["1901", "1903", "1911", "1920"], "Birch": ["1917"]}


def test_fill_chain(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 2.0), ("c", 0.0), ("d", 5.0)], "k string, lat double")
    manual = spark.createDataFrame([("d", 9.0)], "k string, lat double")
    second = spark.createDataFrame([("a", 1.0), ("b", 7.0)], "k string, lat double")
    out = lk.fill_missing(lk.fill_from(df, manual, ["k"], ["lat"]), second, ["k"], ["lat"])
    assert {r["k"]: r["lat"] for r in out.collect()} == {"a": 1.0, "b": 2.0, "c": None, "d": 9.0}


def test_knn_skips_itself(spark):
    pts = spark.createDataFrame([(i, float(x), 0.0) for i, x in enumerate([0, 0, 1, 3, 10])], "id long, x double, y double")
    got = {}
    for r in rt.knn(pts, pts, 3).collect():
        got.setdefault(r["qid"], {})[r["rank"]] = (r["id"], r["dist"])
    assert got[0] == {1: (1, 0.0), 2: (2, 1.0), 3: (3, 3.0)}
    assert got[1] == {1: (0, 0.0), 2: (2, 1.0), 3: (3, 3.0)}


# -- ROUGE ---------------------------------------------------------------------------

def lcs_len(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def f100(hit, m, n):
    return 100 * 2 * (hit / m) * (hit / n) / (hit / m + hit / n) if hit else 0.0


def test_rouge_against_model(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c d e f".split()) for _ in range(n)) for n in (0, 1, 5, 40, 200, 3)]
    data = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(data, "id int, prediction string, reference string").repartition(4)
    got1 = {r["id"]: r["rouge1"] for r in rg.rouge_n(df, 1, ["id"]).collect()}
    got2 = {r["id"]: r["rouge2"] for r in rg.rouge_n(df, 2, ["id"]).collect()}
    got_l = {r["id"]: r for r in rg.rouge_l(df, ["id"]).collect()}
    for i, p, r in data:
        p, r = p.split(), r.split()
        for n, got in ((1, got1), (2, got2)):
            a, b = (Counter(zip(*[t[k:] for k in range(n)])) for t in (p, r))
            assert got[i] == pytest.approx(f100(sum((a & b).values()), sum(a.values()) or 1, sum(b.values()) or 1))
        want = f100(lcs_len(p, r), len(p) or 1, len(r) or 1)
        assert got_l[i]["rougeL"] == pytest.approx(want)
        assert got_l[i]["rougeLsum"] == pytest.approx(want)  # one line: the same score


def test_rouge_equal_texts_and_lines(spark):
    text = "Alpha beta, GAMMA-1.\nDelta beta!\n\nalpha"
    df = spark.createDataFrame([(1, text, text), (2, "a b\nc d", "c d\na b"), (3, "a c", "a b\nc")],
                               "id int, prediction string, reference string")
    one = rg.rouge_n(df, 1, ["id"]).join(rg.rouge_n(df, 2, ["id"]), "id").join(rg.rouge_l(df, ["id"]), "id")
    got = {r["id"]: r for r in one.collect()}
    assert all(got[1][c] == pytest.approx(100) for c in ("rouge1", "rouge2", "rougeL", "rougeLsum"))
    assert got[2]["rougeL"] == pytest.approx(50) and got[2]["rougeLsum"] == pytest.approx(100)
    assert got[3]["rougeLsum"] == pytest.approx(f100(2, 3, 2))


def test_subsequence_positions_in_little_memory():
    rng = random.Random(2)
    for n, m, letters in ((0, 3, "ab"), (7, 0, "ab"), (30, 41, "ab"), (60, 37, "abcd"), (90, 90, "abcdefgh")):
        for _ in range(20):
            a, b = ([rng.choice(letters) for _ in range(k)] for k in (n, m))
            assert rg._lcs_positions(a, b) == lcs_walk(a, b)
    a, b = ([str(rng.randrange(5000)) for _ in range(20000)] for _ in range(2))
    tracemalloc.start()
    found = rg._lcs_positions(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == rg._lcs_length(a, b) and peak < 50e6


def lcs_walk(a, b):
    """The walk back over a whole table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found, i, j = set(), len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def test_rouge_means(spark):
    df = spark.createDataFrame([(1, "a b c", "a b c"), (2, "a b", "b a"), (3, None, "a"), (4, "x", "y")],
                               "id int, prediction string, reference string")
    got = st.rouge_means(df, ["id"]).first().asDict()
    assert got == {k: pytest.approx(v) for k, v in {"rouge1": 50, "rouge2": 25, "rougeL": 37.5, "rougeLsum": 37.5}.items()}


def lsum_model(ref, pred):
    """Slow restatement: the longest common subsequences of all line pairs, by plain tables."""
    refs, cands = ([line.split() for line in t.split("\n")] for t in (ref, pred))
    left_r, left_c = (Counter(w for line in lines for w in line) for lines in (refs, cands))
    hit = 0
    for r in refs:
        used = set()
        for c in cands:
            t = [[0] * (len(c) + 1) for _ in range(len(r) + 1)]
            for i in range(1, len(r) + 1):
                for j in range(1, len(c) + 1):
                    t[i][j] = t[i - 1][j - 1] + 1 if r[i - 1] == c[j - 1] else max(t[i - 1][j], t[i][j - 1])
            i, j = len(r), len(c)
            while i > 0 and j > 0:
                if r[i - 1] == c[j - 1]:
                    used.add(i - 1)
                    i, j = i - 1, j - 1
                elif t[i][j - 1] > t[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for w in (r[k] for k in sorted(used)):
            if left_r[w] and left_c[w]:
                left_r[w] -= 1
                left_c[w] -= 1
                hit += 1
    return f100(hit, sum(map(len, refs)) or 1, sum(map(len, cands)) or 1)


def test_rouge_lsum_against_model(spark):
    rng = random.Random(9)
    text = lambda: "\n".join(" ".join(rng.choice("a b c d e".split()) for _ in range(rng.randrange(6)))
                             for _ in range(rng.randrange(1, 7)))
    data = [(i, text(), text()) for i in range(60)]
    df = spark.createDataFrame(data, "id int, prediction string, reference string").repartition(3)
    got = {r["id"]: r["rougeLsum"] for r in rg.rouge_l(df, ["id"]).collect()}
    for i, pred, ref in data:
        assert got[i] == pytest.approx(lsum_model(ref, pred))


# -- graph and decisions -------------------------------------------------------------

def test_least_cost_golden(spark):
    edge = spark.createDataFrame([("A", "B", 1.0), ("B", "C", 1.0), ("A", "C", 5.0), ("X", "Y", 1.0)], "src string, dst string, cost double")
    path = gr.least_cost_path(edge, "A", "C")
    assert [(r["cost"], r["path"]) for r in path.collect()] == [(2.0, ["A", "B", "C"])]
    assert gr.least_cost_path(edge, "A", "Y").isEmpty()
    assert [r["node"] for r in gr.unroll(path).orderBy("depth").collect()] == ["C", "B", "A"]


def test_paths_and_reach_against_model(spark):
    rng = random.Random(11)
    links = [(rng.randrange(30), rng.randrange(30), float(rng.randrange(1, 50))) for _ in range(70)]
    edge = spark.createDataFrame(links, "src long, dst long, cost double")
    best = {0: 0.0}
    for _ in range(31):
        for s, d, c in links:
            if s in best and best[s] + c < best.get(d, 1e18):
                best[d] = best[s] + c
    got = {r["id"]: r for r in gr.least_costs(edge, 0).collect()}
    assert {k: r["cost"] for k, r in got.items()} == best
    cheapest = {}
    for s, d, c in links:
        cheapest[s, d] = min(c, cheapest.get((s, d), 1e18))
    for k, r in got.items():
        assert r["path"][0] == 0 and r["path"][-1] == k
        assert sum(cheapest[a, b] for a, b in zip(r["path"], r["path"][1:])) == r["cost"]
    hops, frontier = {0: 0}, [0]
    while frontier:
        frontier = sorted({d for s, d, _ in links if s in frontier} - set(hops))
        hops.update({d: max(hops.values()) + 1 for d in frontier})
    reach = gr.reachable(edge, spark.createDataFrame([(0,)], "id long"))
    assert {r["id"]: r["hops"] for r in reach.collect()} == hops
    with pytest.raises(RuntimeError):
        gr.reachable(edge, spark.createDataFrame([(0,)], "id long"), max_rounds=0)


def test_transition_probabilities_sum_to_one(spark):
    tr = spark.createDataFrame([("s", "a", "x", 1.0), ("s", "a", "x", 3.0), ("s", "a", None, 0.0), ("s", "b", "s", 2.0)],
                               "s string, a string, s_next string, r double")
    model = dc.transition_model(tr)
    for r in model.groupBy("s", "a").agg(F.sum("p").alias("p")).collect():
        assert r["p"] == pytest.approx(1)
    got = {(r["a"], r["s_next"]): (r["n"], r["mean_r"]) for r in model.collect()}
    assert got == {("a", "x"): (2, 2.0), ("a", None): (1, 0.0), ("b", "s"): (1, 2.0)}


def fitted_model(rows, gamma, rounds, same):
    if same:
        rows = [x for x in rows if x[2] is not None]
    q = {(s, a): 0.0 for s, a, _, _ in rows}
    for _ in range(rounds):
        sums = {}
        for s, a, n, r in rows:
            v = q.get((n, a), 0.0) if same else max([x for (t, _), x in q.items() if t == n], default=0.0)
            sums.setdefault((s, a), []).append(r + gamma * v)
        q = {k: sum(v) / len(v) for k, v in sums.items()}
    return q


@pytest.mark.parametrize("backup", ["max", "same"])
@pytest.mark.parametrize("rounds", [0, 1, 7])
def test_fitted_q_against_model(spark, backup, rounds):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), rng.choice("ab"), rng.choice(["x", "y", "z", None]), float(rng.randrange(10))) for _ in range(60)]
    tr = spark.createDataFrame(rows, "s string, a string, s_next string, r double").repartition(3)
    got = {(r["s"], r["a"]): r["q"] for r in dc.fitted_q(tr, 0.9, rounds, backup).collect()}
    assert got == {k: pytest.approx(v) for k, v in fitted_model(rows, 0.9, rounds, backup == "same").items()}


def test_greedy_tie_takes_larger_name(spark):
    q = spark.createDataFrame([("s", "Peek", 1.0), ("s", "Take", 1.0), ("s", "Quit", 0.0)], "s string, a string, q double")
    assert dc.greedy(q).first()["a"] == "Take"
    rows = spark.range(4000).select("id", F.lit("s").alias("s"))
    out = dc.policy(rows, q, 0.2, 1, ["id"])
    counts = Counter((r["explore"], r["a"]) for r in out.collect())
    assert set(a for e, a in counts if not e) == {"Take"}
    assert 600 < sum(n for (e, _), n in counts.items() if e) < 1000
    assert {a for e, a in counts if e} == {"Peek", "Take", "Quit"}


def test_td_and_q_score(spark):
    q = spark.createDataFrame([("s", "a", 2.0), ("t", "a", 1.0), ("t", "b", 4.0)], "s string, a string, q double")
    tr = spark.createDataFrame([("s", "a", 1.0, "t"), ("t", "b", 1.0, None)], "s string, a string, r double, s_next string")
    td = {r["s"]: r["td"] for r in dc.td_error(tr, q, 0.5).collect()}
    assert td == {"s": pytest.approx(1 + 0.5 * 4 - 2), "t": pytest.approx(1 - 4)}
    weights = spark.createDataFrame([("s|a", 2.0)], "feature string, w double")
    scored = dc.q_score(rw.with_features(q, rw.identity_features).drop("q"), weights)
    assert {(r["s"], r["a"]): r["q"] for r in scored.collect()} == {("s", "a"): 2.0, ("t", "a"): 0.0, ("t", "b"): 0.0}


def test_line_neighbours_golden(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0, "L"), (2, 5.0, 0.0, "L"), (3, 2.0, 0.0, "L"), (3, 2.0, 0.0, "M")],
                                "id long, x double, y double, line string")
    near = sq.line_neighbours(pts)
    assert {(r["line"], r["id"]): (r["prev"], r["next"]) for r in near.collect()} == {
        ("L", 1): (None, 3), ("L", 3): (1, 2), ("L", 2): (3, None), ("M", 3): (None, None)}
    assert {r["id"]: r["neigh"] for r in sq.neighbour_lists(near).collect()} == {1: [3], 2: [3], 3: [1, 2]}


def test_terminal_row(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "a")], "k int, t int, v string")
    got = sorted((r["step"], r["state"], r["action"]) for r in sq.trajectory(df, ["k"], ["t"], "v", ["a", "b"]).collect())
    assert got == [(0, [0, 0], "a"), (1, [1, 0], "b"), (2, [1, 1], "a")]
    last = sq.trajectory(df, ["k"], ["t"], "v", ["a", "b"], terminal=True).filter("action is null").first()
    assert (last["step"], last["state"]) == (3, [2, 1])


def test_transition_model_keeps_null_states_and_actions(spark):
    rows = [("s", "a", "t", 1.0), (None, "a", "t", 2.0), ("s", None, None, 3.0), ("s", None, "t", 5.0)]
    got = dc.transition_model(spark.createDataFrame(rows, "s string, a string, s_next string, r double")).collect()
    assert {(r["s"], r["a"], r["s_next"]): (r["p"], r["mean_r"]) for r in got} == {
        ("s", "a", "t"): (1.0, 1.0), (None, "a", "t"): (1.0, 2.0), ("s", None, None): (0.5, 3.0), ("s", None, "t"): (0.5, 5.0)}


def test_confusion_matrix_counts_unlisted_predictions(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, None), (1, 1)], "y int, yhat int")
    got = {r["y"]: (r["pred_0"], r["pred_1"], r["pred_other"]) for r in st.confusion_matrix(df, "y", "yhat", [0, 1]).collect()}
    assert got == {0: (1, 0, 1), 1: (0, 1, 1)}


def test_rouge_scores_each_pair_where_it_lies(spark):
    """Hash tables of all n-grams of a partition outgrew a task; the scores of a pair need no shuffle."""
    rows = [(1, "A b a-c", "a a b d"), (2, None, "x"), (3, "x", ""), (4, "a b", "a b"), (5, "Ka İ", "ka i")]
    df = spark.createDataFrame(rows, "id long, prediction string, reference string")
    out = rg.rouge(df, ["id"], ["rouge1", "rouge2"])
    for scored in (out, rg.rouge_n(df, 2, ["id"])):
        assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: (r["rouge1"], r["rouge2"]) for r in out.collect()}
    assert got[2] == got[3] == (0.0, 0.0) and got[4] == (100.0, 100.0) and got[5] == (100.0, 100.0)
    assert got[1] == (pytest.approx(75.0), pytest.approx(100 / 3))
