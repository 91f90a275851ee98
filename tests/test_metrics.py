import random

from opinio.operators import metrics as mx


def _brute(rows):
    classes = sorted({y for y, _ in rows} | {p for _, p in rows})
    n = len(rows)
    out = {}
    for c in classes:
        tp = sum(1 for y, p in rows if y == c and p == c)
        sup = sum(1 for y, _ in rows if y == c)
        pred = sum(1 for _, p in rows if p == c)
        pr = tp / pred if pred else 0.0
        rc = tp / sup if sup else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        out[c] = (pr, rc, f1, sup)
    acc = sum(1 for y, p in rows if y == p) / n
    w = lambda k: sum(out[c][k] * out[c][3] for c in classes) / n
    return acc, w(0), w(1), w(2)


def test_metrics_match_brute_force(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = mx.classification_metrics(df).first()
    acc, p, r, f1 = _brute(rows)
    assert abs(m.accuracy - acc) < 1e-9 and abs(m.precision - p) < 1e-9
    assert abs(m.recall - r) < 1e-9 and abs(m.f1 - f1) < 1e-9
    cm = {r.label: (r.pred_0, r.pred_1) for r in mx.confusion_matrix(df).collect()}
    assert sum(cm[0]) + sum(cm[1]) == 500


def test_auc_matches_pairwise(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg) / (len(pos) * len(neg))
    for buckets in (1, 7, 4096):
        got = mx.roc_auc(df, "label", "score", buckets=buckets).first().roc_auc
        assert abs(got - brute) < 1e-9


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    m = mx.classification_metrics(df).first()
    assert m.accuracy == 1.0 and m.f1 == 1.0
    rep = {r["class"]: r for r in mx.classification_report(df).collect()}
    assert rep["accuracy"].f1_score == 1.0 and rep["macro avg"].support == 2
