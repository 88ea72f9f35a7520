import datetime as dt
import random
from collections import defaultdict

import pytest

from sparkmart.operators import attribution

DDL = (
    "touch_id bigint, customer_id string, channel string, campaign string, touchpoint_date date,"
    " touch_cost double, is_converted int"
)
DAY = dt.date(2024, 1, 1)
FIRST_DAY = dt.date(1, 1, 1)


def _touches(seed=3, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        customer = "HOT" if rng.random() < 0.35 else f"C{rng.randrange(250)}"
        customer = None if rng.random() < 0.03 else customer
        day = None if rng.random() < 0.02 else DAY + dt.timedelta(days=rng.randrange(40))
        channel = rng.choice(["Email", "Social", "Referral", "Direct Mail"])
        rows.append(
            (i * 700_000 % 999_999_937, customer, channel, "k", day, round(rng.random() * 9, 2),
             int(rng.random() < 0.15))
        )
    return rows


def _by_customer(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[4] or FIRST_DAY, r[0]))
    return groups


def _brute(rows, model):
    out = {}
    for customer, g in _by_customer(rows).items():
        if customer is None and model in attribution.KNOWN_CUSTOMER_ONLY:
            continue
        n, converted = len(g), sum(r[6] for r in g)
        days = [r[4] for r in g if r[6] and r[4]]
        weights = [
            2.0 ** (-(min(days) - r[4]).days / 7) if days and r[4] and r[4] <= min(days) else 0.0
            for r in g
        ]
        for i, r in enumerate(g):
            if model == "first_click":
                credit = float(converted > 0 and i == 0)
            elif model == "last_click":
                credit = float(r[6] == 1 and i == n - 1)
            elif model == "linear":
                credit = 1 / n if converted else 0.0
            elif model == "time_decay":
                credit = weights[i] / sum(weights) if sum(weights) else 0.0
            elif not converted:
                credit = 0.0
            elif n <= 2:
                credit = 1 / n
            else:
                credit = 0.4 if i in (0, n - 1) else 0.2 / (n - 2)
            out[r[0]] = (credit, i + 1)
    return out


@pytest.fixture(scope="module")
def touches(spark):
    rows = _touches()
    return rows, spark.createDataFrame(rows, DDL).repartition(6).cache()


@pytest.mark.parametrize("model", attribution.MODELS)
def test_models_match_the_definition(touches, model):
    rows, df = touches
    want = _brute(rows, model)
    got = {r.touch_id: r for r in getattr(attribution, model)(df).collect()}
    assert got.keys() == want.keys()
    for touch, (credit, position) in want.items():
        assert abs(got[touch].attribution_credit - credit) <= 5.0001e-7, (model, touch)
        assert got[touch].attributed_conversions == got[touch].attribution_credit
        if model == "position_based":
            assert got[touch].touch_position == position


def test_string_ids_rank_the_same(spark, touches):
    rows, _ = touches
    texts = [(f"T_{r[0]:012d}", *r[1:]) for r in rows]
    df = spark.createDataFrame(texts, DDL.replace("touch_id bigint", "touch_id string"))
    want = {f"T_{t:012d}": p for t, (_, p) in _brute(rows, "position_based").items()}
    got = {r.touch_id: r.touch_position for r in attribution.position_based(df).collect()}
    assert got == want


def test_credits_of_a_converting_customer_sum_to_one(touches):
    rows, df = touches
    for model in ("linear", "position_based"):
        totals = defaultdict(float)
        sizes = defaultdict(int)
        for r in getattr(attribution, model)(df).collect():
            totals[r.customer_id] += r.attribution_credit
            sizes[r.customer_id] += 1
        for customer, total in totals.items():
            assert total == 0 or abs(total - 1) <= sizes[customer] * 1e-6


def test_comparison_equals_the_stacked_models(touches):
    rows, df = touches
    stacked = attribution.stack([getattr(attribution, m)(df) for m in attribution.MODELS]).collect()
    credit, spend, count = defaultdict(float), defaultdict(float), defaultdict(int)
    for r in stacked:
        key = (r.attribution_model, r.channel)
        credit[key] += r.attribution_credit
        spend[key] += r.touch_cost
        count[key] += 1
    got = {(r.attribution_model, r.channel): r for r in attribution.compare(df).collect()}
    assert got.keys() == count.keys()
    for key, r in got.items():
        assert r.total_touches == count[key]
        assert abs(r.total_spend - spend[key]) < 0.006
        assert abs(r.attributed_conversions - credit[key]) < 0.006
    for model in attribution.MODELS:
        assert abs(sum(r.conversion_share_pct for k, r in got.items() if k[0] == model) - 100) < 0.05


def test_one_pass_equals_the_stack(touches):
    _, df = touches
    stacked = attribution.stack([getattr(attribution, m)(df) for m in attribution.MODELS])
    one_pass = attribution.all_models(df)
    assert one_pass.columns == stacked.columns
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, stacked.collect()))


def test_recommendation_limits(spark):
    rows = [("linear", c, s) for c, s in (("a", 5.0), ("b", -5.0), ("c", 4.99), ("d", None))]
    df = spark.createDataFrame(
        [(m, c, 1.0, 1.0, s) for m, c, s in rows + [("time_decay", "z", 9.0)]],
        "attribution_model string, channel string, spend_share_pct double,"
        " conversion_share_pct double, reallocation_signal double",
    )
    assert {r.channel: r.recommendation for r in attribution.recommend(df).collect()} == {
        "a": "Increase budget", "b": "Reduce budget", "c": "Maintain budget", "d": "Maintain budget",
    }
