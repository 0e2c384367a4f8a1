"""Randomised checks against brute-force Python definitions (small inputs)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barforge.operators.candles import candles_of, packed_order_key, struct_order_key
from barforge.operators.rates import counter_rate
from barforge.operators.sinks import insert_if_absent

T0 = datetime(2024, 1, 1)
SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

trade = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.integers(0, 400),            # seconds after T0 (many ties)
    st.integers(1, 50_000),         # price in cents
    st.integers(0, 20),             # size
    st.integers(-(2**40), 2**40),   # trade id
)


def _brute_candles(rows, window_s):
    out = {}
    for sym, sec, cents, size, tid in rows:
        ws = T0 + timedelta(seconds=(sec // window_s) * window_s)
        out.setdefault((sym, ws), []).append(((sec, tid), cents / 100.0, float(size)))
    res = {}
    for key, items in out.items():
        items.sort(key=lambda x: x[0])
        prices = [p for _, p, _ in items]
        res[key] = (items[0][1], max(prices), min(prices), items[-1][1], sum(s for _, _, s in items))
    return res


@settings(**SETTINGS)
@given(st.lists(trade, min_size=1, max_size=60, unique_by=lambda t: t[4]), st.sampled_from([60, 120]))
def test_candles_match_brute_force(spark, rows, window_s):
    df = spark.createDataFrame(
        [(s, T0 + timedelta(seconds=sec), c / 100.0, float(z), tid) for s, sec, c, z, tid in rows],
        "symbol string, ts timestamp, price double, size double, trade_id long",
    )
    for order in ("packed", "struct"):
        got = {
            (r["symbol"], r["window_start"]): (r["open"], r["high"], r["low"], r["close"], r["volume"])
            for r in candles_of(df, f"{window_s} seconds", packed_order_key() if order == "packed" else struct_order_key()).collect()
        }
        assert got == _brute_candles(rows, window_s)


def _brute_rate(samples, range_s):
    res = {}
    for i, (t, v) in enumerate(samples):
        frame = [(tt, vv, j) for j, (tt, vv) in enumerate(samples) if t - range_s <= tt <= t]
        inc = 0
        for (_, v0, j0), (_, v1, _) in zip(frame, frame[1:]):
            d = v1 - v0
            inc += v1 if d < 0 else d
        span = t - frame[0][0]
        res[t] = (inc, inc / span if span > 0 else None)
    return res


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 9)), min_size=1, max_size=40))
def test_counter_rate_matches_brute_force(spark, steps):
    t, v, samples = 0, 0, []
    for gap, inc in steps:
        t += gap * 60
        v = 0 if inc == 0 and v > 20 else v + inc  # occasional reset
        samples.append((t, v))
    df = spark.createDataFrame([("s", T0 + timedelta(seconds=tt), vv) for tt, vv in samples],
                               "symbol string, ts timestamp, value long")
    got = {int((r["ts"] - T0).total_seconds()): (r["increase"], r["rate"]) for r in counter_rate(df, 3600).collect()}
    want = _brute_rate(samples, 3600)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert (got[k][1] is None) == (want[k][1] is None)
        if want[k][1] is not None:
            assert abs(got[k][1] - want[k][1]) < 1e-12


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 5), st.integers(0, 99)), max_size=20),
       st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 5), st.integers(0, 99)), max_size=20))
def test_insert_if_absent_first_writer_wins(spark, target_rows, incoming_rows):
    target = {}
    for k1, k2, v in target_rows:
        target.setdefault((k1, k2), v)
    schema = "k1 string, k2 int, v int"
    tdf = spark.createDataFrame([(a, b, v) for (a, b), v in target.items()], schema)
    idf = spark.createDataFrame([(a, b, v) for (a, b, v) in incoming_rows], schema)
    got = {(r["k1"], r["k2"]): r["v"] for r in insert_if_absent(tdf, idf, ["k1", "k2"], order_col="v").collect()}
    want = dict(target)
    for k1, k2, v in sorted(incoming_rows, key=lambda r: r[2]):
        want.setdefault((k1, k2), v)
    assert got == want
