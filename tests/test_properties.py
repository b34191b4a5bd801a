"""Property-based checks of the exact-decimal rounding rule."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from cinderframe.functions import round_half_up

# Values with up to 4 decimals (ties at the 3rd decimal included), as doubles.
values = st.lists(st.integers(min_value=-10**8, max_value=10**8).map(lambda i: i / 10**4),
                  min_size=1, max_size=300)


@settings(max_examples=5, deadline=None)
@given(values)
def test_round_half_up_matches_decimal(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    want = [float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for x in xs]
    assert got == want


import datetime as _dt  # noqa: E402

_DAYS = [_dt.date(2024, 1, d) for d in (1, 2, 3)]
_rows = st.lists(st.tuples(st.sampled_from(_DAYS), st.sampled_from(["A", "B"]),
                           st.sampled_from(["O2_flue_gas", "dust_emission"]),
                           st.integers(1, 50).map(float)), min_size=1, max_size=12)


@settings(max_examples=4, deadline=None)
@given(_rows, _rows)
def test_replace_plant_days_model(spark, tmp_path_factory, base, batch):
    """Table after loading = base rows of plant-days not in the batch + the batch rows."""
    from cinderframe.operators import sinks
    from cinderframe.sources import readers
    from conftest import readings

    path = str(tmp_path_factory.mktemp("prop") / "raw")
    ts = _dt.datetime(2024, 2, 1)
    sinks.replace_plant_days(readings(spark, base), path, ts)
    sinks.replace_plant_days(readings(spark, batch), path, ts)
    replaced = {(d, p) for d, p, _, _ in batch}
    want = sorted([r for r in base if (r[0], r[1]) not in replaced] + list(batch))
    got = sorted((r["reading_date"], r["plant_id"], r["sensor"], r["value"])
                 for r in readers.read_sensor_readings(spark, path).collect())
    assert got == want


_intensities = st.lists(st.tuples(st.integers(0, 150_000).map(lambda c: c / 100),
                                  st.integers(1990, 2049)), min_size=1, max_size=200)


@settings(max_examples=4, deadline=None)
@given(_intensities)
def test_net_zero_matches_decimal_arithmetic(spark, rows):
    """Progress and annual reduction equal exact-decimal arithmetic, rounded half up."""
    from decimal import Decimal as D

    from cinderframe.operators import marts
    df = spark.createDataFrame([(_dt.date(y, 6, 1), f"P{i}", x, None) for i, (x, y) in enumerate(rows)],
                               "reading_date date, plant_id string, scope1_kg_per_t double, "
                               "updated_at timestamp")
    got = {r["plant_id"]: r for r in marts.net_zero_progress(df).collect()}

    def q(v, n):
        return float(v.quantize(D(1).scaleb(-n), rounding=ROUND_HALF_UP))

    for i, (x, y) in enumerate(rows):
        cur = D(repr(x))
        r = got[f"P{i}"]
        assert r["progress_pct_to_2030"] == q(max(D(0), (800 - cur) / D(150) * 100), 1)
        assert r["progress_pct_to_2050"] == q(max(D(0), (800 - cur) / D(800) * 100), 1)
        assert r["required_annual_reduction"] == q(cur / D(2050 - y), 2)
        assert r["gap_vs_2030_target"] == float(cur - 650)
