"""Randomised checks of the encoding contracts against plain Python."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from boutique.functions import clean
from boutique.operators import encode

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 120)), min_size=1, max_size=25))
def test_onehot_matches_drop_first_contract(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, a int")
    out = {r["id"]: r.asDict() for r in encode.onehot_columns(df, ["a"]).collect()}
    cats = sorted({v for v in values if v is not None})
    kept = cats[1:]
    for i, v in enumerate(values):
        row = out[i]
        assert {k for k in row if k.startswith("a_")} == {f"a_{c}" for c in kept}
        for c in kept:
            assert row[f"a_{c}"] == (1 if v == c else 0)


@SETTINGS
@given(st.lists(st.text(alphabet="abcxyz", min_size=1, max_size=3), min_size=1, max_size=40),
       st.integers(1, 9))
def test_dense_codes_match_sorted_enumeration(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["code"] for r in encode.dense_codes(df, ["k"], "code", partitions=parts).collect()}
    want = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=20))
def test_share_is_exact_or_zero(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(clean.share("a", df.a + df.b)).collect()]
    for (a, b), s in zip(pairs, got):
        assert s == (float(Fraction(a, a + b)) if a + b else 0.0)
