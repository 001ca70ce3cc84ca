"""F5 against Python's own ``float()`` on generated text (the reference's rule:
``float(x)``, 0.0 when it raises)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tradelens.functions.coercion import coerce_amount

ALPHABET = "0123456789+-.eE_, \t\nxinfatyINFATY"


def python_rule(text):
    try:
        v = float(text)
    except ValueError:
        return 0.0
    return None if math.isnan(v) else v  # a NaN amount adds nothing to a sum


texts = st.one_of(
    st.text(alphabet=ALPHABET, max_size=8),
    st.from_regex(r"\A\s?[+-]?[0-9]{1,4}(_[0-9]{1,3})?(\.[0-9]{0,3})?([eE][+-]?[0-9]{1,2})?\s?\Z"),
    st.sampled_from(["inf", "-Infinity", "nan", "+NaN", "1e", "e1", "1__0", "_1", "1_", ".", "-.5", "5."]),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(texts, min_size=300, max_size=300))
def test_coercion_matches_python_float(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.a for r in df.select("i", coerce_amount("s").alias("a")).collect()}
    for i, v in enumerate(values):
        exp = python_rule(v)
        assert got[i] == exp, (v, got[i], exp)
