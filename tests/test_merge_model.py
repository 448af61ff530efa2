"""merge_frames against a plain-Python model of the upsert semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.merge import OP, merge_frames

keys = st.one_of(st.none(), st.integers(0, 6))


def model(target, source, null_safe, ordered):
    def eq(a, b):
        return a == b if null_safe else (a is not None and a == b)

    out = []
    for tk, tv in target:
        match = [s for s in source if eq(tk, s[0])]
        taken = match and not (ordered and tv > match[0][1])
        out.append((match[0][0], match[0][1], "updated") if taken else (tk, tv, "kept"))
    for sk, sv in source:
        if not any(eq(tk, sk) for tk, _ in target):
            out.append((sk, sv, "inserted"))
    return sorted(out, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(st.tuples(keys, st.text("ab", max_size=2)), max_size=8),
    source=st.lists(st.tuples(keys, st.text("axb", max_size=2)), max_size=6, unique_by=lambda r: r[0]),
    null_safe=st.booleans(),
    ordered=st.booleans(),
)
def test_merge_matches_model(spark, target, source, null_safe, ordered):
    t = spark.createDataFrame(target, "k int, v string")
    s = spark.createDataFrame(source, "k int, v string")
    merged = merge_frames(t, s, ["k"], null_safe, ["v"] if ordered else [])
    assert sorted(((r.k, r.v, r[OP]) for r in merged.collect()), key=str) == model(target, source, null_safe, ordered)
