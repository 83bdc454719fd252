"""Property tests: JSON unwrapping and extraction against plain-Python
reference implementations on random documents."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tradelake.functions.json import first_nonempty_list, unnest_extract_json_text

scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                    st.text(alphabet="ab[]{}\",: é", max_size=6))
values = st.recursive(scalars, lambda inner: st.one_of(
    st.lists(inner, max_size=3),
    st.dictionaries(st.text(alphabet="abcxyz", min_size=1, max_size=3), inner, max_size=3)),
    max_leaves=8)
documents = st.one_of(
    st.lists(values, max_size=3),
    st.dictionaries(st.text(alphabet="abcxyz", min_size=1, max_size=3), values, max_size=4),
    scalars)


def python_first_list(text):
    try:
        v = json.loads(text)
    except ValueError:
        return None
    if isinstance(v, list):
        return v
    if isinstance(v, dict):
        for member in v.values():
            if isinstance(member, list) and member:
                return member
    return None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(documents.map(json.dumps), st.just("{not json")), min_size=1,
                max_size=12))
def test_first_nonempty_list_matches_python(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "k int, j string")
    got = {r.k: r.l for r in df.select("k", first_nonempty_list("j").alias("l")).collect()}
    for k, text in enumerate(docs):
        want = python_first_list(text)
        if want is None:
            assert got[k] is None, text
        else:
            assert got[k] is not None, text
            assert [json.loads(e) for e in got[k]] == want, text


elements = st.one_of(
    st.dictionaries(st.sampled_from(["a", "b", "c"]), values, max_size=3), scalars)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(elements, max_size=4), min_size=1, max_size=8))
def test_unnest_extract_matches_python(spark, arrays):
    df = spark.createDataFrame([(k, json.dumps(a)) for k, a in enumerate(arrays)],
                               "k int, j string")
    rows = unnest_extract_json_text(df, "j", ["a", "b"], keep=["k"]).collect()
    want = [(k, *[json.dumps(e[f]) if isinstance(e, dict) and f in e else None
                  for f in ("a", "b")])
            for k, a in enumerate(arrays) for e in a]
    got = [(r.k, r.a, r.b) for r in rows]

    def semantic(t):
        return t[0], *[None if x is None else json.loads(x) for x in t[1:]]
    assert sorted(map(semantic, got), key=repr) == sorted(map(semantic, want), key=repr)
    for r in rows:                      # strings keep their quotes
        for x in (r.a, r.b):
            if x is not None and isinstance(json.loads(x), str):
                assert x.startswith('"')
