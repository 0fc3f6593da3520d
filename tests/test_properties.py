"""Property checks against brute-force Python on generated data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from marquee.operators import concat_columns, top_n_per_group

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

scores = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                            st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=60)


def brute_rank(data, n):
    out = []
    for i, (g, v) in enumerate(data):
        same = [w for h, w in data if h == g]
        # DESC NULLS LAST: a NULL is beaten by every value; values by larger ones.
        better = sum(1 for w in same if (v is None and w is not None) or
                     (v is not None and w is not None and w > v))
        if better + 1 <= n:
            out.append((i, better + 1))
    return sorted(out)


@SETTINGS
@given(data=scores, n=st.integers(1, 4))
def test_top_n_matches_brute_force(spark, data, n):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)],
                               "grp string, v int, id int")
    got = sorted(rows(top_n_per_group(df, "grp", "v", n).select("id", "rank")))
    assert got == brute_rank(data, n)


@SETTINGS
@given(a=st.lists(st.integers(-50, 50), max_size=30, unique=True),
       b=st.lists(st.integers(-50, 50), max_size=30, unique=True))
def test_concat_matches_positional_zip(spark, a, b):
    if not a and not b:
        return
    left = spark.createDataFrame([(x, f"l{x}") for x in a], "k int, lv string")
    right = spark.createDataFrame([(x, f"r{x}") for x in b], "k int, rv string")
    got = rows(concat_columns([left, right], [["k"], ["k"]]))
    sa, sb = sorted(a), sorted(b)
    want = []
    for i in range(max(len(sa), len(sb))):
        ka = sa[i] if i < len(sa) else None
        kb = sb[i] if i < len(sb) else None
        want.append((ka, None if ka is None else f"l{ka}", None if kb is None else f"r{kb}"))
    assert got == want


parents = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.floats(0, 10, width=32))),
                   min_size=0, max_size=15)
children = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c"])),
                    min_size=0, max_size=40)


def _mean(values):
    vals = [v for v in values if v is not None]
    return sum(vals) / len(vals) if vals else None


@SETTINGS
@given(ps=parents, cs=children)
def test_avg_by_key_matches_mean_over_the_materialised_join(spark, ps, cs):
    from marquee.operators import avg_by_key
    p = spark.createDataFrame(ps, "k int, v double")
    c = spark.createDataFrame(cs, "k int, g string")
    got = {g: m for g, m in rows(avg_by_key(p, c, "k", "g", "v", "m"))}
    joined = [(g, v) for pk, v in ps for ck, g in cs if pk == ck]
    want = {g: _mean([v for h, v in joined if h == g]) for g in {g for g, _ in joined}}
    assert set(got) == set(want)
    for g, m in want.items():
        assert (got[g] is None and m is None) or abs(got[g] - m) < 1e-9


packed = st.lists(st.tuples(st.integers(0, 5), st.lists(st.sampled_from(["x", "y", "z", ""]),
                                                         min_size=1, max_size=3)),
                  min_size=0, max_size=10)
facts = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.floats(0, 100, width=32))),
                 min_size=0, max_size=40)


@SETTINGS
@given(ls=packed, fs=facts)
def test_avg_by_packed_key_matches_mean_over_exploded_join(spark, ls, fs):
    from marquee.operators import avg_by_packed_key
    left = spark.createDataFrame([(k, ",".join(t)) for k, t in ls], "k int, tags string")
    right = spark.createDataFrame(fs, "k int, v double")
    got = {t: m for t, m in rows(avg_by_packed_key(left, right, "k", "tags", "v",
                                                   exclude=["z"], group="t"))}
    exploded = [(t, v) for k, tags in ls for fk, v in fs if k == fk for t in tags]
    want = {t: _mean([v for s, v in exploded if s == t])
            for t in {t for t, _ in exploded} if t != "z"}
    assert set(got) == set(want)
    for t, m in want.items():
        assert (got[t] is None and m is None) or abs(got[t] - m) < 1e-6


credits = st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.integers(0, 5),
                             st.one_of(st.none(), st.floats(0, 10, width=32)),
                             st.one_of(st.none(), st.integers(0, 1000))), max_size=40)
name_map = st.dictionaries(st.integers(0, 6), st.sampled_from(["Ann", "Bob", "Cy"]), max_size=7)


@SETTINGS
@given(cs=credits, names=name_map)
def test_score_by_label_matches_brute_force(spark, cs, names):
    from marquee.operators import score_by_label
    df = spark.createDataFrame(cs, "grp string, pid int, rating double, votes int")
    labels = spark.createDataFrame(sorted(names.items()), "pid int, name string")
    got = {(g, n): r[2:] for r in rows(score_by_label(df, "grp", "pid", labels, "pid", "name",
                                                      "rating", "votes"))
           for g, n in [r[:2]]}
    joined = [(g, names[p], r, v) for g, p, r, v in cs if p in names]
    want = {}
    for key in {(g, n) for g, n, _, _ in joined}:
        grp = [(r, v) for g, n, r, v in joined if (g, n) == key]
        mean = _mean([r for r, _ in grp])
        total = sum(v for _, v in grp if v is not None) if any(v is not None for _, v in grp) else None
        score = None if mean is None or total is None else total * mean
        want[key] = (len(grp), mean, total, score)
    assert set(got) == set(want)
    for key, (n, mean, total, score) in want.items():
        g_n, g_mean, g_total, g_score = got[key]
        assert g_n == n and g_total == total
        for a, b in ((g_mean, mean), (g_score, score)):
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b))
