"""Layout recognition (SURVEY CLS-*), including the legacy detector's own three cases."""

from pyspark.sql import functions as F

from feedrecon.layouts import LAYOUTS
from feedrecon.operators.classify import UNKNOWN, classify_headers, classify_long
from feedrecon.plans.catalog import REGISTRY


def _classify(spark, headers):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "feed int, header array<string>")
    return [r.version for r in classify_headers(df).orderBy("feed").collect()]


def test_reference_cases(spark):
    assert _classify(spark, [
        ["student_id", "student_name", "schoolId", "credentialType", "issueDate", "status"],
        ["studentId", "first_name", "last_name", "school_id", "cred_type", "issue_date", "credentialStatus"],
        ["stu_id", "firstName", "lastName", "school_code", "credential_category", "issued_on", "status_code"],
    ]) == ["v1", "v2", "v3"]


def test_every_layout_own_columns_permuted_and_extra(spark):
    heads = [list(reversed(l.columns)) + ["extra"] for l in LAYOUTS.values()]
    assert _classify(spark, heads) == list(LAYOUTS)


def test_unknown_missing_column_and_case(spark):
    v1 = list(LAYOUTS["v1"].fingerprint)
    assert _classify(spark, [v1[1:], [c.upper() for c in v1], []]) == [UNKNOWN] * 3


def test_ambiguous_larger_wins_then_registry_order(spark):
    v1, v2, v5 = (list(LAYOUTS[v].columns) for v in ("v1", "v2", "v5"))
    # v1 (6 columns) + v2 (7 columns): the larger fingerprint wins
    # v1 + v5 (both 6): registry order, v1 first
    assert _classify(spark, [v1 + v2, v5 + v1]) == ["v2", "v1"]


def test_duplicate_names_do_not_matter(spark):
    v3 = list(LAYOUTS["v3"].columns)
    assert _classify(spark, [v3 + v3]) == ["v3"]


def test_long_form_agrees_with_array_form(spark, sf_small):
    from feedrecon.sources.fixtures import header_manifest
    m = header_manifest(spark, sf_small)
    a = classify_headers(m).select("feed", "version", "matches")
    b = classify_long(m.select("feed", F.explode("header").alias("column")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_array_form_has_no_shuffle(spark, sf_small):
    from tests.plan_utils import plan_text
    assert "Exchange" not in plan_text(REGISTRY["feed_classify"](spark, sf_small))


def _py_detect(header):
    cols = set(header)
    matches = [v for v, l in LAYOUTS.items() if set(l.fingerprint) <= cols]
    if not matches:
        return UNKNOWN
    best = matches[0]
    for v in matches[1:]:
        if len(LAYOUTS[v].fingerprint) > len(LAYOUTS[best].fingerprint):
            best = v
    return best


def test_random_headers_agree_with_brute_force(spark):
    import random
    rng = random.Random(11)
    pool = sorted({c for l in LAYOUTS.values() for c in l.columns}) + ["extra", "ID", "Status", "notes"]
    heads = []
    for _ in range(2000):
        base = list(rng.choice(list(LAYOUTS.values())).columns) if rng.random() < 0.6 else []
        base = [c for c in base if rng.random() > 0.08]
        base += rng.sample(pool, rng.randint(0, 12))
        rng.shuffle(base)
        heads.append(base)
    df = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "feed int, header array<string>")
    got = {r.feed: r.version for r in classify_headers(df).collect()}
    long_got = {r.feed: r.version for r in
                classify_long(df.select("feed", F.explode("header").alias("column"))).collect()}
    for i, h in enumerate(heads):
        assert got[i] == _py_detect(h), (h, got[i])
        if h:
            assert long_got[i] == got[i], h
