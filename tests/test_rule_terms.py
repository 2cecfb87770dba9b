"""Terms of rules written out, against their patterns."""

import pytest

from pyspark.sql import functions as F

from newsloom.operators import rules as ru
from newsloom.rules.dutch_sme import RULES


@pytest.mark.parametrize("term, written", [
    ("start-?up", ["start-up", "startup"]),
    ("bakker(ij)?", ["bakker", "bakkerij"]),
    (r"(klein(e|er)e?\s+)?zaak", ["kleine\nzaak", "kleinee\nzaak", "kleiner\nzaak", "kleinere\nzaak", "zaak"]),
    ("a|b(c|d)", ["a", "bc", "bd"]),
    ("v.n.", None), ("a+", None), ("(a", None), ("a)", None), ("a??", None), ("[ab]", None),
])
def test_spellings(term, written):
    assert ru.spellings(term) == written


def test_terms_agree_with_their_patterns(spark):
    terms = sorted({t for r in RULES for group in (*r.groups, r.none_of) for t in group} | {"x(y)?", "(z)?", "a|b c", "-", r"(k)l\2"})
    near = [s.replace("\n", gap) for t in terms for s in ru.spellings(t) or [t] for gap in (" ", "  \t", "-")]
    texts = [t for n in near for t in (n, f"é{n}", f"{n}en", f"de {n}.", n[1:], n[:-1])] + ["", "vans", "v n x", "de vxn.", "kl klk"]
    df = spark.createDataFrame([(t,) for t in sorted(set(texts))], "clean_geo string")
    rules = [ru.Rule(f"w{i}", ru.SME, (tuple(terms[i::7]),)) for i in range(7)]
    patterns = [ru.ColumnRule(f"p{i}", lambda c, i=i: F.when(c.rlike(ru.bounded_pattern(terms[i::7])), ru.SME), (ru.SME,)) for i in range(7)]
    got = ru.apply_rules(df, [*rules, *patterns]).collect()
    for r in got:
        assert [r[f"w{i}"] for i in range(7)] == [r[f"p{i}"] for i in range(7)], r.clean_geo
    assert {r.w0 for r in got} == {ru.SME, ru.ABSTAIN}


def test_a_filter_on_votes_makes_the_words_once(spark):
    df = spark.createDataFrame([(1, "het mkb"), (2, "een bank"), (3, None), (4, "niets")], "doc_id int, clean_geo string").repartition(2)
    voted = ru.apply_rules(df, RULES)
    kept = voted.where((F.col("lf_explicit_sme") + F.col("lf_general_sector_terms")) >= 0)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert ru.apply_rules(df, []).columns == df.columns
