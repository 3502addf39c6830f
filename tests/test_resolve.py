"""Resolution in one pass over the values of a case."""

from __future__ import annotations

import random

from docketry.operators import candidates, resolve


def test_resolving_has_no_join_and_three_shuffles(spark):
    """Equal to the three steps one after another, each of which joined the readings with the chosen ones."""
    rng, rows = random.Random(4), []
    names = ["Miraquell Ixovara", "Miraquell Ixovaro", "Mira Ixo", "Soltari Tekrix", "miraquell ixovara", "Zadane Qorul", None]
    for i in range(900):
        case, kind = rng.choice(["a", "b", "c", "d", "e", "f", None]), rng.choice(["intake_form", "sponsor_letter", candidates.CORRECTION, None])
        field = rng.choice(["applicant_name", "visa_class", "risk_flags", "finding"])
        rows.append((f"{case}{i % 40}" if case else None, field, rng.choice(names), rng.randint(0, 4), rng.random() < 0.4, rng.randint(1, 3), kind, (i % 3, i)))
    schema = "case_id string, field string, value string, rank int, exact boolean, page int, doc_type string, seq struct<step:int,line:int>"
    found = spark.createDataFrame(rows, schema).repartition(5)
    steps = resolve.prefer_clean(found, resolve.consensus(found, resolve.best_by_authority(found)))
    made = resolve.resolve(found)
    key = lambda r: str(tuple(r))
    assert sorted(made.collect(), key=key) == sorted(steps.select(made.columns).collect(), key=key)
    shuffles = resolve.resolve(found)._jdf.queryExecution().executedPlan().toString()
    assert shuffles.count("Exchange hashpartitioning(") == 3 and "Join" not in shuffles
