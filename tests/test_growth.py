"""What keeps the packet queries in proportion to their input: tasks, distinct values, screens before the matcher."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docketry.functions import fixed, fuzzy, text
from docketry.operators import candidates, resolve, typing
from docketry.operators.candidates import CORRECTION
from docketry.plans import bindings, queries
from docketry.sources.shared import tasks_for


def counted(monkeypatch, name):
    calls, plain = [], getattr(fuzzy, name)
    monkeypatch.setattr(fuzzy, name, lambda *args, **kw: calls.append(args) or plain(*args, **kw))
    return calls


def test_panels_are_read_once_a_distinct_panel(monkeypatch):
    calls = counted(monkeypatch, "panel_flags")
    lines = [["Observed flags: ", "act1ve warrant"], None, ["Observed flags: none"]] * 50
    assert fuzzy.panel_udf.func(pd.Series(lines)).tolist() == [["active_warrant"], [], []] * 50
    assert len(calls) <= 3


def test_customers_are_dealt_to_the_tasks_of_a_shuffle(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1
    assert bindings.customers(spark, sf_dir).rdd.getNumPartitions() >= 4


def test_a_text_without_a_long_run_is_not_matched(monkeypatch):
    calls = counted(monkeypatch, "longest_run")
    assert fuzzy.contains_score("NOTHINGOFTHEKINDISWRITTENHERE", "WAIVERCODE", 0.7) == 0.0
    assert fuzzy.contains_score("THEWAIVERCODEIS", "WAIVERCODE", 0.7) == 1.0
    assert calls == []
    assert fuzzy.contains_score("THEWAIVFRCODEIS", "WAIVERCODE", 0.7) == 0.9
    whole = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"  # a shifted window of a long token is above 0.97 before it
    assert fuzzy.contains_score("--" + whole, whole, 0.7) == 35 / 36
    assert len(calls) == 2


def test_bodies_are_voted_on_once_a_distinct_body(monkeypatch):
    calls = counted(monkeypatch, "anchor_vote")
    assert fuzzy.anchor_udf.func(pd.Series(["FEESTATUS 12 WAIVERCODE", None] * 50)).tolist() == ["fee_receipt", None] * 50
    assert len(calls) == 1


def test_findings_are_read_once_a_distinct_text(monkeypatch):
    calls = counted(monkeypatch, "decision_after_label")
    assert fuzzy.decision_udf.func(pd.Series(["F1NDING DENIED", None] * 50)).tolist() == ["DENIED", None] * 50
    assert len(calls) == 1


def test_a_join_is_not_taken_for_the_product_of_its_sides(spark, tmp_path):
    rows = spark.range(100_000).select(F.col("id"), F.lit("x" * 50).alias("text"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert tasks_for(rows.join(rows.withColumnRenamed("text", "other"), "id").join(rows.withColumnRenamed("text", "third"), "id")) == 4


def test_pages_of_a_case_come_from_one_scan(spark, sf_dir):
    plan = bindings.made_pages(spark, sf_dir, worn=True)._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1


def test_a_swept_key_is_bound_once_for_all_options(spark):
    options = F.array(F.lit("ab"), F.lit("cd"))
    seen = spark.range(1).select(text.first_contained(F.lower(F.concat(F.lit("X"), F.col("id").cast("string"), F.lit("CD"))), options).alias("x"))
    filtered = seen._jdf.queryExecution().optimizedPlan().toString().split("lambdafunction(Contains(")
    assert seen.first()["x"] == "cd"
    assert len(filtered) == 2 and not filtered[1].startswith("lower")


def test_best_and_clean_equals_the_joined_plan(spark):
    rows = []
    for case in (None, *range(1, 60)):
        for field in ("sponsor_id", "risk_flags", None):
            for i in range((case or 5) % 9):
                value = ("A-1", "a1", "B 2", None, "b2", "")[((case or 0) * i + i) % 6]
                exact = None if i == 7 else (i + (case or 0)) % 2 == 0
                rows.append((case, field, value, ((case or 0) * 7 + i * 5) % 3, exact, i, CORRECTION if i == 6 else "form", (i,)))
    found = spark.createDataFrame(rows, "case_id long, field string, value string, rank int, exact boolean, page int, doc_type string, seq struct<line:int>")
    joined = resolve.prefer_clean(found, resolve.best_by_authority(found), approximate=False)
    made = resolve.best_and_clean(found)
    assert made.columns == joined.columns
    assert sorted(map(str, made.collect())) == sorted(map(str, joined.collect()))
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_heads_are_typed_once_a_distinct_head(monkeypatch):
    calls = counted(monkeypatch, "best_heading")
    assert fuzzy.heading_udf.func(pd.Series(["SPONSORATTESTATIONLETTFR", None] * 50)).tolist() == ["sponsor_letter", None] * 50
    assert len(calls) == 1


def test_made_pages_are_dealt_to_the_tasks_of_a_shuffle(spark, sf_dir):
    assert bindings.made_pages(spark, sf_dir).rdd.getNumPartitions() >= 4


def test_a_statement_is_matched_once_however_many_pages_say_it(spark, monkeypatch):
    """Labels and values are matched on distinct statements, not on the rows that make them."""
    written, plain = {}, candidates.materialised
    monkeypatch.setattr(candidates, "materialised", lambda df, name, *rest: written.setdefault(name, plain(df, name, *rest)))
    lines = ["Visa Class: DIP-1", "Visa C1ass DIP-2", "Nothing at all"]
    pages = [(f"c{i}", 1, "intake_form", lines, "text", [], ["Visa Class: DIP-1"]) for i in range(50)]
    schema = "case_id string, number int, doc_type string, lines array<string>, source string, ocr_lines array<string>, second_lines array<string>"
    found = candidates.candidates(spark.createDataFrame(pages, schema).repartition(4))
    assert found.where("field = 'visa_class' and value = 'DIP-1' and seq.step = 1").count() == 100
    assert found.where("field = 'visa_class' and value = 'DIP-1' and seq.step = 2").count() == 50
    assert written["readings"].count() == len(lines)


def test_watermarks_are_found_without_squashing_a_line(spark):
    words = ("Sample Denial", "COPY ARTIFACT", "case-work", "FILED", "archive", "[REDACTED]", "scan_tab", "MIB EYES ONLY", "filed1", "un filed", "FILED FILED", "", " ")
    marks = ("{}", "\u2014 {}.", "{}\n", "\r\n{}\u2028", "\U0001f600{}\x00", "\u0131{}\u212a", "x{}", "{}\n7", " manual  correction {}", "\u00a0Manual correction {}")
    lines = [mark.format(f) for word in words for mark in marks for f in (word, word.replace("i", "\u0131"), "\u017f".join(word), " ".join(word))] + [None]
    rows = spark.createDataFrame([(lines,)], "lines array<string>")
    squashed = F.filter("lines", lambda x: ~text.squash_upper(x).rlike(fixed.WATERMARK_PATTERN) & ~x.rlike(fixed.CORRECTION_LINE_PATTERN))
    got, want = rows.select(typing.typing_lines(F.col("lines")), squashed).first()
    assert got == want and 0 < len(got) < len(lines) - 100
    assert "regexp_replace" not in rows.select(typing.typing_lines(F.col("lines")))._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_type_are_found_one_by_one_as_by_their_pattern(spark):
    odd = (r"A\|B", "[A|B]C", "(A|B)C|D", "^A|B$", "A||B", "[]|]A", "[^]|]C", r"[\]|]C", "[[A]|B]C", "(?i)a|c", r"\QA|B\E", r"A\\|B", r"A{2}|BC?D", "")
    known = (*fixed.HEADING_PATTERNS, *fixed.CONTENT_PATTERNS, *queries.DOC_HEADINGS, *queries.DOC_CONTENTS)
    patterns = [*odd, fixed.CAPTION_PATTERN, *(pattern for _, pattern in known)]
    parts = sorted({part.replace("\\", "").replace("?", "") for pattern in patterns for part in pattern.split("|")})
    values = [*parts, *(part[1:] for part in parts), *(f"A|{part}B" for part in parts), "FINDING:", "FINDING", "FORMI809", "AMOUNT:$", "AA", "B]", "|C", "a\n", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    for pattern in patterns:
        assert rows.where(~typing.holds(F.col("v"), pattern).eqNullSafe(F.col("v").rlike(pattern))).collect() == [], pattern
    plan = rows.select(typing.by_heading(F.col("v")), typing.by_content(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan and not [part for part in plan.split("RLIKE(")[1:] if "|" in part.split(")")[0]]
