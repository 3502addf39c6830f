"""Candidate readings of fields: labelled lines, prose, corrections, second readings, value sweeps.

The result is long: one row a reading, with the order in which it was seen. ``seq`` is a struct of
(pass, place of the page by authority, kind, line, match), so that ties are settled the same way
whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, fuzzy, text, values
from ..sources.shared import materialised, tasks_for
from .typing import authority

COLUMNS = ("case_id", "field", "value", "rank", "exact", "page", "doc_type", "seq")
CORRECTION = "manual_correction"


def by_authority(pages: DataFrame, rank: Column | None = None) -> DataFrame:
    """Pages with ``authority`` (by default that of their type) and ``place``, their order of trust in the case."""
    ranked = pages.withColumn("authority", authority(F.col("doc_type")) if rank is None else rank)
    return ranked.withColumn("place", F.row_number().over(Window.partitionBy("case_id").orderBy("authority", "number")))


def _rank(field: Column, doc_type: Column, base: Column) -> Column:
    identity = F.create_map(*[F.lit(x) for pair in fixed.IDENTITY_AUTHORITY.items() for x in pair])
    return F.when(doc_type == CORRECTION, 0).when((field == "applicant_name") & F.map_contains_key(identity, doc_type), F.try_element_at(identity, doc_type)).otherwise(base)


def _prose_name(lines: Column) -> Column:
    return F.nullif(F.regexp_extract(F.array_join(lines, " "), fixed.PROSE_NAME_PATTERN, 1), F.lit(""))


#: What a page states, before labels are matched: where, and a line, a label with a value, or a field with one.
_STATED = ("step", "kind", "line_no", "match_no", "exact", "demoted", "line", "label", "field", "raw", "doc_type")

_SEEN = ("step", "kind", "line_no", "match_no", "exact", "demoted", "doc_type")


def _stated(**have: Column | int | str | bool) -> Column:
    kinds = {"step": "int", "kind": "int", "line_no": "int", "match_no": "int", "exact": "boolean", "demoted": "int"}
    value = {name: have.get(name, 0 if name in kinds else None) for name in _STATED}
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast(kinds.get(name, "string")).alias(name) for name, v in value.items()])


def _each(lines: Column, of) -> Column:
    return F.transform(F.coalesce(lines, F.array().cast("array<string>")), of)


def _lines_stated(lines: Column, step: int, exact: Column, demoted: int) -> Column:
    """Lines that may be labelled, and the name that a letter's prose states."""
    letter = F.when(F.col("doc_type") == "sponsor_letter", _prose_name(lines))
    prose = F.array(_stated(step=step, exact=exact, demoted=demoted, field="applicant_name", raw=letter))
    return F.concat(prose, _each(lines, lambda x, i: _stated(step=step, kind=1, line_no=i, exact=exact, demoted=demoted, line=x)))


def _corrections_stated(lines: Column, step: int, exact: Column) -> Column:
    """Manual corrections, which count as a document of their own."""

    def in_line(line: Column, i: Column) -> Column:
        labels, raws = (F.regexp_extract_all(line, F.lit(fixed.CORRECTION_PATTERN), F.lit(g)) for g in (1, 2))
        pairs = F.transform(F.arrays_zip(labels.alias("label"), raws.alias("raw")), lambda p, j: _stated(step=step, kind=2, line_no=i, match_no=j, exact=exact, label=p["label"], raw=p["raw"], doc_type=CORRECTION))
        return F.when(line.rlike(r"(?i)manual\s*correct"), pairs).otherwise(F.array().cast(_TYPE))

    return F.flatten(_each(lines, in_line))


_TYPE = "array<struct<step:int,kind:int,line_no:int,match_no:int,exact:boolean,demoted:int,line:string,label:string,field:string,raw:string,doc_type:string>>"


def _with_sweep(pages: DataFrame) -> DataFrame:
    """``pages`` with values found without a label, canonical already: entries of closed vocabularies, numbers, dates.

    What several expressions need is a column of its own, so that it is made once a page.
    """
    joined = pages.withColumn("__blob", F.array_join("lines", " "))
    keyed = joined.withColumns({"__key": text.squash_lower(F.col("__blob")), "__sponsor_id": values.sponsor_id(F.col("__blob")), **values.date_parts(F.col("__blob"))})
    options = {field: of for field, of in fixed.VOCABULARIES.items() if field != "fee_status"}
    listed = {f"__{field}": F.coalesce(*[F.when(F.contains("__key", F.lit(fuzzy.squash(o))), F.lit(o)) for o in of]) for field, of in options.items()}
    return keyed.withColumns({**listed, "__arrival_date": values.date_of_parts()})


def _swept(exact: Column) -> Column:
    """What ``_with_sweep`` found."""
    fields = [*(f for f in fixed.VOCABULARIES if f != "fee_status"), "sponsor_id", "arrival_date"]
    return F.array(*[_stated(step=3, kind=3, exact=exact, demoted=1, field=f, raw=F.col(f"__{f}")) for f in fields])


def candidates(pages: DataFrame) -> DataFrame:
    """All readings of all cases. ``pages`` has case_id, number, doc_type, lines, source, ocr_lines and second_lines.

    Pages are ordered in their case once, and each gives out all that it states. Labels are matched and values
    brought to their canonical form once for each distinct statement, which its rows then meet.
    """
    pages = pages.select("case_id", "number", "doc_type", "lines", "source", "ocr_lines", "second_lines")
    tasks = tasks_for(pages)
    placed = _with_sweep(by_authority(pages.repartition(tasks, "case_id")))
    exact, never = F.coalesce(F.col("source") == "text", F.lit(False)), F.lit(False)
    second = F.col("second_lines")
    everything = text.all_lines(F.col("lines"), F.col("ocr_lines"), second)
    stated = F.concat(
        _lines_stated(F.col("lines"), 1, exact, 0), _corrections_stated(everything, 1, exact), _lines_stated(second, 2, never, 1), _corrections_stated(second, 2, never),
        F.array(_stated(step=3, exact=exact, demoted=1, field="applicant_name", raw=_prose_name(F.col("lines")))), _swept(exact),
    )
    useful = F.filter(stated, lambda r: r["raw"].isNotNull() | r["line"].isNotNull())
    what = F.struct("r.line", "r.label", "r.field", "r.raw").alias("said")
    rows = placed.select("case_id", "number", F.col("doc_type").alias("on"), "authority", "place", F.explode(useful).alias("r"))
    rows = materialised(rows.select("case_id", "number", "on", "authority", "place", what, *[f"r.{c}" for c in _SEEN]), "stated")
    swept = F.col("kind") == 3
    read = rows.where(~swept).join(_read(rows.where(~swept).select("said").distinct(), tasks), "said").drop("said")
    found = read.unionByName(rows.where(swept).select("*", "said.field", F.col("said.raw").alias("value")).drop("said"))
    doc_type = F.coalesce("doc_type", "on")
    seq = F.struct("step", "place", F.when(swept, 0).otherwise(F.col("kind")).alias("kind"), F.col("line_no").alias("line"), F.col("match_no").alias("match"))
    rank = _rank(F.col("field"), doc_type, F.col("authority") + F.col("demoted"))
    return found.select("case_id", "field", "value", rank.alias("rank"), "exact", F.col("number").alias("page"), doc_type.alias("doc_type"), seq.alias("seq"))


def _read(said: DataFrame, tasks: int) -> DataFrame:
    """(said, field, value) of the statements that name a field and have a value it can take, in ``tasks`` tasks: the matching is costly, not the rows."""
    dealt = said.repartition(tasks).select("said", "said.*")
    pair = F.get(values.label_and_value(F.col("line")), F.lit(0))
    read = dealt.withColumns({"__pair": pair, "__label": values.label(F.col("label"))})
    field, raw = F.coalesce("__pair.field", "__label", "field"), F.coalesce("__pair.raw", F.when(F.col("line").isNull(), F.col("raw")))
    # Written, so that the expressions of a value stand over a plain table, and the join knows its size.
    named = materialised(read.select("said", field.alias("field"), raw.alias("raw")), "readings").where("field is not null and raw is not null")
    valued = named.repartition(tasks).select("said", "field", values.normalized(F.col("field"), F.col("raw")).alias("value"))
    return materialised(valued, "values").where("value is not null")
