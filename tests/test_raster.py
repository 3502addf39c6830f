from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from docketry.operators import raster
from docketry.sources.evidence import PAGES


def test_colours(spark):
    page = np.full((4, 5, 3), 200, np.uint8)
    page[0, :3] = (10, 200, 20)
    page[1, 0] = (255, 0, 0)
    plain = np.full((4, 5, 3), 200, np.uint8)
    rows = [("A", 4, 5, page.tobytes()), ("A", 4, 5, plain.tobytes()), ("B", 4, 5, plain.tobytes())]
    got = raster.colour_counts(spark.createDataFrame(rows, "case_id string, height int, width int, pixels binary"))
    assert {r["case_id"]: (r["green"], r["red"]) for r in got.collect()} == {"A": (3, 1), "B": (0, 0)}


def test_ink_and_cells(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(20):
        page = np.full((30, 40), 255, np.uint8)
        page[2, :] = 0
        page[10:20, 5:25] = np.where(rng.random((10, 20)) < 0.5, 0, 255)
        rows.append((30, 40, page.tobytes()))
    rows.append((2, 2, b"\xff" * 4))
    frame = spark.createDataFrame(rows, "height int, width int, pixels binary").repartition(4)
    got = {r["height"]: r for r in raster.ink_frequency(frame).collect()}
    assert (got[30]["pages"], got[30]["template"], got[30]["variable"], got[2]["variable"]) == (20, 40, 200, 0)
    assert raster.cells(bytes(got[30]["frequency"]), 30, 40) == [(5, 10, 20, 10)]
    assert raster.cells(bytes(got[30]["frequency"]), 30, 40, least=500) == []


def test_shift():
    rng = np.random.default_rng(1)
    page = rng.random((32, 48))
    assert raster.shift(page, np.roll(page, (3, -5), (0, 1))) == (-5, 3)


def test_orientation_and_rotation(spark):
    reports = spark.createDataFrame([("Rotate: 90\nOrientation confidence: 4.5",), ("nothing",)], "r string")
    assert [tuple(r[0]) for r in reports.select(raster.orientation(F.col("r"))).collect()] == [(90, 4.5), (None, 0.0)]
    rows = [("A", 1, 0, ["xx"]), ("A", 1, 90, ["fee status paid"]), ("A", 1, 180, ["fee"]), ("B", 1, 90, []), ("B", 1, 0, [])]
    got = raster.best_rotation(spark.createDataFrame(rows, "case_id string, number int, angle int, lines array<string>"), "fee|status")
    assert {r["case_id"]: (r["angle"], r["score"]) for r in got.collect()} == {"A": (90, 9), "B": (0, 0)}


def test_readings(spark):
    rows = spark.createDataFrame([(["short"], ["a longer reading"]), (["x" * 50], ["y" * 60]), (["short"], ["s"])], "a array<string>, b array<string>")
    assert [r[0][0][0] for r in rows.select(raster.longer_reading(F.col("a"), F.col("b"))).collect()] == ["a", "x", "s"]


def test_panel_is_read_again(spark):
    slip = ("A", 1, "biometric_slip", ["x"], "ocr", [], "", [])
    pages = spark.createDataFrame([slip, ("B", 1, *slip[2:]), ("D", None, *slip[2:]), ("D", None, *slip[2:]), ("C", 1, "biometric_slip", ["x"], "text", [], "", [])], PAGES)

    def read(case, number, second):
        return ["Observed flags: active_warrant"] if second == (case == "B") else ["smudge"]

    rows = raster.reread_panel(pages, read).collect()
    got = {r["case_id"]: r["lines"] for r in rows}
    assert len(rows) == 5 and got == {"D": ["x", "Observed flags: active_warrant"], "A": ["x", "Observed flags: active_warrant"], "B": ["x", "Observed flags: active_warrant"], "C": ["x"]}


def test_header_gain(spark):
    rows = spark.createDataFrame([(["Kepler 186f"], ["LUNA_SECURID"], "Kepler-186f", "LUNA_SECURID", "ab"), ([], [], "Luyten-b", None, "abcd")], "lines array<string>, fresh array<string>, home_world string, species_code string, visa_class string")
    got = {r["field"]: (r["held"], r["gained"]) for r in raster.header_gain(rows, ("home_world", "species_code", "visa_class")).collect()}
    assert got == {"home_world": (1, 0), "species_code": (0, 1), "visa_class": (0, 0)}
