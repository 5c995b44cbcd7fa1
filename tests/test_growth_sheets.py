"""Cells that cannot stand beside a label are not shuffled to it."""

from loadtrail import schemas
from loadtrail.constants import HEADER_LABEL, PLANT_LABEL
from loadtrail.operators.sheets import sheet_anchors


def test_only_cells_in_the_places_of_labels_meet_the_labels(spark, tmp_path):
    cells = [("a", 0, 1, PLANT_LABEL), ("a", 0, 2, "A"), ("a", 3, 0, HEADER_LABEL), ("b", 1, 0, PLANT_LABEL), ("b", 0, 2, "no")]
    cells += [("b", 1, 1, "B"), ("c", 5, 0, HEADER_LABEL), ("d", None, 1, PLANT_LABEL), ("d", None, 2, "no"), (None, 0, 1, PLANT_LABEL)]
    cells += [("a", row, column, f"v{row}") for row in range(10, 300) for column in range(14)]
    spark.createDataFrame(cells, schemas.CELLS).write.parquet(str(tmp_path / "cells"))
    found = sheet_anchors(spark.read.schema(schemas.CELLS).parquet(str(tmp_path / "cells")))
    rows = {r.file_name: (r.header_row, r.beside and r.beside.cell_value) for r in found.collect()}
    assert rows == {"a": (3, "A"), "b": (None, "B"), "c": (5, None), "d": (None, None), None: (None, None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, ((row_idx" in plan and "place_column" in plan
