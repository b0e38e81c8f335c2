from claimweave.sinks import ranged
from row_sets import rows


def test_pieces_grow_with_the_table(spark, tmp_path, monkeypatch):
    """However many rows, the manifest lists a bounded number of pieces, and upserts keep to it."""
    monkeypatch.setattr(ranged, "MOST_PIECES", 8)
    frame = spark.range(3000).selectExpr("id AS k", "'old' AS v")
    table = ranged.RangedTable(spark, str(tmp_path / "t"), rows_per_piece=10)
    table.create(frame, ["k"])
    assert 4 <= len(table.pieces()) <= 8 and rows(table.read()) == rows(frame)
    table.upsert(spark.range(2900, 3100).selectExpr("id AS k", "'new' AS v"))
    got = dict(rows(table.read()))
    assert len(got) == 3100 and sum(v == "new" for v in got.values()) == 200
    assert len(table.pieces()) <= 10 and sum(p["rows"] for p in table.pieces()) == 3100
