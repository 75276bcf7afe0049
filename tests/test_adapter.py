"""Views that much is computed for: their tasks grow in number with the table, not in size."""

from inquirylake import adapter


def test_costly_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(adapter, "COSTLY", 100)
    rows = adapter.inquiries(spark, "/root/testdata/sf0.001", costly=True)
    n = rows.count()
    assert rows.rdd.getNumPartitions() == max(4, -(-n // 100)) > 4
