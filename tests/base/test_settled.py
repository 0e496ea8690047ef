"""Scores that differ by rounding alone are equal to the leader grouping."""

from onomast.operators.cluster import settled


def test_rounding_decides_nothing(spark):
    rows = [("A", "B", 0.1 + 0.7), ("A", "C", 0.8), ("A", "D", 0.7 - 1e-16), ("A", "E", 0.6999)]
    assert rows[0][2] != rows[1][2] and rows[2][2] < 0.7
    found = {r.b: r.score for r in settled(spark.createDataFrame(rows, "a string, b string, score double")).collect()}
    assert found == {"B": 0.8, "C": 0.8, "D": 0.7}
