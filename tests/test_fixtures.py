"""Known values of the damaged views at sf0.01 (FIXTURES.md)."""

import pytest

from lakesieve.operators import profile, reconcile_counts
from lakesieve.queries.views import V1, V2, V3, V4_SOURCE, V4_TARGET, view

EXPECTED = {
    "V1": (V1, 61_176, 14_469, 2.15, 0, 1_176, 0.9785, 0.9808, 97.97),
    "V2": (V2, 15_000, 930, 1.03, 155, 154, 0.9897, 0.9897, 98.97),
    "V3": (V3, 1_500, 0, 0.0, 0, 1_375, 1.0, 0.0833, 54.17),
}


@pytest.mark.parametrize("by", ["columns", "fingerprint"])
@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_profile(spark, medium, name, by):
    text, *expected = EXPECTED[name]
    row = profile(view(spark, medium, text), by).first()
    assert [row[c] for c in (
        "number_of_records", "total_cell_nulls", "percentage_of_null_values", "total_null_record",
        "total_duplicated_records", "completeness_score", "uniqueness_score", "data_score",
    )] == expected


def test_reconcile(spark, medium):
    row = reconcile_counts(view(spark, medium, V4_SOURCE), view(spark, medium, V4_TARGET)).first()
    assert (row["source_rows"], row["target_before"], row["to_insert"], row["to_delete"]) == (
        15_000, 14_382, 2_538, 1_920)
    assert row["appended"] == 618
