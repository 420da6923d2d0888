"""The dead-letter table under replays and empty batches."""

import datetime as dt

from tradelens.operators.enrich import read_dead_letters, write_dead_letters

SCHEMA = "kind string, ticker string, fbd date, cik string"
A, B, C = (("missing_mcap", "AB", dt.date(2024, 1, 2), None), ("missing_sic", None, None, "0012"),
           ("missing_exchange", None, None, "0012"))


def test_a_replayed_batch_replaces_its_own_rows(spark, tmp):
    path = tmp + "/dead"
    for batch, rows in ((0, [A, A, B]), (1, [C]), (2, []), (0, [A, A, B]), (1, [C, B])):
        write_dead_letters(spark.createDataFrame(rows, SCHEMA), path, batch)
    got = sorted(map(tuple, read_dead_letters(spark, path).collect()), key=str)
    assert got == sorted([(*A, 0), (*A, 0), (*B, 0), (*C, 1), (*B, 1)], key=str)


def test_no_failures(spark, tmp):
    write_dead_letters(spark.createDataFrame([], SCHEMA), tmp + "/dead", 0)
    assert read_dead_letters(spark, tmp + "/dead").collect() == []
