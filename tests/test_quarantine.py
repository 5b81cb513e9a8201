"""Landing trip files with lines that do not fit put aside."""

from __future__ import annotations

import pytest

from tests.test_sources import HEADER, trip_line
from velotide.__main__ import main
from velotide.plans.bronze import run_bronze
from velotide.sources.parquet import read_parquet
from velotide.sources.trips import CORRUPT_LINE, land_with_quarantine

BAD = [trip_line("b1").replace("40.1", "north"), "b2,electric_bike", trip_line("b3") + ",more"]


def land(spark, tmp_path, *lines):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    out, refused = str(tmp_path / "raw" / "trips"), str(tmp_path / "refused")
    return land_with_quarantine(spark, str(folder), out, refused), out, refused


def test_lines_are_split_and_counted(spark, tmp_path):
    counts, out, refused = land(spark, tmp_path, trip_line("r1"), *BAD, trip_line("r2", ""))
    assert counts == (5, 2, 3)
    good = read_parquet(spark, out)
    assert sorted(r.ride_id for r in good.collect()) == ["r1", "r2"]
    assert good.where(f"{CORRUPT_LINE} IS NOT NULL").count() == 0
    kept = {(r[CORRUPT_LINE], r.file_name) for r in read_parquet(spark, refused).collect()}
    assert kept == {(line, "a.csv") for line in BAD}
    # Nothing is left beside the two tables.
    assert [p.name for p in (tmp_path / "raw").iterdir()] == ["trips"]


@pytest.mark.parametrize("lines,want", [([], (0, 0, 0)), ([trip_line("r1")], (1, 1, 0)), (BAD, (3, 0, 3))])
def test_either_side_may_be_empty(spark, tmp_path, lines, want):
    counts, out, refused = land(spark, tmp_path, *lines)
    assert counts == want
    assert (read_parquet(spark, out).count(), read_parquet(spark, refused).count()) == want[1:]


def test_landing_again_replaces_both(spark, tmp_path):
    land(spark, tmp_path, trip_line("r1"), *BAD)
    counts, out, refused = land(spark, tmp_path, trip_line("r7"))
    assert counts == (1, 1, 0)
    assert [r.ride_id for r in read_parquet(spark, out).collect()] == ["r7"] and read_parquet(spark, refused).count() == 0


def test_bronze_reads_what_was_landed(spark, tmp_path, capsys):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("\n".join([HEADER, trip_line("r1"), *BAD]) + "\n")
    raw = str(tmp_path / "raw")
    main(["ingest", "--csv", str(tmp_path / "csv"), "--out", raw, "--quarantine", str(tmp_path / "refused")])
    assert "rows read: 4, landed: 1, quarantined: 3" in capsys.readouterr().out
    assert run_bronze(spark, raw, str(tmp_path / "t"), str(tmp_path / "s")).first()[:2] == (1, 1)
    assert CORRUPT_LINE not in read_parquet(spark, str(tmp_path / "t")).columns
