"""Season files: CSV with NA, season from the file name, by-name columns."""

import gzip
import os

import pytest

from seasonkit.operators import features as fe
from seasonkit.schema import PLAY_CSV_SCHEMA
from seasonkit.sources import file_headers, read_by_header, read_play_files


def _write(path, header, rows):
    with gzip.open(path, "wt") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_csv_seasons_from_file_names(spark, tmp_path):
    # extra column first and a shuffled order: columns are taken by name
    header = ["extra", "posteam", "game_id", "home_team", "away_team", "season_type", "week", "play_type",
              "field_goal_result", "epa", "pass", "rush", "yardline_100", "yards_gained", "score_differential",
              "passing_yards", "rushing_yards", "penalty_yards", "cpoe", "first_down", "third_down_failed",
              "touchdown", "interception", "sack", "tackled_for_loss", "fumble", "passer_player_name"]
    row = ["x", "A", "g1", "A", "B", "REG", "1", "pass", "NA", "0.5", "1", "0", "40", "7", "3", "7", "NA", "NA",
           "NA", "1", "0", "0", "0", "0", "0", "0", "Someone"]
    for year in (2019, 2020):
        _write(os.path.join(tmp_path, f"play_by_play_{year}.csv.gz"), header, [row, row[:9] + ["NA"] + row[10:]])
    df = read_play_files(spark, str(tmp_path))
    got = sorted((r["year"], str(r["epa"]), r["cpoe"]) for r in df.collect())
    assert got == [("2019", "0.5", None), ("2019", "None", None), ("2020", "0.5", None), ("2020", "None", None)]
    se = fe.season_table(df).collect()
    assert sorted((r["year"], r["posteam"], r["passing_yards"]) for r in se) == [("2019", "A", 7.0), ("2020", "A", 7.0)]


def test_missing_required_column_fails(spark, tmp_path):
    _write(os.path.join(tmp_path, "play_by_play_2019.csv.gz"), ["game_id"], [["g"]])
    with pytest.raises(ValueError):
        read_play_files(spark, str(tmp_path))


def _numbered(header, year, extra=()):
    """A row whose value in each column names it, so that a swapped column shows."""
    names = [f.name for f in PLAY_CSV_SCHEMA.fields]
    return [str(year * 100 + names.index(h)) if h in names else "other" for h in header]


def test_unlike_headers_are_read_by_name(spark, tmp_path):
    """Three orders, an extra column, a missing player column, a quoted header, and an empty file; one scan a header."""
    names = [f.name for f in PLAY_CSV_SCHEMA.fields]
    headers = {2016: names, 2017: names[::-1], 2018: ["extra", *names[5:], *names[:5]], 2019: names[:-1], 2020: names}
    for year, header in headers.items():
        _write(os.path.join(tmp_path, f"play_by_play_{year}.csv.gz"), header, [_numbered(header, year)] * 2)
    _write(os.path.join(tmp_path, "play_by_play_2021 [a].csv.gz"), [f'"{n}"' for n in names], [_numbered(names, 2021)])
    gzip.open(os.path.join(tmp_path, "play_by_play_2022.csv.gz"), "wb").close()
    scans = read_by_header(spark, str(tmp_path))
    assert sorted(len(s.inputFiles()) for s in scans) == [1, 1, 1, 1, 2]
    got = read_play_files(spark, str(tmp_path))
    numbers = {f.name: i for i, f in enumerate(PLAY_CSV_SCHEMA.fields)}
    seen = {}
    for r in got.collect():
        seen[r.year] = seen.get(r.year, 0) + 1
        for name, i in numbers.items():
            want = None if r.year == "2019" and name == names[-1] else int(r.year) * 100 + i
            assert (r[name] if r[name] is None else float(r[name])) == want, (r.year, name)
    assert seen == {"2016": 2, "2017": 2, "2018": 2, "2019": 2, "2020": 2, "2021": 1}
    assert fe.season_table(got).schema == fe.season_table(read_play_files(spark, str(tmp_path / "play_by_play_2016.csv.gz"))).schema
    with pytest.raises(ValueError, match="extra"):
        read_play_files(spark, str(tmp_path), required=["extra"])


def test_unlike_headers_below_season_folders(spark, tmp_path):
    names = [f.name for f in PLAY_CSV_SCHEMA.fields]
    for year, header in ((2019, names), (2020, names[::-1])):
        os.makedirs(tmp_path / f"year={year}")
        _write(os.path.join(tmp_path, f"year={year}", "part-0.csv.gz"), header, [_numbered(header, year)])
    got = {r.year: r.cpoe for r in read_play_files(spark, str(tmp_path)).collect()}
    assert got == {y: float(int(y) * 100 + names.index("cpoe")) for y in ("2019", "2020")}


def test_header_tasks_read_one_line(spark, tmp_path):
    """Many lines, one split a file although the files are small; no file without a header is an error of its own."""
    header = [f.name for f in PLAY_CSV_SCHEMA.fields]
    for year in range(2000, 2012):
        _write(os.path.join(tmp_path, f"play_by_play_{year}.csv.gz"), header, [_numbered(header, year)] * 50)
    found = file_headers(spark, str(tmp_path)).collect()
    assert len(found) == 12 and {r.header for r in found} == {",".join(header)}
    os.makedirs(tmp_path / "none")
    gzip.open(tmp_path / "none" / "play_by_play_2022.csv.gz", "wb").close()
    with pytest.raises(ValueError, match="header"):
        read_play_files(spark, str(tmp_path / "none"))


def test_file_name_without_season_fails(spark, tmp_path):
    header = [f.name for f in PLAY_CSV_SCHEMA.fields]
    _write(os.path.join(tmp_path, "pbp_2019.csv.gz"), header, [["1"] * len(header)])
    with pytest.raises(Exception, match="no season in the file name"):
        read_play_files(spark, str(tmp_path)).collect()


def test_missing_tokens_of_pandas(spark, tmp_path):
    header = [f.name for f in PLAY_CSV_SCHEMA.fields]
    rows = []
    for token in ("NA", "NaN", "N/A", "null", ""):
        row = ["1"] * len(header)
        row[header.index("posteam")] = row[header.index("epa")] = row[header.index("yards_gained")] = token
        rows.append(row)
    _write(os.path.join(tmp_path, "play_by_play_2019.csv.gz"), header, rows)
    got = read_play_files(spark, str(tmp_path)).select("posteam", "epa", "yards_gained").collect()
    assert [tuple(r) for r in got] == [(None, None, None)] * 5
